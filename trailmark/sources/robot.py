"""Static robot descriptions: the joints of an XML text as a frame table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

def read_description(spark: SparkSession, path: str) -> DataFrame:
    """A description file as one row: ``xml``."""
    return spark.read.text(path, wholetext=True).withColumnRenamed("value", "xml")


JOINTS = "joint ARRAY<STRUCT<_name: STRING, _type: STRING, parent: STRUCT<_link: STRING>, child: STRUCT<_link: STRING>, origin: STRUCT<_xyz: STRING, _rpy: STRING>>>"


def joints(descriptions: DataFrame, xml: str = "xml") -> DataFrame:
    """A row for each joint: joint, kind, parent, child, and ``xyz``, ``rpy`` as arrays (zeros without an origin)."""

    def triple(text: Column) -> Column:
        numbers = F.transform(F.split(F.trim(text), r"\s+"), lambda x: x.cast("double"))
        return F.coalesce(numbers, F.array(*(F.lit(0.0),) * 3))

    each = descriptions.select(F.explode(F.from_xml(xml, JOINTS)["joint"]).alias("j"))
    return each.select(F.col("j._name").alias("joint"), F.col("j._type").alias("kind"), F.col("j.parent._link").alias("parent"), F.col("j.child._link").alias("child"), triple(F.col("j.origin._xyz")).alias("xyz"), triple(F.col("j.origin._rpy")).alias("rpy"))
