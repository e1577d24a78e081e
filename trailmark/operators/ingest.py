"""From raw packets to typed records; what fails is kept with a reason."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener
from pyspark.sql.types import ArrayType, DataType, StructType
from pyspark.sql.window import Window

from ..schemas import CHANNELS, CLOSED, MESSAGE_TYPES, OPTIONAL


def first_missing(value: Column, kind: DataType, *, optional: list[str], closed: list[str], path: str = "") -> Column:
    """The path of the first field that is null though it must not be, at any depth and in every element of arrays; null where all are there."""
    if isinstance(kind, ArrayType):
        own = lambda x: first_missing(x, kind.elementType, optional=optional, closed=closed, path=f"{path}[]")
        inside = F.transform(value, lambda x: F.when(x.isNull(), f"{path}[]").otherwise(own(x)))
        return F.get(F.filter(inside, lambda m: m.isNotNull()), F.lit(0))
    found = [F.lit(None).cast("string")]
    for field in kind.fields if isinstance(kind, StructType) else []:
        name = f"{path}.{field.name}".lstrip(".")
        part = value[field.name]
        if name not in optional:
            found.append(F.when(part.isNull(), name))
        if isinstance(field.dataType, (ArrayType, StructType)) and name not in closed:
            found.append(F.when(part.isNotNull(), first_missing(part, field.dataType, optional=optional, closed=closed, path=name)))
    return F.coalesce(*found)


def records(packets: DataFrame, channel: str) -> DataFrame:
    """All packets of a channel, parsed and judged once: ingest_seq, payload, ``reason`` (null for a good record) and the fields.

    ``packets``: ingest_seq, payload (JSON text), and maybe channel, on which partition pruning works.
    A record is parsed behind a generator, so that whatever reads its fields finds a column and not
    the parser's expression again.
    """
    if "channel" in packets.columns:
        packets = packets.where(F.col("channel") == channel)
    kind = StructType.fromDDL(CHANNELS[channel])
    once = F.explode(F.array(F.from_json("payload", CHANNELS[channel] + ", _corrupt STRING", {"columnNameOfCorruptRecord": "_corrupt"})))
    parsed = packets.select("ingest_seq", "payload", once.alias("r"))
    reason = F.when(F.col("r").isNull() | F.col("r._corrupt").isNotNull(), "malformed")
    if channel in MESSAGE_TYPES:
        reason = reason.when(~F.col("r.message_type").eqNullSafe(F.lit(MESSAGE_TYPES[channel])), "message_type")
    missing = first_missing(F.col("r"), kind, optional=OPTIONAL[channel], closed=CLOSED.get(channel, []))
    return parsed.select("ingest_seq", "payload", reason.otherwise(F.concat(F.lit("missing "), missing)).alias("reason"), *(F.col(f"r.{c}").alias(c) for c in kind.names))


def parse(packets: DataFrame, channel: str) -> tuple[DataFrame, DataFrame]:
    """Typed records of a channel, and its quarantine (``ingest_seq``, ``payload``, ``reason``); for both together see :func:`records`."""
    judged = records(packets, channel)
    return judged.where("reason IS NULL").drop("payload", "reason"), judged.where("reason IS NOT NULL").select("ingest_seq", "payload", "reason")


def keep_latest(df: DataFrame, by: list[str], most: int, seq: str = "ingest_seq") -> DataFrame:
    """A bounded queue that drops the oldest: the newest ``most`` rows of each key. For ``foreachBatch``; batch jobs lose nothing."""
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(*by).orderBy(F.desc(seq)))).where(F.col("_n") <= most).drop("_n")


def latest(df: DataFrame, by: list[str], seq: str = "ingest_seq") -> DataFrame:
    """A retained topic: the last row of each key, by partial aggregation."""
    rest = [c for c in df.columns if c not in by]
    return df.groupBy(*by).agg(F.max_by(F.struct(*rest), seq).alias("_row")).select(*by, "_row.*")


def counts(df: DataFrame, by: list[str]) -> DataFrame:
    return df.groupBy(*by).agg(F.count("*").alias("n"))


def observed(packets: DataFrame, name: str, *, channel: str = "channel", channels: list[str] | None = None) -> DataFrame:
    """The same packets, of which Spark counts those of each channel and all others as they pass (``Dataset.observe``), without a pass of its own."""
    known = channels or list(CHANNELS)
    n = lambda c: F.sum(F.when(c, 1).otherwise(0)).alias
    named = [n(F.col(channel).eqNullSafe(c))(c) for c in known]
    return packets.observe(name, *named, n(~F.coalesce(F.col(channel).isin(known), F.lit(False)))("other"))


class TopicCounts(StreamingQueryListener):
    """Counts by channel of each micro-batch of queries over :func:`observed` packets, and their totals. Register it with ``spark.streams.addListener``."""

    def __init__(self, name: str):
        self.name = name
        self.batches: list[dict[str, int]] = []

    @property
    def totals(self) -> dict[str, int]:
        return {c: sum(b[c] for b in self.batches) for c in (self.batches[0] if self.batches else {})}

    def onQueryStarted(self, event) -> None:  # noqa: ANN001, N802
        pass

    def onQueryProgress(self, event) -> None:  # noqa: ANN001, N802
        row = event.progress.observedMetrics.get(self.name)
        if row is not None and any(v is not None for v in row.asDict().values()):
            self.batches.append({k: v or 0 for k, v in row.asDict().items()})

    def onQueryIdle(self, event) -> None:  # noqa: ANN001, N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: ANN001, N802
        pass
