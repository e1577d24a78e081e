"""The queries of this subpackage by name, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .exact_dedup import duplicate_groups
from .langid import identify
from .line_crf import classify
from .line_dedup import without_repeats
from .mixing import mix
from .ngram_join import near_duplicates
from .packing import pack
from .periodic_runs import periodic_runs, repeated_from, summary
from .quality_rules import judge
from .shared import table
from .simhash import near_duplicates as simhash_components
from .substring_dedup import repeated_passages
from .token_counts import count_tokens
from .vector_codes import compress, digest


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents")).select("doc_id", "n_bytes", "n_tokens", "over_limit", "cut_byte")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages(table(spark, sf_dir, "documents"))


def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


#: Pairs by every shared shingle: right on the driver's tables, where it takes seconds, and no plan for more.
OP2_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS l FROM documents
), s AS (
  SELECT DISTINCT doc_id, array_to_string(l[i:i + 4], ' ') AS g FROM w, generate_series(1, greatest(len(l) - 4, 1)) t(i) WHERE len(l) > 0
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), p AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL
), e AS (
  SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)
), ways AS (
  SELECT a, b FROM e UNION ALL SELECT b, a FROM e
), r AS (
  SELECT doc_id AS node, doc_id AS root FROM n UNION SELECT b, root FROM r JOIN ways ON node = a
), c AS (
  SELECT node, min(root) AS component_id FROM r GROUP BY node
)
SELECT doc_id, coalesce(n, 0) AS n_shingles, coalesce(component_id, doc_id) AS component_id FROM documents LEFT JOIN n USING (doc_id) LEFT JOIN c ON doc_id = node
"""


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "documents"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).drop("row")


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = without_repeats(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_chunks", "removed_chunks", "removed_lines", F.sha2("text", 256).alias("text_sha256"))


OP6_SQL = r"""
WITH line AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS body, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS n FROM documents
), hashed AS (
  SELECT *, ('0x' || substr(md5(body), 1, 8))::BIGINT AS h FROM line
), rolled AS (
  SELECT *, (h + 31 * coalesce(lag(h) OVER w, 0)) % 3 = 0 AS cut FROM hashed WINDOW w AS (PARTITION BY doc_id ORDER BY n)
), placed AS (
  SELECT *, coalesce(sum(cut::INT) OVER (PARTITION BY doc_id ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS chunk FROM rolled
), chunks AS (
  SELECT doc_id, chunk, count(*) AS lines, string_agg(body, chr(10) ORDER BY n) AS body FROM placed GROUP BY doc_id, chunk
), judged AS (
  SELECT *, lines > 1 AND row_number() OVER (PARTITION BY body ORDER BY doc_id, chunk) > 1 AS gone FROM chunks
)
SELECT doc_id, sum(lines)::BIGINT AS n_lines, count(*) AS n_chunks, count(*) FILTER (gone) AS removed_chunks, coalesce(sum(lines) FILTER (gone), 0)::BIGINT AS removed_lines,
  sha256(coalesce(string_agg(body, chr(10) ORDER BY chunk) FILTER (NOT gone), '')) AS text_sha256
FROM judged GROUP BY doc_id
"""


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicate_groups(table(spark, sf_dir, "documents")).drop("row")


OP7_SQL = r"""
WITH t AS (
  SELECT doc_id, coalesce(length(text), 0) AS chars, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256 FROM documents
), g AS (
  SELECT *, count(*) OVER (PARTITION BY text_sha256) AS group_size, first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY chars DESC, doc_id) AS keep_id FROM t
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM g
"""


def op8_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).withColumn("target", F.round("target", 6)).drop("source")


OP8_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size, md5(doc_id::VARCHAR) AS k FROM documents
), totals AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source
), weighed AS (
  SELECT *, [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]::DOUBLE AS w, 3.0::DOUBLE * source_size AS cap FROM totals
), ordered AS (
  SELECT *, coalesce(sum(cap) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS cap_before,
    sum(w) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS w_left, sum(source_size) OVER () AS total FROM weighed
), level AS (
  SELECT arg_min((total - cap_before) / w_left, cap / w) FILTER ((total - cap_before) / w_left <= cap / w) AS x FROM ordered
), goals AS (
  SELECT source, source_size, least(cap, x * w) AS target, floor(least(cap, x * w) + 0.5)::BIGINT AS goal FROM weighed, level
), placed AS (
  SELECT s.*, source_size, target, goal, (sum(size) OVER (PARTITION BY s.source ORDER BY k, doc_id, size ROWS UNBOUNDED PRECEDING) - size)::BIGINT AS start
  FROM sized s JOIN goals g ON s.source IS NOT DISTINCT FROM g.source
), needs AS (
  SELECT source, goal, source_size, ceil(source_size / 256)::BIGINT AS blocks, CASE WHEN source_size > 0 THEN goal // source_size * ceil(source_size / 256) + ceil(goal % source_size / 256) ELSE 0 END::BIGINT AS need FROM goals
), bounds AS (
  SELECT *, coalesce(sum(need) OVER (ORDER BY source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS low, sum(need) OVER ()::BIGINT AS total FROM needs
), width AS (
  SELECT greatest(1, len(bin(max(total) - 1))) AS bits FROM bounds
), points AS (
  SELECT slot, list_sum(list_transform(range(bits), lambda j: ((slot >> j) & 1) << (bits - 1 - j)))::BIGINT AS value FROM width, range(1 << bits::BIGINT) t(slot)
), slots AS (
  SELECT source, slot, row_number() OVER (PARTITION BY source ORDER BY slot) - 1 AS r, goal, source_size, blocks, need FROM points JOIN bounds ON value >= low AND value < low + need
), used AS (
  SELECT source, slot, r % blocks * 256 AS from_word, r % blocks * 256 + CASE WHEN r = need - 1 THEN goal - r // blocks * source_size - r % blocks * 256 ELSE 256 END AS to_word FROM slots
), firsts AS (
  SELECT p.source, start, min(slot) AS first_slot FROM placed p JOIN used u ON p.source IS NOT DISTINCT FROM u.source AND from_word < start + size AND start < to_word WHERE size > 0 GROUP BY p.source, start
)
SELECT doc_id, size, source_size, round(target, 6) AS target,
  (SELECT sum(greatest(0, least(p.start + size + e * source_size, goal) - least(p.start + e * source_size, goal))) FROM range(3) t(e))::BIGINT AS taken, CASE WHEN size > 0 THEN first_slot END AS first_slot
FROM placed p LEFT JOIN firsts f ON p.source IS NOT DISTINCT FROM f.source AND p.start = f.start
"""


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))


def op11_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(table(spark, sf_dir, "documents"))


def runs_report(docs: DataFrame) -> DataFrame:
    """Runs of the texts with planted repeats, and digests of all runs and of the collapsed texts."""
    out = periodic_runs(docs.select("doc_id", repeated_from("doc_id", "text").alias("text")))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n")))
    return out.select("doc_id", *summary(), F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs_report(table(spark, sf_dir, "documents"))


def _crc32(text: str) -> str:
    """CRC-32 of an ASCII text, bit by bit."""
    step = "xor(xor(c, s) >> 1, 3988292384 * (xor(c, s) & 1))"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split({text}, ''), lambda x: [ascii(x)::BIGINT, 0, 0, 0, 0, 0, 0, 0]))), lambda c, s: {step}), 4294967295::BIGINT)"


#: Runs by their definition: words that are equal some way apart, as stretches; right where texts are few.
OP12_SQL = rf"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS l, {_crc32('doc_id::VARCHAR')} AS h FROM documents
), g AS (
  SELECT *, len(l) AS n, h // 10 % len(l) AS a, 1 + (len(l) - h // 10 % len(l)) // (3 + h // 10 % 8) AS p FROM w
), t AS (
  SELECT doc_id, n, CASE WHEN h % 10 = 0 AND n > 0 THEN list_transform(range(n), lambda i: l[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % p END]) ELSE l END AS l FROM g
), x AS (
  SELECT doc_id, unnest(l) AS word, unnest(range(len(l))) AS i FROM t
), same AS (
  SELECT a.doc_id, a.i, b.i - a.i AS q, a.i - row_number() OVER (PARTITION BY a.doc_id, b.i - a.i ORDER BY a.i) AS stretch
  FROM x a JOIN x b ON a.doc_id = b.doc_id AND a.word = b.word AND a.i < b.i
), stretches AS (
  SELECT doc_id, min(i) AS start, count(*) + q AS length, q FROM same GROUP BY doc_id, q, stretch HAVING count(*) + q >= greatest(12, 2 * q)
), runs AS (
  SELECT doc_id, start, length, min(q) AS period FROM stretches GROUP BY doc_id, start, length
), facts AS (
  SELECT doc_id, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS listing, min(struct_pack(n := -length, s := start, p := period)) AS best FROM runs GROUP BY doc_id
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM runs
), kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS body FROM x ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n_runs, 0) AS n_runs, best.s AS start, -best.n AS length, best.p AS period, 1000 * -best.n // best.p AS exponent_milli,
  sha256(coalesce(listing, '')) AS runs_sha256, sha256(coalesce(body, '')) AS collapsed_sha256
FROM documents d LEFT JOIN facts f ON f.doc_id = d.doc_id LEFT JOIN kept k ON k.doc_id = d.doc_id
"""


def op13_vector_code_compression(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes, books = compress(table(spark, sf_dir, "embeddings"))
    return codes.select("vec_id", "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))


def _op13_sql(rounds: int = 6) -> str:
    """Lloyd's rounds one behind the other, in integers."""
    floor_div = lambda s, c: f"(({s}) - (({s}) % ({c}) + ({c})) % ({c})) // ({c})"
    near = lambda r: f"""n{r} AS MATERIALIZED (
  SELECT vec_id, p, arg_min(struct_pack(e := e, d := dist), struct_pack(d := dist, e := e)) AS best FROM (
    SELECT v.vec_id, v.p, b.e, sum((v.x - b.x) * (v.x - b.x))::BIGINT AS dist FROM v JOIN b{r} b ON v.p = b.p AND v.k = b.k GROUP BY v.vec_id, v.p, b.e) GROUP BY vec_id, p)"""  # noqa: E731
    parts = [f"""WITH kept AS (
  SELECT vec_id, label, embedding FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), v AS MATERIALIZED (
  SELECT vec_id, i // (len // 8) AS p, i % (len // 8) AS k, floor(4096 * x::DOUBLE)::BIGINT AS x FROM (SELECT vec_id, unnest(embedding) AS x, unnest(range(len(embedding))) AS i, len(embedding) AS len FROM kept)
), first AS (
  SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM (SELECT DISTINCT vec_id FROM kept) ORDER BY vec_id LIMIT 16
), b0 AS MATERIALIZED (SELECT p, e, k, x FROM v JOIN first USING (vec_id))"""]
    for r in range(rounds):
        parts.append(near(r))
        parts.append(f"""b{r + 1} AS MATERIALIZED (
  SELECT b.p, b.e, b.k, CASE WHEN c IS NULL THEN b.x ELSE {floor_div('s', 'c')} END AS x FROM b{r} b LEFT JOIN (
    SELECT v.p, n.best.e AS e, v.k, sum(v.x)::BIGINT AS s, count(*) AS c FROM v JOIN n{r} n ON n.vec_id = v.vec_id AND n.p = v.p GROUP BY v.p, n.best.e, v.k) m ON m.p = b.p AND m.e = b.e AND m.k = b.k)""")
    parts.append(near(rounds))
    parts.append(f"""codes AS (
  SELECT vec_id, string_agg(printf('%02x', best.e), '' ORDER BY p) AS code, sum(best.d)::BIGINT AS error FROM n{rounds} GROUP BY vec_id)
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, (SELECT sha256(string_agg(x::VARCHAR, ',' ORDER BY p, e, k)) FROM b{rounds}) AS codebooks_sha256
FROM codes JOIN kept USING (vec_id)""")
    return ",\n".join(parts)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_substring_dedup, op2_ngram_join, op3_quality_classifier, op4_language_id, op5_quality_rules, op6_line_dedup, op7_exact_dedup, op8_source_mixing, op9_best_fit_packing, op10_token_counts, op11_simhash_near_dedup, op12_periodic_runs, op13_vector_code_compression)}


def oracle_sql() -> dict[str, str]:
    return {"op2_ngram_join": OP2_SQL, "op6_line_dedup": OP6_SQL, "op7_exact_dedup": OP7_SQL, "op8_source_mixing": OP8_SQL, "op12_periodic_runs": OP12_SQL, "op13_vector_code_compression": _op13_sql()}
