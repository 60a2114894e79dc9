"""Mixing sources to target weights by systematic sampling.

1. A document's size is its number of words.  Sources in code-point order (null
   last) weigh ``WEIGHTS`` in turn and share all sizes; a target stops at
   ``MOST`` times its source's size, and the excess is shared again by weight
   until none is above.  Each round is one sum over the sources; the driver
   sees two numbers of it.
2. A source's rate is target / size: each of its documents is expected in the
   mix that many times.  The documents of a source stand in order of size (then
   of a seeded hash), the expected copies are prefix-summed along it, one offset
   that the seed and the source's name give is added, and a document is emitted once
   for every whole number that its step of the sum crosses.

The sums are exact: with whole T (the target) and S (the source's size) the i-th
document's copies are floor(((i + 1) T + U) / S) - floor((i T + U) / S), so no
document comes more than ``MOST`` times.  In order of size the words taken of a
source differ from its target by about one longest document at most.

Places come from ranges of the order (``ranges.numbered``), so a source with a
third of all rows is neither gathered nor ranked in one task.  Reruns agree.

Only DataFrame functions run here.  Defined cases: a null or empty text has size
0 (it has copies, which add no words); a null source is a source of its own; rows that
repeat (same doc_id, source and size) are documents of their own, which of them gets the larger
number of copies is arbitrary; a source of size 0 has target 0 and no copies; an
empty table gives no rows; other columns are kept as they are by ``emit``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.ranges import numbered
from tidemark.llm.staging import staged

WEIGHTS = (1, 2, 3)
MOST = 3
SEED = "mix-1"
#: Fixed value: what is no word, as the contract says.
WORD = r"[^\x20\x09-\x0D]+"


def _seeded(seed: str, value: Column) -> Column:
    """32 bits of md5(seed|value), null as empty."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(seed + "|"), F.coalesce(value.cast("string"), F.lit("")))), 1, 8), 16, 10).cast("long")


def _whole(n: int) -> Column:
    return F.lit(str(n)).cast("decimal(38,0)")


def targets(spark: SparkSession, sizes: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST) -> DataFrame:
    """_source, source_size, target of the sources of sizes (_source, source_size)."""
    named = sizes.withColumn("_all", F.lit(0)).withColumn("_null", F.col("_source").isNull())
    ranked = numbered(spark, named, "_all", ["_null", "_source"])
    weight = F.element_at(F.lit(list(weights)), (F.col("position") % len(weights) + 1).cast("int"))
    table = staged(spark, ranked.select("_source", "source_size", weight.cast("long").alias("_weight")), "mix-sources")
    total, share = table.agg(F.sum("source_size"), F.sum("_weight")).first()
    total, share = int(total or 0), int(share or 1)
    num, den = total, share
    while True:
        full = F.col("source_size") * _whole(most) * _whole(den) <= F.col("_weight") * _whole(num)
        capped, free = table.agg(F.sum(F.when(full, F.col("source_size"))), F.sum(F.when(~full, F.col("_weight")))).first()
        now = (total - most * int(capped or 0), int(free or 0))
        if now == (num, den) or now[1] == 0:
            break
        num, den = now
    target = F.when(full, (F.col("source_size") * most).cast("double")).otherwise(F.col("_weight") * F.lit(num / den))
    return table.select("_source", "source_size", target.alias("target"))


def copies(docs: DataFrame, keep: Sequence[str], weights: Sequence[int] = WEIGHTS, most: int = MOST, seed: str = SEED) -> DataFrame:
    """_row (a struct of the columns ``keep``), size, source_size, target, copies of every document."""
    spark = docs.sparkSession
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    table = staged(spark, docs.select(F.struct(*[docs[c] for c in keep]).alias("_row"), F.col("source").alias("_source"), size.alias("size"),
                                      _seeded(seed, F.col("doc_id")).alias("_tie"), F.col("doc_id").alias("_id")), "mix-sizes")
    shares = targets(spark, table.groupBy("_source").agg(F.sum("size").alias("source_size")), weights, most)
    offset = F.expr("CAST(_u AS DECIMAL(38,0)) * CAST(source_size AS DECIMAL(20,0)) div CAST(4294967296 AS DECIMAL(20,0))")
    facts = shares.withColumn("_u", _seeded(seed, F.col("_source"))).withColumn("_u", offset).withColumn("_t", F.round("target").cast("long"))
    placed = numbered(spark, table, "_source", ["size", "_tie", "_id"], facts)
    crossed = "(CAST(position + {} AS DECIMAL(20,0)) * CAST(_t AS DECIMAL(20,0)) + CAST(_u AS DECIMAL(20,0))) div CAST(source_size AS DECIMAL(20,0))"
    times = F.when(F.col("source_size") > 0, F.expr(f"{crossed.format(1)} - {crossed.format(0)}")).otherwise(F.lit(0))
    return placed.select("_row", "size", "source_size", "target", times.cast("long").alias("copies"))


def emit(docs: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST, seed: str = SEED) -> DataFrame:
    """The mix itself: each document as often as its copies, with the columns of ``docs``."""
    mixed = copies(docs, docs.columns, weights, most, seed).where("copies > 0")
    return mixed.select("_row", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("_row.*")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = copies(spark.read.parquet(f"{sf_dir}/documents.parquet"), ["doc_id"])
    return got.select("_row.doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def _sql_seeded(value: str) -> str:
    return f"CAST('0x' || substr(md5('{SEED}|' || coalesce(CAST({value} AS VARCHAR), '')), 1, 8) AS BIGINT)"


# Water level: by rising size / weight, the first source that the rest's level does not fill.
SQL = rf"""
WITH d AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS BIGINT) AS size FROM documents),
s AS (SELECT source, sum(size) AS ss FROM d GROUP BY source),
w AS (SELECT source, ss, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(WEIGHTS)} + 1 AS wt FROM s),
p AS (SELECT *, sum(ss) OVER () - {MOST} * coalesce(sum(ss) OVER (ORDER BY ss / wt, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS num,
   sum(wt) OVER (ORDER BY ss / wt, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS den FROM w),
l AS (SELECT CAST(num AS DOUBLE) / den AS level FROM p WHERE num * wt < {MOST} * ss * den ORDER BY ss / wt, source NULLS LAST LIMIT 1),
t AS (SELECT source, CAST(ss AS BIGINT) AS ss, least({MOST} * CAST(ss AS DOUBLE), wt * coalesce((SELECT level FROM l), 0)) AS target FROM w),
u AS (SELECT *, CAST(round(target) AS HUGEINT) AS tt, CAST({_sql_seeded('source')} AS HUGEINT) * ss // 4294967296 AS u FROM t),
r AS (SELECT d.doc_id, d.size, u.ss, u.target, u.tt, u.u,
   row_number() OVER (PARTITION BY d.source ORDER BY d.size, {_sql_seeded('d.doc_id')}, d.doc_id NULLS FIRST) - 1 AS i
   FROM d JOIN u ON d.source IS NOT DISTINCT FROM u.source)
SELECT doc_id, size, ss AS source_size, target, CASE WHEN ss > 0 THEN CAST(size * (((i + 1) * tt + u) // ss - (i * tt + u) // ss) AS BIGINT) ELSE 0 END AS taken
FROM r
"""

QUERIES = {"op13_systematic_mix": query}
ORACLE = {"op13_systematic_mix": SQL}
