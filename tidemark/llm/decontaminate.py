"""Benchmark decontamination by a broadcast hash set of normalised test n-grams.

Texts are lower-cased (A-Z only) and cut into words of ASCII digits and letters and
any non-ASCII characters.  A window is 10 consecutive words of a benchmark item;
an item of 1 to 9 words is one window of its own length.

1. The items' distinct window hashes form a hash set.  It is broadcast when a
   bounded count shows at most ``MAX_BROADCAST`` hashes (16 bytes each); a
   larger one is joined by a shuffle instead.
2. Every window of every document is hashed in place and looked up; only the
   hits leave the scan.
3. Hits are verified: the words at the hit are compared with the item's words.
4. Verified windows give the hit words, the items and the verdict.  ``drop``
   removes the documents, ``cut`` only the hit words.

Only DataFrame functions run here.  Defined cases: null and empty texts have
no words; items without words have no windows; an item whose id is null can hit
but is not named; rows that repeat (same doc_id and text) get the same result;
an empty benchmark hits nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.staging import packed_rows, row_key, staged

NGRAM = 10
#: Distinct window hashes (two 8-byte columns) that may be broadcast.
MAX_BROADCAST = 1_000_000

#: What separates words in lower-cased text; words, and what separates them, in text with capitals.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WORDS_CASED = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
SEPARATORS_CASED = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text) -> F.Column:
    """The normalised words of a text (null: none)."""
    return F.array_remove(F.split(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), SEPARATORS), "")


def bounded(df: DataFrame, rows: int = MAX_BROADCAST) -> DataFrame:
    """Broadcast ``df`` if a count that stops after ``rows`` rows shows it is that small."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def item_windows(benchmark: DataFrame, ngram: int = NGRAM) -> DataFrame:
    """item_id, size, gram (the words, space-joined), h of every distinct window."""
    w = benchmark.select(F.col("item_id"), words(F.col("text")).alias("ws")).where("size(ws) > 0")
    w = w.select("item_id", "ws", F.least(F.size("ws"), F.lit(ngram)).alias("size"))
    w = w.select("item_id", F.col("size"), F.explode(F.expr("transform(sequence(1, size(ws) - size + 1), i -> slice(ws, i, size))")).alias("g"))
    return w.select("item_id", "size", F.array_join("g", " ").alias("gram"), F.xxhash64("g").alias("h")).distinct()


def hits(docs: DataFrame, benchmark: DataFrame, ngram: int = NGRAM) -> DataFrame:
    """_k, _d, n_words, spans (start, size, item_id of verified windows; null if none) of every document."""
    spark = docs.sparkSession
    grams = staged(spark, item_windows(benchmark, ngram), "benchmark-windows")
    sizes = [r["size"] for r in grams.select("size").distinct().collect()]  # at most ngram values
    keyed = docs.select(row_key("doc_id", "text").alias("_k"), F.col("doc_id").alias("_d"), words(F.col("text")).alias("ws"))
    keyed = keyed.select("_k", "_d", "ws", F.size("ws").alias("n"))
    found = None
    for size in sizes:
        at = F.expr(f"CASE WHEN n >= {size} THEN transform(sequence(1, n - {size} + 1), i -> xxhash64(slice(ws, i, {size}))) ELSE array() END")
        scan = keyed.where(f"n >= {size}").select("_k", "_d", F.posexplode(at).alias("start", "h"))
        known = bounded(grams.where(F.col("size") == size).select("h", "size").distinct())
        got = scan.join(known, "h").select("_k", "_d", "start", "size")
        found = got if found is None else found.union(got)
    if found is None:
        return keyed.select("_k", "_d", F.col("n").alias("n_words"), F.lit(None).cast("array<struct<start:int,size:int,item_id:string>>").alias("spans"))
    spots = found.groupBy("_k", "_d").agg(F.collect_set(F.struct("start", "size")).alias("spots"))
    spots = staged(spark, spots, "benchmark-spots").withColumnRenamed("_k", "_k2").withColumnRenamed("_d", "_d2")
    both = keyed.join(spots.hint("shuffle_hash"), (F.col("_k") == F.col("_k2")) & F.col("_d").eqNullSafe(F.col("_d2")), "left")
    text = F.expr("transform(spots, s -> struct(s.start, s.size, array_join(slice(ws, s.start + 1, s.size), ' ') AS gram))")
    both = staged(spark, both.select("_k", "_d", F.col("n").alias("n_words"), text.alias("spots")), "benchmark-candidates")
    checked = both.select("_k", "_d", F.explode("spots").alias("s")).select("_k", "_d", "s.start", "s.size", "s.gram")
    checked = checked.join(bounded(grams.select("item_id", "size", "gram"), MAX_BROADCAST // 10), ["size", "gram"])
    spans = checked.groupBy("_k", "_d").agg(F.collect_set(F.struct("start", "size", F.col("item_id").cast("string").alias("item_id"))).alias("spans"))
    spans = spans.withColumnRenamed("_k", "_k2").withColumnRenamed("_d", "_d2")
    return both.join(spans, (F.col("_k") == F.col("_k2")) & F.col("_d").eqNullSafe(F.col("_d2")), "left").select("_k", "_d", "n_words", "spans")


def _hit_words() -> F.Column:
    return F.expr("coalesce(array_distinct(flatten(transform(spans, s -> sequence(s.start, s.start + s.size - 1)))), array())")


def report(docs: DataFrame, benchmark: DataFrame, ngram: int = NGRAM) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated of every document."""
    items = F.expr("coalesce(array_sort(array_distinct(filter(transform(spans, s -> s.item_id), x -> x IS NOT NULL))), array())")
    out = hits(docs, benchmark, ngram).select(F.col("_d").alias("doc_id"), F.col("n_words").cast("long").alias("n_words"),
                                              F.size(_hit_words()).cast("long").alias("n_hit"), items.alias("items"))
    return out.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                      F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def drop(docs: DataFrame, benchmark: DataFrame, ngram: int = NGRAM) -> DataFrame:
    """The documents without any hit, all columns kept."""
    bad = hits(docs, benchmark, ngram).where("spans IS NOT NULL").select(F.col("_k").alias("_k2"), F.col("_d").alias("_d2")).distinct()
    same = (F.col("_k") == F.col("_k2")) & F.col("_d").eqNullSafe(F.col("_d2"))
    return packed_rows(docs).join(bad.hint("shuffle_hash"), same, "left_anti").select("_row.*")


def cut(docs: DataFrame, benchmark: DataFrame, ngram: int = NGRAM) -> DataFrame:
    """The documents with the hit words (and what separates each from the next word) cut out of the text."""
    found = hits(docs, benchmark, ngram).where("spans IS NOT NULL").select(F.col("_k").alias("_k2"), F.col("_d").alias("_d2"), _hit_words().alias("_hit")).distinct()
    same = (F.col("_k") == F.col("_k2")) & F.col("_d").eqNullSafe(F.col("_d2"))
    own = F.array_remove(F.split("_row.text", SEPARATORS_CASED), "")
    between = F.split("_row.text", WORDS_CASED)
    out = packed_rows(docs).join(found.hint("shuffle_hash"), same, "left").select("_row", "_hit", own.alias("_ws"), between.alias("_sep"))
    keep = F.expr("array_except(sequence(0, size(_ws) - 1), _hit)")
    text = F.concat(F.col("_sep")[0], F.array_join(F.transform(keep, lambda i: F.concat(F.col("_ws")[i], F.col("_sep")[i + 1])), ""))
    out = out.select("_row", F.when(F.col("_hit").isNull(), F.col("_row.text")).otherwise(text).alias("_text"))
    fresh = {"text": F.col("_text"), "n_chars": F.length("_text").cast(dict(docs.dtypes).get("n_chars", "long"))}
    return out.select(*[fresh.get(c, F.col("_row")[c]).alias(c) for c in docs.columns])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


SQL = r"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
bz AS (SELECT item_id, ws, least(len(ws), 10) AS z FROM b WHERE len(ws) > 0),
bw AS (SELECT DISTINCT item_id, z, array_to_string(ws[i:i + z - 1], ' ') AS g FROM (SELECT item_id, ws, z, unnest(range(1, len(ws) - z + 2)) AS i FROM bz)),
zs AS (SELECT DISTINCT z FROM bw),
dw AS (SELECT r, z, i, array_to_string(ws[i:i + z - 1], ' ') AS g FROM (SELECT r, ws, z, unnest(range(1, len(ws) - z + 2)) AS i FROM d, zs WHERE len(ws) >= z)),
h AS (SELECT r, i, dw.z, item_id FROM dw JOIN bw USING (z, g)),
c AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + z)) AS p FROM h) GROUP BY r),
n AS (SELECT r, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS ids FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS x FROM h WHERE item_id IS NOT NULL) GROUP BY r)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN c USING (r) LEFT JOIN n USING (r)
"""

QUERIES = {"op4_decontaminate": query}
ORACLE = {"op4_decontaminate": SQL}
