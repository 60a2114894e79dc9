"""Document fingerprints by spot signatures.

Every occurrence of an anchor (a very common word) starts a chain: the first
``CHAIN`` content words among the ``REACH`` words that follow it.  Anchor and chain
make one signature (the first 8 hex digits of their MD5); a text's fingerprint is
the sorted set of its signatures.  A text with words but no whole chain has one
signature over all its words; a text without words has none.

Comparison: each set is labelled with its length partition, in steps of the
similarity threshold, so that sets whose partitions are not neighbours cannot reach
it.  Nothing here compares sets by partition: there is no pair search, and the query
drops the labels.  The Jaccard likeness to the edited and to the next text is exact;
only an empty side needs no intersection.

The next document, by ascending doc_id and round to the first, comes from a
window over id ranges of about ``RANGE_ROWS`` rows.  Ranges of equal width are counted, and those that
hold too many rows are cut again between their own smallest and largest id, so
clustered ids beside a far outlier spread too (up to ``LEVELS`` cuts; equal ids stay together).
The first row of each range is also given to the range before it, so no range waits for another; the
width follows from at most ``MAX_RANGES`` ranges.

Only DataFrame functions run here.  Defined cases: null texts count as empty; two
empty fingerprints have likeness 1, an empty and another one 0; a single document
is its own next; null ids sort first; rows with equal ids are ordered by a hash of
the text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.decontaminate import bounded
from tidemark.llm.staging import row_key, staged

CHAIN = 3
REACH = 10
THRESHOLD = 0.8
#: Rows of an id range, about (more than 4096 rows would spill in a window); ranges at most.
RANGE_ROWS, MAX_RANGES = 1500, 500_000
LEVELS = 6

#: Very common words that start a chain, and common words that a chain skips.
ANCHORS = ("a", "an", "and", "das", "de", "der", "des", "die", "el", "en", "et", "in", "is", "la", "le", "les", "los", "of", "que", "the", "to", "und", "zu")
STOP_WORDS = ANCHORS + (
    "als", "are", "as", "at", "au", "auf", "avec", "be", "by", "con", "dans", "dem", "den", "do", "du", "ein", "eine", "es", "est", "for", "für",
    "her", "his", "im", "ist", "it", "las", "lo", "mit", "nicht", "no", "not", "on", "or", "par", "para", "pas", "por", "pour", "qui", "se", "sich",
    "su", "sur", "that", "this", "un", "una", "une", "von", "was", "with", "y")

WORD_SPLIT = r"[^\p{L}\p{N}]+"


def _quoted(words: tuple[str, ...]) -> str:
    return ", ".join(f"'{w}'" for w in words)


def with_signatures(df: DataFrame, text: str, out: str) -> DataFrame:
    """Adds ``out``: the sorted signature set of the text column (null: empty)."""
    rest = df.columns
    df = df.select("*", F.array_remove(F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), WORD_SPLIT), "").alias("_w"))
    # `_w` is used more than once in each step, so the optimiser keeps it as a column.
    df = df.select("*", F.expr(f"CASE WHEN size(_w) > 0 THEN filter(sequence(0, size(_w) - 1), i -> _w[i] IN ({_quoted(ANCHORS)})) ELSE array() END").alias("_at"))
    chain = f"slice(filter(slice(_w, i + 2, {REACH}), x -> NOT x IN ({_quoted(STOP_WORDS)})), 1, {CHAIN})"
    df = df.select("*", F.expr(f"filter(transform(_at, i -> concat(array(_w[i]), {chain})), c -> size(c) = {CHAIN + 1})").alias("_c"))
    signs = f"array_sort(array_distinct(transform(_c, c -> substr(md5(array_join(c, ' ')), 1, 8))))"
    whole = "CASE WHEN size(_w) > 0 THEN array(substr(md5(array_join(_w, ' ')), 1, 8)) ELSE array() END"
    return df.select(*rest, F.expr(f"CASE WHEN size(_c) > 0 THEN {signs} ELSE {whole} END").alias(out))


def length_partition(signs: str, threshold: float = THRESHOLD) -> Column:
    """Sets can be as alike as the threshold only in the same or a neighbouring partition (no signatures: -1)."""
    return F.when(F.size(signs) > 0, F.floor(F.log(F.size(signs).cast("double")) / F.log(F.lit(1 / threshold)))).otherwise(-1).cast("int")


def likeness(a: str, b: str) -> Column:
    """Jaccard likeness of two sets; the length bound min/max prunes pairs with an empty side."""
    bound = F.least(F.size(a), F.size(b))
    both = F.size(F.array_intersect(a, b))
    exact = both / (F.size(a) + F.size(b) - both)
    return F.when(F.greatest(F.size(a), F.size(b)) == 0, F.lit(1.0)).when(bound == 0, F.lit(0.0)).otherwise(exact).cast("double")


def with_ranges(src: DataFrame) -> DataFrame:
    """``src`` with _range: rows with smaller doc_id never have a larger one (null ids: -1)."""
    spark = src.sparkSession
    n = src.count()
    rows = max(RANGE_ROWS, -(-n // MAX_RANGES))
    df = src.withColumn("_range", F.when(F.col("doc_id").isNull(), F.lit(-1)).otherwise(F.lit(0)).cast("long"))
    for level in range(LEVELS):
        ids = F.col("doc_id").cast("decimal(20,0)")
        cells = df.where("_range >= 0").groupBy("_range").agg(F.count("*").alias("_n"), F.min(ids).alias("_low"), F.max(ids).alias("_high"))
        if level and cells.where((F.col("_n") > 2 * rows) & (F.col("_low") < F.col("_high"))).limit(1).count() == 0:
            break
        # parts of a range too large, 1 of any other; one row per range from here on
        parts = F.when(F.col("_n") > (2 * rows if level else 0), F.ceil(F.col("_n") / rows)).otherwise(1).cast("decimal(20,0)")
        before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
        cut = cells.withColumn("_parts", parts).select(
            F.col("_range").alias("_old"), "_low", F.coalesce(F.sum("_parts").over(before), F.lit(0)).cast("long").alias("_base"),
            F.ceil((F.col("_high") - F.col("_low") + 1) / F.col("_parts")).cast("decimal(20,0)").alias("_width"))
        cut = staged(spark, cut, "id-ranges")
        finer = F.col("_base") + F.expr("(CAST(doc_id AS DECIMAL(20,0)) - _low) div _width")
        df = df.join(bounded(cut), F.col("_range") == F.col("_old"), "left") \
               .select(*src.columns, F.when(F.col("_old").isNull(), F.col("_range")).otherwise(finer).cast("long").alias("_range"))
    return df


def in_order(docs: DataFrame) -> tuple[DataFrame, Window]:
    """doc_id, text, _range, _last (a copy of the next range's first row) and the window that orders them."""
    src = with_ranges(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), row_key("doc_id", "text").alias("_k")))
    first = src.groupBy("_range").agg(F.min(F.struct("doc_id", "_k")).alias("f"))  # one row per range
    around = Window.orderBy("_range")
    prior = first.select(F.col("f._k").alias("_k"), F.col("f.doc_id").alias("_d"), F.coalesce(
        F.lag("_range").over(around), F.max("_range").over(around.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).alias("_to"))
    prior = F.broadcast(prior)
    copies = src.join(prior, (src["_k"] == prior["_k"]) & src["doc_id"].eqNullSafe(prior["_d"])).select(
        src["doc_id"], "text", src["_k"], F.col("_to").alias("_range"), F.lit(1).alias("_last"))
    whole = src.select("doc_id", "text", "_k", "_range", F.lit(0).alias("_last")).union(copies)
    return whole, Window.partitionBy("_range").orderBy("_last", "doc_id", "_k")


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next,
    length_partition, edited_length_partition of every document."""
    whole, order = in_order(docs)
    df = with_signatures(whole, "text", "signs")
    df = df.select("*", F.lead("text").over(order).alias("_next"), F.lead("signs").over(order).alias("_next_signs")).where("_last = 0")
    half = F.floor(F.length("text") / 2).cast("int")
    edited = F.concat(F.expr("substring(text, 1, length(text) - CAST(floor(length(text) / 2) AS INT))"), F.substring(F.col("_next"), F.lit(1), half))
    df = df.select("doc_id", F.length("text").cast("long").alias("n_chars"), "signs", "_next_signs", edited.alias("edited"))
    df = df.select("*", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"))
    df = with_signatures(df, "edited", "edited_signs")
    return df.select("doc_id", "n_chars", "edited_sha256", F.array_join("signs", "").alias("fingerprint"), F.array_join("edited_signs", "").alias("edited_fingerprint"),
                     likeness("signs", "edited_signs").alias("near_edited"), likeness("signs", "_next_signs").alias("near_next"),
                     length_partition("signs").alias("length_partition"), length_partition("edited_signs").alias("edited_length_partition"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("length_partition", "edited_length_partition")


def _sql_signs(text: str) -> str:
    return f"list_filter(regexp_split_to_array(lower({text}), '{WORD_SPLIT}'), lambda x: x <> '')"


def _sql_set(w: str) -> str:
    chain = f"list_filter({w}[i + 1:i + {REACH}], lambda x: x NOT IN ({_quoted(STOP_WORDS)}))[1:{CHAIN}]"
    chains = f"list_filter(list_transform(list_filter(range(1, len({w}) + 1), lambda i: {w}[i] IN ({_quoted(ANCHORS)})), lambda i: list_concat([{w}[i]], {chain})), lambda c: len(c) = {CHAIN + 1})"
    return f"""CASE WHEN len({chains}) > 0 THEN list_sort(list_distinct(list_transform({chains}, lambda c: md5(array_to_string(c, ' '))[1:8])))
        WHEN len({w}) > 0 THEN [md5(array_to_string({w}, ' '))[1:8]] ELSE CAST([] AS VARCHAR[]) END"""


def _sql_near(a: str, b: str) -> str:
    both = f"len(list_intersect({a}, {b}))"
    return f"CASE WHEN len({a}) + len({b}) = 0 THEN 1.0 ELSE CAST({both} AS DOUBLE) / (len({a}) + len({b}) - {both}) END"


SQL = f"""
WITH o AS (SELECT doc_id, coalesce(text, '') AS text, row_number() OVER (ORDER BY doc_id) AS r, count(*) OVER () AS n FROM documents),
p AS (SELECT a.doc_id, a.text, b.text AS nxt FROM o a JOIN o b ON b.r = a.r % a.n + 1),
e AS (SELECT *, substr(text, 1, length(text) - length(text) // 2) || substr(nxt, 1, length(text) // 2) AS edited FROM p),
w AS (SELECT *, {_sql_signs('text')} AS w1, {_sql_signs('nxt')} AS w2, {_sql_signs('edited')} AS w3 FROM e),
s AS (SELECT *, {_sql_set('w1')} AS s1, {_sql_set('w2')} AS s2, {_sql_set('w3')} AS s3 FROM w)
SELECT doc_id, length(text) AS n_chars, sha256(edited) AS edited_sha256, array_to_string(s1, '') AS fingerprint,
       array_to_string(s3, '') AS edited_fingerprint, {_sql_near('s1', 's3')} AS near_edited, {_sql_near('s1', 's2')} AS near_next
FROM s
"""

QUERIES = {"op3_spot_signatures": query}
ORACLE = {"op3_spot_signatures": SQL}
