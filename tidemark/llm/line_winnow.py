"""Line dedup by winnowing over line hashes.

1. Every text is a sequence of lines; blank lines take no part.  Of each
   window of ``run_lines`` line hashes the smallest (the rightmost of equal
   ones) is a fingerprint, so any run of ``run_lines`` lines that two places
   share holds a fingerprint that both places selected.  Lines of
   ``long_words`` words or more are fingerprints by themselves; with ``single_words``
   also those of that many words, told apart by any white space.
2. Fingerprints that occur at more than one place are joined back to their
   positions.
3. Each such position is extended both ways: the ``run_lines``-line windows
   that cover it (and the single line, if it is a fingerprint by itself) are compared by a 128-bit hash
   of their lines.  Longer runs are unions of these windows.
4. Of equal windows the first, by (doc_id, text hash, line), stays; the lines of
   later ones are deleted.  Windows are judged on the input.

``op6_line_winnow`` and the pipeline take ``SINGLE_WORDS``, so a line of that many words that
repeats between unlike neighbours goes too; ``op6_single_lines`` takes 1, so no later copy
of any line stays.  A line without white space is one word.

Only DataFrame functions run here.  Positions are only ever linked to the
group's first place (two map-side combined minima), never to each other, and
the joins that bring the answer back are salted, so a line that a third of
all documents share is spread over tasks.

Defined cases: a null text stays null, an empty one empty; lines match after
trimming spaces; rows that repeat (same doc_id and text) count as one document
and get the same result; a null doc_id sorts first; a text whose lines all go
becomes empty.  All input columns are kept, n_chars (if there) follows the text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.staging import packed_rows, row_key, staged

RUN_LINES = 2
LONG_WORDS = 50
#: Words from which on a line counts by itself, a parameter down to 1: shorter lines (headings, "Share this")
#: go with their neighbours only, unless it is lowered.
SINGLE_WORDS, EVERY_LINE = 8, 1
#: A word: anything between white space (the same in Java's and RE2's syntax).
WORD = r"[^\s\x0B\x{85}\p{Z}]+"
#: Parts into which each group of equal keys is dealt in joins.
SALTS = 16


def _positions(docs: DataFrame, t: int, long_words: int, single_words: int | None) -> DataFrame:
    """Fingerprints: _k, _d, place, h and the windows that cover the place."""
    base = docs.select(row_key("doc_id", "text").alias("_k"), F.col("doc_id").alias("_d"),
                       F.expr("filter(transform(split(text, '\n'), (l, i) -> struct(i AS i, trim(l) AS t)), x -> x.t <> '')").alias("items"))
    base = base.where("size(items) > 0").select("_k", "_d", F.expr("transform(items, x -> x.i)").alias("at"), F.expr("transform(items, x -> x.t)").alias("ts"))
    alone = f"length(x) - length(replace(x, ' ', '')) >= {long_words - 1}"
    if single_words is not None:
        alone += f" OR regexp_count(x, r'{WORD}') >= {single_words}"
    base = base.select("*", F.expr("transform(ts, x -> xxhash64(x))").alias("hs"), F.expr(f"transform(ts, x -> {alone})").alias("alone"), F.size("ts").alias("n"))
    minima = f"""CASE WHEN n >= {t} THEN transform(sequence(0, n - {t}), i ->
        i + {t} - CAST(array_position(reverse(slice(hs, i + 1, {t})), array_min(slice(hs, i + 1, {t}))) AS INT)) ELSE array() END"""
    base = base.select("*", F.expr(f"array_distinct(concat({minima}, filter(sequence(0, n - 1), p -> alone[p])))").alias("sel"))

    def window(start: str, size: str) -> str:
        part = f"slice(ts, {start} + 1, {size})"
        return f"struct(xxhash64({part}) AS w1, xxhash64(1, {part}) AS w2, slice(at, {start} + 1, {size}) AS rows)"

    around = f"CASE WHEN n >= {t} THEN transform(sequence(greatest(0, p - {t - 1}), least(p, n - {t})), s -> {window('s', str(t))}) ELSE array() END"
    own = f"CASE WHEN alone[p] THEN array({window('p', '1')}) ELSE array() END"
    # `hs`, `alone`, `n`, `ts` and `at` are each used more than once, so the optimiser keeps them as columns.
    out = base.select("_k", "_d", F.explode(F.expr(f"transform(sel, p -> struct(hs[p] AS h, at[p] AS place, concat({around}, {own}) AS wins))")).alias("f"))
    return out.select("_k", "_d", "f.h", "f.place", "f.wins")


def _salted(df: DataFrame) -> DataFrame:
    return df.withColumn("_s", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))


def _salt() -> Column:
    return F.pmod(F.col("_k"), F.lit(SALTS)).cast("int").alias("_s")


def repeated_lines(docs: DataFrame, run_lines: int = RUN_LINES, long_words: int = LONG_WORDS, single_words: int | None = None) -> DataFrame:
    """_k, _d, gone (sorted line numbers to delete) of each document that loses lines."""
    spark = docs.sparkSession
    found = staged(spark, _positions(docs, run_lines, long_words, single_words), "line-fingerprints")
    place = F.struct("_d", "_k", "place")
    again = found.groupBy("h").agg(F.min(place).alias("lo"), F.max(place).alias("hi")).where("lo <> hi").select("h")
    hits = found.select("*", _salt()).join(_salted(again), ["h", "_s"])
    windows = hits.select("_k", "_d", F.explode("wins").alias("w")).select("_k", "_d", "w.w1", "w.w2", "w.rows").distinct()
    first = F.struct("_d", "_k", F.element_at("rows", 1).alias("line"))
    group = windows.groupBy("w1", "w2").agg(F.min(first).alias("first"), F.max(first).alias("last")).where("first <> last").select("w1", "w2", "first")
    later = windows.select("*", _salt()).join(_salted(group), ["w1", "w2", "_s"]).where(first > F.col("first"))
    return later.groupBy("_k", "_d").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_set("rows")))).alias("gone"))


def dedup_lines(docs: DataFrame, run_lines: int = RUN_LINES, long_words: int = LONG_WORDS, report: bool = False, single_words: int | None = None) -> DataFrame:
    """``docs`` with later repeated runs deleted from ``text``; ``report`` adds n_lines and n_removed."""
    gone = staged(docs.sparkSession, repeated_lines(docs, run_lines, long_words, single_words), "line-gone")
    gone = gone.select(F.col("_k").alias("_k2"), F.col("_d").alias("_d2"), "gone")
    left = packed_rows(docs).join(gone.hint("shuffle_hash"), (F.col("_k") == F.col("_k2")) & F.col("_d").eqNullSafe(F.col("_d2")), "left")
    out = left.select("_row", "gone", F.split("_row.text", "\n").alias("_lines"))
    kept = F.expr("array_except(sequence(0, size(_lines) - 1), gone)")
    text = F.when(F.col("gone").isNull(), F.col("_row.text")).otherwise(F.array_join(F.transform(kept, lambda i: F.col("_lines")[i]), "\n"))
    lines = F.when(F.col("_lines").isNull(), 0).otherwise(F.size("_lines")).cast("long")
    removed = F.when(F.col("gone").isNull(), 0).otherwise(F.size("gone")).cast("long")
    out = out.select("_row", text.alias("_text"), lines.alias("_n"), removed.alias("_m"))
    fresh = {"text": F.col("_text"), "n_chars": F.length("_text").cast(dict(docs.dtypes).get("n_chars", "long"))}
    return out.select(*[fresh.get(c, F.col("_row")[c]).alias(c) for c in docs.columns],
                      *([F.col("_n").alias("n_lines"), F.col("_m").alias("n_removed")] if report else []))


def _query(single_words: int):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
        return dedup_lines(docs, report=True, single_words=single_words).select("doc_id", "n_lines", "n_removed", "text")
    return query


_SQL = f"""
WITH x AS (SELECT doc_id, text, string_split(text, chr(10)) AS ls, dense_rank() OVER (ORDER BY doc_id NULLS FIRST, text) AS k FROM documents),
l AS (SELECT k, unnest(ls) AS line, unnest(range(len(ls))) AS i FROM (SELECT DISTINCT k, ls FROM x WHERE text IS NOT NULL)),
s AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY i) AS p FROM (SELECT k, i, trim(line, ' ') AS t FROM l) WHERE t <> ''),
two AS (SELECT k, i, t AS a, lead(t) OVER w AS b, lead(i) OVER w AS i2 FROM s WINDOW w AS (PARTITION BY k ORDER BY p)),
w AS (SELECT k, i, [i, i2] AS rows, a || chr(10) || b AS g FROM two WHERE b IS NOT NULL
      UNION ALL SELECT k, i, [i], a FROM two WHERE length(a) - length(replace(a, ' ', '')) >= {LONG_WORDS - 1}),
r AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY k, i) AS nth FROM w),
g AS (SELECT DISTINCT k, unnest(rows) AS i FROM r WHERE nth > 1),
n AS (SELECT k, count(*) AS m FROM g GROUP BY k),
t AS (SELECT k, string_agg(line, chr(10) ORDER BY i) AS kept FROM l ANTI JOIN g USING (k, i) GROUP BY k)
SELECT doc_id, coalesce(len(ls), 0) AS n_lines, coalesce(m, 0) AS n_removed, CASE WHEN text IS NOT NULL THEN coalesce(kept, '') END AS text
FROM x LEFT JOIN n USING (k) LEFT JOIN t USING (k)
"""

_LONG = f"length(a) - length(replace(a, ' ', '')) >= {LONG_WORDS - 1}"


def _sql(single_words: int) -> str:
    return _SQL.replace(_LONG, f"({_LONG} OR len(regexp_extract_all(a, '{WORD}')) >= {single_words})")


SQL_SINGLE = _sql(SINGLE_WORDS)
QUERIES = {"op6_line_winnow": _query(SINGLE_WORDS), "op6_single_lines": _query(EVERY_LINE)}
ORACLE = {"op6_line_winnow": SQL_SINGLE, "op6_single_lines": _sql(EVERY_LINE)}
