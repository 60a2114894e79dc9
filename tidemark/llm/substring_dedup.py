"""Substring dedup: Rabin-Karp hashes of every fixed-length token window.

Words are maximal runs of bytes other than x20 and x09 to x0D.  Every window
of ``WINDOW`` words of every text gets a Rabin-Karp hash (a polynomial over
the word hashes modulo 2**64, so each is one difference of prefix sums).
Spark deals the hashes to buckets and counts them (see ``window_counts``); each
document learns which of its hashes occur more than once in the corpus, and
the repeated windows merge into maximal removal intervals.

Windows are judged on the input: every occurrence goes, the first one too.
Equality of windows is that of 64-bit hashes: two different windows of n in all
meet with a chance of about n * n / 2**65 for the whole corpus.

Defined cases: null and empty texts have no words; a text shorter than a
window keeps all; rows that repeat are documents of their own, so their
windows are repeated; null ids are kept; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.staging import row_key
from tidemark.llm.textbytes import SPACE, SpanHash, fill_text, mix64, pieces, word_hashes, words_of
from tidemark.llm.window_counts import PACKED, TOLD, Told, answer, bucket_count, listed, pack, repeated

WINDOW = 35
_ROLL = SpanHash(23)


def window_hashes(raw: np.ndarray, off: np.ndarray, window: int):
    """(word starts, word ends, words of each text, windows of each text, window hashes) of a piece."""
    s, e, row = words_of(raw, off, SPACE)
    words = np.bincount(row, minlength=len(off) - 1)
    size = np.maximum(words - window + 1, 0)
    first = (np.cumsum(words) - words)
    at = np.repeat(first - (np.cumsum(size) - size), size) + np.arange(size.sum())
    h = mix64(_ROLL.spans(word_hashes(raw, s, e), at, at + window)) if len(at) else np.zeros(0, np.uint64)
    return s, e, words, size, h


def covered(mask: np.ndarray, length: int, window: int) -> np.ndarray:
    """Which of ``length`` places lie in a marked window; mask: by window start."""
    edge = np.zeros(length + 1, np.int64)
    at = np.flatnonzero(mask)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + window, -1)
    return np.cumsum(edge[:-1]) > 0


def _windows(window: int, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def stream():
            for b in batches:
                keys = b.column("rk").to_numpy()
                for i, j, raw, off in pieces(fill_text(b.column("text"))):
                    _, _, _, size, h = window_hashes(raw, off, window)
                    yield keys[i:j], size, h
        yield from pack(stream(), buckets)
    return run


def _cut(window: int, with_text: bool):
    def run(docs: pa.Table, told: pa.Table) -> pa.Table:
        known = Told(told, TOLD)
        keys = docs.column("rk").to_numpy()
        rows: list[list] = [[], [], [], []]
        for i, j, raw, off in pieces(fill_text(docs.column("text"))):
            s, e, words, size, h = window_hashes(raw, off, window)
            whole = raw.tobytes()
            word, at = 0, 0
            for k in range(j - i):
                n, m = int(words[k]), int(size[k])
                gone = covered(listed(h[at: at + m], known.of(keys[i + k])), n, window)
                keep = np.flatnonzero(~gone) + word
                kept = b" ".join([whole[a:z] for a, z in zip(s[keep].tolist(), e[keep].tolist())])
                for column, v in zip(rows, (n, int(gone.sum()), hashlib.sha256(kept).hexdigest(), kept.decode() if with_text else None)):
                    column.append(v)
                word, at = word + n, at + m
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.string())
        return pa.table([docs.column("doc_id"), *(pa.array(c, t) for c, t in zip(rows, kinds))],
                        names=["doc_id", "n_words", "n_removed", "kept_sha256", "kept"])
    return run


def remove_repeats(docs: DataFrame, window: int = WINDOW, with_text: bool = True) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256, kept (the kept words joined by a space; null unless ``with_text``)."""
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), row_key("doc_id", "text").alias("rk"), "text")
    text_bytes = src.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = bucket_count(src, text_bytes // 6)
    told = repeated(src.select("rk", "text").mapInArrow(_windows(window, buckets), PACKED), buckets)
    return answer(src, told, buckets, _cut(window, with_text), "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"), with_text=False).drop("kept")


SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
w AS (SELECT r, i, array_to_string(ws[i:i + {WINDOW - 1}], ' ') AS g FROM (SELECT r, ws, unnest(range(1, len(ws) - {WINDOW - 2})) AS i FROM d WHERE len(ws) >= {WINDOW})),
m AS (SELECT r, i, count(*) OVER (PARTITION BY g) > 1 AS again FROM w),
c AS (SELECT DISTINCT r, unnest(range(i, i + {WINDOW})) AS p FROM m WHERE again),
k AS (SELECT r, p, ws[p] AS x FROM (SELECT r, ws, unnest(range(1, len(ws) + 1)) AS p FROM d) ANTI JOIN c USING (r, p)),
t AS (SELECT r, string_agg(x, ' ' ORDER BY p) AS kept, count(*) AS n FROM k GROUP BY r)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN t USING (r)
"""

QUERIES = {"op5_substring_dedup": query}
ORACLE = {"op5_substring_dedup": SQL}
