"""Phrase collocation mining over sorted count streams.

1. Counting.  A task tokenises about ``CHUNK`` words at a time, numbers the words by
   their byte order, and counts its 1 to 3 word phrases as sorted runs of packed
   numbers.  The runs travel compressed, dealt to buckets by phrase; a bucket adds
   them up and keeps what occurs ``MIN_COUNT`` times.  Parts of a frequent phrase are at least
   as frequent, so nothing that a later step asks for is lost.
2. Prefix order.  The stream of all phrases and counts is sorted by its words from the first
   on: a word stands before the pairs that begin with it, a pair before its
   triples.  One pass in lockstep hands every phrase the counts of the parts it begins
   with, and every pair the largest count of a triple that extends it to the right.
3. Suffix order.  The same pass over the phrases sorted from their last word
   backwards gives the counts of the parts that they end with, and the largest extension to the left.
4. Scores are integers of exact decimals; the best of each language are ranked.

No step looks a phrase up in a hash table: the streams are range-partitioned and
sorted, and the pass needs two counts and one open pair of memory.  Where a
range ends inside a group, the next range's rows get the open counts from
a list with one entry per range (so a word in a third of all phrases is spread
over many ranges).

Defined cases: null texts are empty; a null lang is ``und``; repeated rows
count each; a text of any length is counted in slices; an empty table gives no
rows; only lang and text are read.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.decontaminate import bounded
from tidemark.llm.staging import staged
from tidemark.llm.textbytes import buffers, fill_text, mix64, pieces, word_hashes, words_of

MIN_COUNT = 10
TOP = 2000
#: A pair goes when a longer phrase around it has this share (percent) of its count.
SHARE = 50
NO_LANG = "und"
#: Words that a task counts at a time; a word's number takes 21 bits of a triple's.
CHUNK = 500_000
BITS = 21
WORDS_PER_BUCKET = 1_000_000
#: Parts into which a language's candidates are ranked before the last ranking.
SALTS = 32

PACKED = "bucket int, lang string, sizes binary, phrases binary, counts binary, raw long"
_CODEC = "zstd"


def _bytes_table(chars: bytes) -> np.ndarray:
    t = np.zeros(256, bool)
    t[list(chars)] = True
    return t


#: What ends a piece, and what parts words.
PIECE_END = _bytes_table(b".,;:!?\x0a\x0b\x0c\x0d")
PARTS = PIECE_END | _bytes_table(b" \t")
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def tokens(texts: pa.Array) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """(words, whether each word's successor follows in the same piece) of runs of whole texts."""
    for _, _, raw, off in pieces(fill_text(texts)):
        raw = LOWER[raw]
        s, e, row = words_of(raw, off, PARTS)
        if len(s) == 0:
            continue
        ends = np.cumsum(PIECE_END[raw])
        joined = np.zeros(len(s), bool)
        joined[:-1] = (row[1:] == row[:-1]) & (ends[s[1:]] == ends[e[:-1] - 1])
        offsets = np.append(0, np.cumsum(e - s)).astype(np.int64)
        data = raw[~PARTS[raw]]
        yield pa.LargeStringArray.from_buffers(len(s), pa.py_buffer(offsets), pa.py_buffer(data)), joined


def _runs(words: pa.Array, joined: np.ndarray, starts: int) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
    """(phrases, counts, hashes) of each length, in word order, of the phrases that begin at the first ``starts`` words."""
    code = words.dictionary_encode()
    rising = pc.sort_indices(code.dictionary).to_numpy()
    rank = np.empty(len(rising), np.int64)
    rank[rising] = np.arange(len(rising))
    ids, names = rank[code.indices.to_numpy()], code.dictionary.take(pa.array(rising))
    raw, off = buffers(names)
    h = word_hashes(raw, off[:-1], off[1:])
    at = np.arange(starts)
    key = ids[at]
    for length in (1, 2, 3):
        if length > 1:
            go = joined[at + length - 2]
            at, key = at[go], key[go]
            key = key << BITS | ids[at + length - 1]
        unique, counts = np.unique(key, return_counts=True)
        if len(unique) == 0:
            return
        part = [unique >> BITS * (length - 1 - j) & (1 << BITS) - 1 for j in range(length)]
        mixed = h[part[0]]
        for p in part[1:]:
            mixed = mix64(mixed * np.uint64(0x9E3779B97F4A7C15) + h[p])
        taken = [names.take(pa.array(p)) for p in part]
        yield taken[0] if length == 1 else pc.binary_join_element_wise(*taken, pa.scalar(" ", pa.large_string())), counts, mixed


def _packed_row(bucket: int, lang: str, phrases: pa.Array, counts: np.ndarray) -> tuple:
    raw, off = buffers(phrases)
    body = pa.compress(raw.tobytes(), codec=_CODEC, asbytes=True)
    sizes, counts = (pa.compress(x.astype(np.uint32).tobytes(), codec=_CODEC, asbytes=True) for x in (np.diff(off), counts))
    return int(bucket), lang, sizes, body, counts, (len(off) - 1) << 32 | len(raw)


def _unpacked(row: dict) -> tuple[pa.Array, np.ndarray]:
    n, size = row["raw"] >> 32, row["raw"] & 0xFFFFFFFF
    sizes, counts = (np.frombuffer(pa.decompress(row[c], decompressed_size=4 * n, codec=_CODEC, asbytes=True), np.uint32) for c in ("sizes", "counts"))
    body = pa.decompress(row["phrases"], decompressed_size=size, codec=_CODEC, asbytes=True) if size else b""
    offsets = np.append(0, np.cumsum(sizes, dtype=np.int64))
    return pa.LargeStringArray.from_buffers(n, pa.py_buffer(offsets), pa.py_buffer(body)), counts


def _chunk_rows(lang: str, words: pa.Array, joined: np.ndarray, buckets: int) -> Iterator[tuple]:
    """Packed rows, one per bucket and length, of one language's words; the empty phrase counts the words."""
    yield _packed_row(0, lang, pa.array([""], pa.large_string()), np.array([len(words)]))
    for i in range(0, len(words), CHUNK):
        for phrases, counts, h in _runs(words.slice(i, CHUNK + 2), joined[i: i + CHUNK + 2], min(CHUNK, len(words) - i)):
            bucket = (h % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            cut = np.searchsorted(bucket[order], np.arange(buckets + 1))
            for b in np.flatnonzero(np.diff(cut)):
                here = order[cut[b]: cut[b + 1]]
                yield _packed_row(b, lang, phrases.take(pa.array(here)), counts[here])


_ARROW = pa.schema([("bucket", pa.int32()), ("lang", pa.string()), ("sizes", pa.binary()), ("phrases", pa.binary()), ("counts", pa.binary()), ("raw", pa.int64())])


def _counted(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pa.set_memory_pool(pa.system_memory_pool())  # gives what is freed back, while the worker lives on
        held: dict[str, list] = defaultdict(list)
        total = 0

        def flush() -> Iterator[pa.RecordBatch]:
            rows: list[tuple] = []
            while held:
                lang, found = held.popitem()
                words, joined = zip(*found)
                del found
                for row in _chunk_rows(lang, pa.concat_arrays(words), np.concatenate(joined), buckets):
                    rows.append(row)
                    if len(rows) == 64:
                        yield pa.record_batch(list(map(list, zip(*rows))), schema=_ARROW)
                        rows = []
            if rows:
                yield pa.record_batch(list(map(list, zip(*rows))), schema=_ARROW)

        for b in batches:
            langs = b.column("lang").dictionary_encode()
            codes = langs.indices.to_numpy()
            for code, lang in enumerate(langs.dictionary.to_pylist()):
                for words, joined in tokens(b.column("text").filter(pa.array(codes == code))):
                    held[lang].append((words, joined))
                    total += len(words)
                    if total >= CHUNK:
                        yield from flush()
                        total = 0
        if total:
            yield from flush()
    return run


def _added(least: int):
    def run(table: pa.Table) -> pa.Table:
        pa.set_memory_pool(pa.system_memory_pool())
        phrases, counts = zip(*map(_unpacked, table.to_pylist()))
        all_ = pa.table({"phrase": pa.chunked_array(phrases), "f": np.concatenate(counts).astype(np.int64)})
        sums = all_.group_by("phrase").aggregate([("f", "sum")])
        kept = sums.filter(pc.or_(pc.greater_equal(sums["f_sum"], least), pc.equal(sums["phrase"], "")))
        lang = pa.array([table.column("lang")[0].as_py()] * len(kept), pa.string())
        return pa.table([lang, kept["phrase"].cast(pa.string()), kept["f_sum"]], names=["lang", "phrase", "f"])
    return run


def phrase_counts(docs: DataFrame, least: int = MIN_COUNT) -> DataFrame:
    """lang, phrase, f of all phrases of 1 to 3 words that occur ``least`` times in their
    language; the phrase '' has the language's number of words."""
    src = docs.select(F.coalesce("lang", F.lit(NO_LANG)).alias("lang"), "text")
    size = src.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), size // 6 // WORDS_PER_BUCKET + 1)
    packed = src.where("text <> ''").mapInArrow(_counted(buckets), PACKED)
    return packed.groupBy("bucket", "lang").applyInArrow(_added(least), "lang string, phrase string, f long")


ROW, OPEN, RANGE = range(3)


def _pass(names: list[str], types: list[pa.DataType]):
    """One range of the sorted stream: adds _word and _pair, the counts of the last word and pair
    before the row (-1: in an earlier range), and _more, a pair's largest triple.  The last row tells
    what the range leaves open."""
    schema = pa.schema([*zip(names, types), ("_part", pa.int32()), ("_kind", pa.int32()), ("_word", pa.int64()), ("_pair", pa.int64()), ("_more", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        word = pair = -1
        head, opened, opened_more = 0, None, 0

        def out(columns, kind, words, pairs, more):
            n = len(more)
            return pa.record_batch([*columns, pa.array(np.full(n, part, np.int32)), pa.array(np.full(n, kind, np.int32)), *(pa.array(x, pa.int64()) for x in (words, pairs, more))], schema=schema)

        for b in batches:
            if b.num_rows == 0:
                continue
            f, length = b.column("f").to_numpy(), b.column("_length").to_numpy()
            at = np.arange(len(f))
            last_word = np.maximum.accumulate(np.where(length == 1, at, -1))
            last_pair = np.maximum.accumulate(np.where(length == 2, at, -1))
            words, pairs = np.where(last_word >= 0, f[last_word], word), np.where(last_pair >= 0, f[last_pair], pair)
            more, triple = np.zeros(len(f), np.int64), length == 3
            inside = triple & (last_pair >= 0)
            np.maximum.at(more, last_pair[inside], f[inside])
            before = int(f[triple & (last_pair < 0)].max(initial=0))
            if opened is None:
                head = max(head, before)
            else:
                opened_more = max(opened_more, before)
            word, pair, keep = int(words[-1]), int(pairs[-1]), np.ones(len(f), bool)
            if last_pair[-1] >= 0:  # the last pair stays open: triples of the next batch may extend it
                if opened is not None:
                    yield out(opened[0].columns, ROW, *opened[1], [opened_more])
                i = int(last_pair[-1])
                opened, opened_more, keep[i] = (b.slice(i, 1), ([words[i]], [pairs[i]])), int(more[i]), False
            yield out(b.filter(pa.array(keep)).columns, ROW, words[keep], pairs[keep], more[keep])
        if opened is not None:
            yield out(opened[0].columns, OPEN, *opened[1], [opened_more])
        yield out([pa.nulls(1, t) for t in types], RANGE, [word], [pair], [head])
    return run


def _open_counts(ranges: list) -> list[tuple[int, int, int, int]]:
    """(range, word and pair that are open at its start, largest triple of its last pair in later ranges)."""
    got, word, pair, owner = [], -1, -1, None
    for r in sorted(ranges, key=lambda r: r["_part"]):
        if owner is not None:
            got[owner][3] = max(got[owner][3], r["_more"])
        got.append([r["_part"], word, pair, 0])
        word = r["_word"] if r["_word"] >= 0 else word
        if r["_pair"] >= 0:
            pair, owner = r["_pair"], len(got) - 1
    return [tuple(g) for g in got]


def lockstep(spark: SparkSession, stream: DataFrame, keys: list[Column], names: tuple[str, str, str]) -> DataFrame:
    """``stream`` (lang, phrase, f, _length, ...) with three columns: the counts of the word and
    of the pair that open its order by ``keys``, and a pair's largest extension in that order."""
    spread = stream.select("*", *[k.alias(f"_k{i}") for i, k in enumerate(keys)])
    order = ["lang", *(f"_k{i}" for i in range(len(keys)))]
    ordered = spread.repartitionByRange(*order).sortWithinPartitions(*order).select(*stream.columns)
    types = [pa.string() if t == "string" else pa.int64() for _, t in ordered.dtypes]
    schema = ", ".join(f"{n} {t}" for n, t in ordered.dtypes) + ", _part int, _kind int, _word long, _pair long, _more long"
    table = staged(spark, ordered.mapInArrow(_pass(stream.columns, types), schema), "phrase-stream")
    # one row per range of the stream
    ranges = _open_counts(table.where(F.col("_kind") == RANGE).select("_part", "_word", "_pair", "_more").collect())
    opened = F.broadcast(spark.createDataFrame(ranges, "_part int, _w long, _p long, _m long"))
    own = table.where(F.col("_kind") != RANGE).join(opened, "_part")
    return own.select(*stream.columns, F.when(F.col("_word") < 0, F.col("_w")).otherwise(F.col("_word")).alias(names[0]),
                      F.when(F.col("_pair") < 0, F.col("_p")).otherwise(F.col("_pair")).alias(names[1]),
                      F.when(F.col("_kind") == OPEN, F.greatest("_more", "_m")).otherwise(F.col("_more")).alias(names[2]))


def _score(left: str, right: str) -> Column:
    """floor(1000000 a a / (l r)) in 38 digits, enough for 10**15 words."""
    a = "CAST(f AS DECIMAL(19,0))"
    return F.expr(f"(CAST({a} * {a} AS DECIMAL(31,0)) * 1000000) div (CAST({left} AS DECIMAL(19,0)) * CAST({right} AS DECIMAL(19,0)))")


def candidates(docs: DataFrame, least: int = MIN_COUNT, share: int = SHARE) -> DataFrame:
    """lang, phrase, a, l, r, n, score of every phrase of 2 or 3 words that occurs ``least`` times
    and is not mostly part of a longer one."""
    spark = docs.sparkSession
    counts = staged(spark, phrase_counts(docs, least), "phrase-counts")
    words = F.split("phrase", " ")
    stream = counts.where("phrase <> ''").withColumn("_length", F.size(words).cast("long"))
    forward = [F.get(words, F.lit(i)) for i in range(3)]
    backward = [F.get(F.reverse(words), F.lit(i)) for i in range(3)]
    stream = lockstep(spark, stream, forward, ("first", "first_two", "to_right"))
    stream = lockstep(spark, stream, backward, ("last", "last_two", "to_left"))
    early = F.when(F.col("_length") == 2, _score("first", "last")).otherwise(_score("first", "last_two"))
    late = F.when(F.col("_length") == 3, _score("first_two", "last"))
    scored = stream.where("_length > 1").withColumn("_early", early).withColumn("_late", late)
    late_counts = F.col("_late") < F.col("_early")  # null for pairs
    left = F.when(late_counts, F.col("first_two")).otherwise(F.col("first"))
    right = F.when(late_counts | (F.col("_length") == 2), F.col("last")).otherwise(F.col("last_two"))
    whole = (F.col("_length") == 3) | (100 * F.greatest("to_right", "to_left") < share * F.col("f"))
    n = counts.where("phrase = ''").select("lang", F.col("f").alias("n"))
    rows = scored.where(whole).select("lang", "phrase", F.col("f").alias("a"), left.alias("l"), right.alias("r"),
                                      F.least("_early", "_late").cast("long").alias("score"))
    return rows.join(bounded(n), "lang")  # one row per language; the candidates are not shuffled by it


def best(rows: DataFrame, top: int = TOP) -> DataFrame:
    """The first ``top`` of each language, with their rank; ranked in parts first."""
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    part = salted.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "_salt").orderBy(*order))).where(F.col("rank") <= top)
    return part.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top).drop("_salt")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("lang", "text")
    return best(candidates(docs)).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


SQL = rf"""
WITH p AS (SELECT coalesce(lang, '{NO_LANG}') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM p),
n AS (SELECT lang, CAST(sum(len(ws)) AS BIGINT) AS n FROM w GROUP BY lang),
g AS (SELECT lang, k, ws[i:i + k - 1] AS g FROM (SELECT lang, ws, k, unnest(range(1, len(ws) + 2 - k)) AS i FROM w, (VALUES (1), (2), (3)) AS v(k) WHERE len(ws) >= k)),
f AS (SELECT lang, k, g, CAST(count(*) AS HUGEINT) AS f FROM g GROUP BY ALL HAVING count(*) >= {MIN_COUNT}),
c AS (SELECT x.lang, x.k AS size, x.g, x.f AS a, l.f AS l, r.f AS r, cut, 1000000 * x.f * x.f // (l.f * r.f) AS score
   FROM (SELECT *, unnest(range(1, k)) AS cut FROM f WHERE k > 1) x JOIN f l ON l.lang = x.lang AND l.g = x.g[1:cut] JOIN f r ON r.lang = x.lang AND r.g = x.g[cut + 1:]),
o AS (SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, cut) = 1),
gone AS (SELECT DISTINCT b.lang, b.g FROM f t JOIN f b ON b.lang = t.lang AND b.k = 2 AND t.k = 3 AND (b.g = t.g[1:2] OR b.g = t.g[2:3]) AND 100 * t.f >= {SHARE} * b.f),
s AS (SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(g, ' ')) AS rank, array_to_string(g, ' ') AS phrase, a, l, r, score
   FROM o ANTI JOIN gone USING (lang, g))
SELECT s.lang, rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, n.n, CAST(score AS BIGINT) AS score
FROM s JOIN n USING (lang) WHERE rank <= {TOP}
"""

QUERIES = {"op11_phrase_streams": query}
ORACLE = {"op11_phrase_streams": SQL}
