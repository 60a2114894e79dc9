"""SimHash near-duplicates through a segment-popcount embedding.

Fingerprint: bit k of a document is 1 if it is set in more than half of the
XXH64 hashes (seed 42) of its 4-word shingles, repeats included.

Search: each distinct 64-bit fingerprint is mapped to the bit counts of its 32
two-bit segments.  The Manhattan distance of two such vectors never exceeds
the Hamming distance, so it is a lower bound.  The grid: the 32 coordinates
are dealt into ``GROUPS`` groups; vectors within Manhattan distance D differ
in at most D groups and so agree in at least GROUPS - D.  A fingerprint is
placed in one cell for each choice of GROUPS - D groups (the cell holds those
counts exactly), so any two fingerprints within D bits meet in some cell.
Inside a cell the Manhattan bound comes first, then the exact Hamming check.

Cells stream through tasks sorted by cell.  A small cell is compared by
shifts of the sorted rows; in a larger one links spread from a frontier
(each fingerprint is reached once), so a tight group of m fingerprints gives
m - 1 links, not m*m.  Cells of more than ``BLOCK`` fingerprints are cut into
blocks of rows; every pair of blocks is its own group, so no task ever holds
more than two blocks.  Equal texts and equal fingerprints are one node.

Defined cases: null and empty texts have fingerprint zero and link like any
other; repeated rows share a fingerprint; a component whose ids are all null
has a null id; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.staging import components, packed_rows, row_key, staged
from tidemark.llm.textbytes import SPACE, fill_text, pieces, words_of

SHINGLE = 4
SEED = 42
MAX_BITS = 4
#: Groups of coordinates; a cell fixes GROUPS - MAX_BITS of them.
GROUPS = 7
#: Cells up to this size are compared by shifts.
SMALL = 12
#: Rows of a cell that one block holds.
BLOCK = 50_000


def _lower_words(raw: np.ndarray, off: np.ndarray) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased words joined by one space: (bytes, starts, ends, row)."""
    raw = np.where((raw >= 65) & (raw <= 90), raw + 32, raw).astype(np.uint8)
    s, e, row = words_of(raw, off, SPACE)
    sep = SPACE[raw]
    keep = ~sep
    keep[:-1] |= ~sep[1:]
    to = np.cumsum(keep) - 1
    raw[sep] = 32
    return raw[keep].tobytes(), to[s] if len(s) else s, to[e - 1] + 1 if len(e) else e, row


def fingerprints(raw: np.ndarray, off: np.ndarray, shingle: int = SHINGLE) -> np.ndarray:
    """One uint64 fingerprint per text of a piece."""
    n = len(off) - 1
    text, s, e, row = _lower_words(raw, off)
    out = np.zeros(n, np.uint64)
    if len(s) == 0:
        return out
    count = np.bincount(row, minlength=n)
    first = np.cumsum(count) - count
    size = np.where(count > 0, np.maximum(count - shingle + 1, 1), 0)
    owner = np.repeat(np.arange(n), size)
    at = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + first[owner]
    last = np.minimum(at + shingle - 1, (first + count - 1)[owner])
    h64 = xxhash.xxh64_intdigest
    h = np.fromiter((h64(text[a:b], SEED) for a, b in zip(s[at].tolist(), e[last].tolist())), np.uint64, len(at))
    some = np.flatnonzero(size)
    begin = (np.cumsum(size) - size)[some]
    votes = np.zeros((len(some), 64), np.int64)
    step = 1 << 17
    for a in range(0, len(h), step):  # bounded memory: 64 bytes a shingle
        bits = np.unpackbits(h[a: a + step].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        lo, hi = np.searchsorted(begin, a, side="right") - 1, np.searchsorted(begin, a + len(bits), side="left")
        votes[lo:hi] += np.add.reduceat(bits, np.maximum(begin[lo:hi] - a, 0), axis=0, dtype=np.int64)
    major = (2 * votes > size[some][:, None]).astype(np.uint8)
    out[some] = np.packbits(major, axis=1, bitorder="little").view("<u8").ravel()
    return out


def _fingerprint_batches(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [np.zeros(0, np.uint64)] + [fingerprints(raw, off, shingle) for _, _, raw, off in pieces(fill_text(b.column("text")))]
            yield pa.record_batch([b.column("doc_id"), b.column("rk"), pa.array(np.concatenate(got).view(np.int64))], names=["doc_id", "rk", "fp"])
    return run


def with_fingerprint(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, rk (row identity), fp (the fingerprint's 64 bits as a long) of every document."""
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), row_key("doc_id", "text").alias("rk"), "text")
    return src.mapInArrow(_fingerprint_batches(shingle), "doc_id long, rk long, fp long")


def embedding(fp: np.ndarray) -> np.ndarray:
    """Bit counts of the 32 two-bit segments of each fingerprint."""
    pair = fp.astype(np.uint64)
    pair = (pair & np.uint64(0x5555555555555555)) + ((pair >> np.uint64(1)) & np.uint64(0x5555555555555555))
    return ((pair[:, None] >> (np.arange(0, 64, 2, dtype=np.uint64))[None, :]) & np.uint64(3)).astype(np.int8)


def hamming(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b)


def _close(fp: np.ndarray, emb: np.ndarray, i: np.ndarray, j: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The pairs that pass the Manhattan bound and then the Hamming check."""
    near = np.abs(emb[i] - emb[j]).sum(axis=1) <= max_bits
    i, j = i[near], j[near]
    near = hamming(fp[i], fp[j]) <= max_bits
    return i[near], j[near]


def _cells(max_bits: int, groups: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = np.array_split(np.arange(32), groups)
        for b in batches:
            fp = b.column("fp").to_numpy().view(np.uint64)
            emb = embedding(fp).astype(np.int64)
            code = np.stack([emb[:, p] @ (3 ** np.arange(len(p))) for p in parts], axis=1)
            width = 3 ** max(len(p) for p in parts)
            for table, chosen in enumerate(combinations(range(groups), groups - max_bits)):
                cell = np.full(len(fp), table, np.int64)
                for g in chosen:
                    cell = cell * width + code[:, g]
                yield pa.record_batch([pa.array(cell), b.column("fp")], names=["cell", "fp"])
    return run


def _spread(fp: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that span each linked group among ``fp``: from a frontier to the rest."""
    emb = embedding(fp)
    rest = np.arange(1, len(fp))
    frontier, a, b = [0], [], []
    while len(rest):
        if not frontier:
            frontier, rest = [int(rest[0])], rest[1:]
            continue
        f = frontier.pop()
        near = rest[np.abs(emb[rest] - emb[f]).sum(axis=1) <= max_bits]
        near = near[hamming(fp[near], fp[f]) <= max_bits]
        if len(near):
            a.append(np.full(len(near), f))
            b.append(near)
            frontier.extend(near.tolist())
            rest = rest[~np.isin(rest, near)]
    none = np.zeros(0, np.int64)
    return (np.concatenate(a), np.concatenate(b)) if a else (none, none)


def link_sorted(cell: np.ndarray, fp: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Verified links (indices) of rows sorted by cell."""
    new = np.ones(len(cell), bool)
    new[1:] = cell[1:] != cell[:-1]
    at = np.flatnonzero(new)
    size = np.diff(np.append(at, len(cell)))
    a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    left = np.repeat(np.where(size <= SMALL, at + size, 0), size)  # end of a small cell, else 0
    emb = embedding(fp)
    index = np.arange(len(cell))
    for shift in range(1, SMALL):
        i = index[index + shift < left]
        if len(i) == 0:
            break
        i, j = _close(fp, emb, i, i + shift, max_bits)
        a.append(i)
        b.append(j)
    for k in np.flatnonzero(size > SMALL):
        i, j = _spread(fp[at[k]: at[k] + size[k]], max_bits)
        a.append(i + at[k])
        b.append(j + at[k])
    return np.concatenate(a), np.concatenate(b)


class Forest:
    """Linked fingerprints of one task: each points towards the smallest of its group."""

    def __init__(self) -> None:
        self.up: dict[int, int] = {}

    def root(self, x: int) -> int:
        path = []
        while (y := self.up.get(x, x)) != x:
            path.append(x)
            x = y
        for y in path:
            self.up[y] = x
        return x

    def link(self, a: list[int], b: list[int]) -> None:
        for x, y in zip(a, b):
            x, y = self.root(x), self.root(y)
            self.up[max(x, y)] = self.up[min(x, y)] = min(x, y)


def _link_batches(max_bits: int):
    """Streams rows sorted by cell; the last, unfinished cell is carried over.  A task's
    links come out as one edge from each linked fingerprint to its group's smallest."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_key, held_fp, forest = np.zeros(0, np.int64), np.zeros(0, np.uint64), Forest()

        def link(key, fp):
            i, j = link_sorted(key, fp, max_bits)
            forest.link(fp[i].view(np.int64).tolist(), fp[j].view(np.int64).tolist())

        for b in batches:
            key = np.concatenate([held_key, b.column("cell").to_numpy()])
            fp = np.concatenate([held_fp, b.column("fp").to_numpy().view(np.uint64)])
            cut = int(np.searchsorted(key, key[-1])) if len(key) else 0
            if cut:
                link(key[:cut], fp[:cut])
            held_key, held_fp = key[cut:], fp[cut:]
        if len(held_key):
            link(held_key, held_fp)
        nodes = [x for x in forest.up if forest.root(x) != x]
        yield pa.record_batch([pa.array(nodes, pa.int64()), pa.array([forest.root(x) for x in nodes], pa.int64())], names=["a", "b"])
    return run


def links(nodes: DataFrame, max_bits: int = MAX_BITS, groups: int = GROUPS, block: int = BLOCK) -> DataFrame:
    """Links (a, b) that span every group of the distinct fingerprints ``nodes`` (fp) within ``max_bits``."""
    spark = nodes.sparkSession
    cells = nodes.select("fp").mapInArrow(_cells(max_bits, groups), "cell long, fp long")
    cells = staged(spark, cells, "simhash-cells")
    big = cells.groupBy("cell").agg(F.count("*").alias("n")).where(F.col("n") > block)
    big = staged(spark, big, "simhash-large-cells")
    plain, extra = cells, None
    if not big.isEmpty():
        # Cells over one block: each row goes to the groups of all pairs of blocks that hold its block.
        blocks = F.ceil(F.col("n") / block).cast("int")
        mine = F.pmod(F.xxhash64("fp"), blocks)
        other = F.explode(F.sequence(F.lit(0), blocks - 1))
        held = cells.join(big, "cell").select("cell", "fp", blocks.alias("m"), mine.cast("int").alias("x"), other.alias("y"))
        pair = F.xxhash64("cell", F.least("x", "y"), F.greatest("x", "y"))
        extra = held.select(pair.alias("cell"), "fp")
        plain = cells.join(big, "cell", "left_anti")
    out = None
    for part in (plain, extra):
        if part is not None:
            got = part.repartition("cell").sortWithinPartitions("cell").mapInArrow(_link_batches(max_bits), "a long, b long")
            out = got if out is None else out.union(got)
    return out


def near_groups(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """doc_id, rk, fp, component_id of every document."""
    spark = docs.sparkSession
    fps = staged(spark, with_fingerprint(docs, shingle), "simhash-fingerprints")
    nodes = staged(spark, fps.groupBy("fp").agg(F.min("doc_id").alias("low")), "simhash-nodes")
    roots = components(spark, links(nodes, max_bits))
    named = nodes.join(roots, nodes["fp"] == roots["node"], "left").select("fp", "low", F.coalesce("root", "fp").alias("root"))
    lowest = named.groupBy("root").agg(F.min("low").alias("component_id"))
    named = staged(spark, named.join(lowest, "root").select("fp", "component_id", "root"), "simhash-components")
    return fps.join(named, "fp").select("doc_id", "rk", "fp", "component_id", "root")


def keep_one(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """One document (all its columns) of each group: the one with the smallest doc_id (null ids last)."""
    spark = docs.sparkSession
    groups = staged(spark, near_groups(docs, shingle, max_bits), "simhash-groups")
    rank = F.struct(F.col("doc_id").isNull().alias("z"), F.col("doc_id").alias("d"), F.col("rk").alias("rk"))
    best = groups.groupBy("root").agg(F.min(rank).alias("best"), F.count("*").alias("n")).select(F.col("best.rk").alias("_k"))
    kept = packed_rows(docs).join(best.distinct().hint("shuffle_hash"), "_k")
    repeats = groups.groupBy("rk").agg(F.count("*").alias("n")).where("n > 1").limit(1).count()
    return (kept.dropDuplicates(["_k"]) if repeats else kept).select("_row.*")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = near_groups(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return groups.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


QUERIES = {"op8_simhash_grid": query}
ORACLE: dict[str, str] = {}
