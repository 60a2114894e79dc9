"""Counting of 64-bit window hashes across the corpus.

Each key (a document) learns which of its window hashes also occur anywhere
else.  Hashes travel in packed rows, 8 bytes each, dealt to buckets by value:

* A task first counts within about ``MACRO`` windows.  A hash found once there
  is sent on with its key.  One found more often is known to be repeated: it
  is sent on once, and its keys are told directly.  So a window that a third of
  all documents share reaches its bucket once per ``MACRO`` windows read.
* A bucket sorts what it got; a value that came twice is repeated, and the keys
  of its single finds are told.
* What keys are told travels packed too, dealt by key; ``answer`` brings it
  together with the documents' own rows.

The number of buckets follows the number of windows, about
``WINDOWS_PER_BUCKET`` each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MACRO = 1_500_000
WINDOWS_PER_BUCKET = 3_000_000

PACKED = "bucket int, kind int, keys binary, sizes binary, hashes binary"
#: Kinds of packed rows: found once with its key, found repeatedly (no key), told to its key;
#: the last two kinds are the users'.
ONCE, KNOWN, TOLD, SEGMENTS, MARKS = range(5)


def bucket_count(df: DataFrame, windows: int) -> int:
    """Buckets for about so many windows; at least the session's shuffle partitions."""
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), windows // WINDOWS_PER_BUCKET + 1)


def _binary(cells: list[np.ndarray]) -> pa.Array:
    return pa.array([c.tobytes() for c in cells], pa.binary())


def _keyed_rows(kind: int, buckets: int, bucket: np.ndarray, keys: np.ndarray, owner: np.ndarray, h: np.ndarray, out: list) -> None:
    """Rows of one kind, one per bucket; owner (ascending) names each hash's key."""
    order = np.argsort(bucket, kind="stable")
    owner, h = owner[order], h[order]
    cut = np.searchsorted(bucket[order], np.arange(buckets + 1))
    for b in np.flatnonzero(np.diff(cut)):
        o = owner[cut[b]: cut[b + 1]]
        at = np.flatnonzero(np.append(True, o[1:] != o[:-1]))
        out.append((b, kind, keys[o[at]], np.diff(np.append(at, len(o))).astype(np.uint32), h[cut[b]: cut[b + 1]]))


def _macro_rows(keys: np.ndarray, sizes: np.ndarray, h: np.ndarray, buckets: int) -> list:
    owner = np.repeat(np.arange(len(keys)), sizes)
    order = np.argsort(h, kind="stable")
    sorted_h = h[order]
    new = np.append(True, sorted_h[1:] != sorted_h[:-1])
    at = np.flatnonzero(new)
    run = np.diff(np.append(at, len(h)))
    many = np.zeros(len(h), bool)
    many[order] = np.repeat(run > 1, run)
    out: list = []
    once = ~many
    _keyed_rows(ONCE, buckets, (h[once] % np.uint64(buckets)).astype(np.int64), keys, owner[once], h[once], out)
    if many.any():
        known = sorted_h[at[run > 1]]
        bucket = (known % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        cut = np.searchsorted(bucket[order], np.arange(buckets + 1))
        none = np.zeros(0, np.int64)
        out += [(b, KNOWN, none, none, known[order][cut[b]: cut[b + 1]]) for b in np.flatnonzero(np.diff(cut))]
        _keyed_rows(TOLD, buckets, keys[owner[many]] % buckets, keys, owner[many], h[many], out)
    return out


def packed_batches(rows: list) -> Iterator[pa.RecordBatch]:
    for i in range(0, len(rows), 64):
        b, kind, keys, sizes, h = zip(*rows[i: i + 64])
        yield pa.record_batch([pa.array(b, pa.int32()), pa.array(kind, pa.int32()), _binary(keys), _binary(sizes), _binary(h)],
                              names=["bucket", "kind", "keys", "sizes", "hashes"])


def packed_table(rows: list) -> pa.Table:
    schema = pa.schema([("bucket", pa.int32()), ("kind", pa.int32()), ("keys", pa.binary()), ("sizes", pa.binary()), ("hashes", pa.binary())])
    return pa.Table.from_batches(list(packed_batches(rows)), schema)


def pack(stream: Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]], buckets: int) -> Iterator[pa.RecordBatch]:
    """Packed rows of a stream of (keys, number of hashes of each, hashes)."""
    held: list = []
    total = 0

    def flush():
        yield from packed_batches(_macro_rows(*(np.concatenate(c) for c in zip(*held)), buckets))

    for keys, sizes, h in stream:
        if len(h):
            held.append((keys, sizes, h))
            total += len(h)
        if total >= MACRO:
            yield from flush()
            held, total = [], 0
    if held:
        yield from flush()


def _join(cells: list[bytes], dtype) -> np.ndarray:
    return np.frombuffer(b"".join(cells), dtype)


def rows_by_key(kind: int, buckets: int, keys: np.ndarray, sizes: np.ndarray, values: np.ndarray) -> list:
    """Packed rows that bring each key its values, dealt by key."""
    out: list = []
    owner = np.repeat(np.arange(len(keys)), sizes)
    _keyed_rows(kind, buckets, keys[owner] % buckets, keys, owner, values, out)
    return out


def flat(table: pa.Table, kind: int, sizes=np.uint32, values=np.uint64) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(keys, sizes, values) of all packed rows of one kind."""
    t = table.filter(pa.array(table.column("kind").to_numpy() == kind))
    return tuple(_join(t.column(c).to_pylist(), d) for c, d in (("keys", np.int64), ("sizes", sizes), ("hashes", values)))


def count_rows(table: pa.Table, buckets: int) -> list:
    """Packed rows for the keys of a bucket's repeated hashes."""
    keys, sizes, h = flat(table, ONCE)
    known = flat(table, KNOWN)[2]
    values = np.sort(np.concatenate([h, known]))
    twice = np.unique(values[1:][values[1:] == values[:-1]])
    at = np.minimum(np.searchsorted(twice, h), max(len(twice) - 1, 0))
    mask = twice[at] == h if len(twice) else np.zeros(len(h), bool)
    count = np.bincount(np.repeat(np.arange(len(keys)), sizes)[mask], minlength=len(keys))
    return rows_by_key(TOLD, buckets, keys[count > 0], count[count > 0], h[mask]) + rows_by_key(TOLD, buckets, *flat(table, TOLD))


def repeated(packed: DataFrame, buckets: int) -> DataFrame:
    """What keys are told, packed and dealt by key into ``buckets``."""
    def count(table: pa.Table) -> pa.Table:
        return packed_table(count_rows(table, buckets))
    return packed.groupBy("bucket").applyInArrow(count, PACKED)


class Told:
    """The values of one kind that each key was told."""

    def __init__(self, table: pa.Table, kind: int) -> None:
        keys, sizes, values = flat(table, kind)
        owner = np.repeat(keys, sizes)
        order = np.argsort(owner, kind="stable")
        self.owner, self.values = owner[order], values[order]

    def of(self, key: int) -> np.ndarray:
        return self.values[np.searchsorted(self.owner, key): np.searchsorted(self.owner, key, side="right")]


def answer(rows: DataFrame, told: DataFrame, buckets: int, function, schema: str) -> DataFrame:
    """``function(rows, told)`` -> table, for each part of ``rows`` (which have rk, the key)
    with what its keys were told."""
    left = rows.withColumn("bucket", F.pmod(F.col("rk"), F.lit(buckets)).cast("int"))
    return left.groupBy("bucket").cogroup(told.groupBy("bucket")).applyInArrow(function, schema)


def listed(hashes: np.ndarray, told: np.ndarray) -> np.ndarray:
    """Mask of the hashes that are among those told."""
    return np.isin(hashes, told) if len(told) and len(hashes) else np.zeros(len(hashes), bool)
