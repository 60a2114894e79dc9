"""Suffix-array dedup of long byte strings with a run-length index.

A byte goes if it lies in a ``LENGTH``-byte string that also starts anywhere else.

1. Partition.  Of each LENGTH-byte window the smallest hash of its ``GRAM``-byte
   grams (the rightmost of equal ones) is the window's anchor; equal windows have
   equal anchors at equal places.  Consecutive windows of one anchor form a segment,
   so each window belongs to exactly one.  Anchors that occur once are dropped:
   their windows cannot repeat.
2. Index.  Segments meet by anchor.  Equal segments collapse to one with its
   places.  The distinct ones are joined by a byte that UTF-8 never holds; their
   suffix array gives the Burrows-Wheeler transform, which is run-compressed;
   the longest-common-prefix is sampled at run starts and run ends only.
3. Matching statistics stream over the text from these samples: between samples the
   match with the neighbour in suffix order shrinks by one a byte, so a running
   maximum gives, for every place, its longest match elsewhere.
4. Windows whose match reaches LENGTH are marked; marked windows merge into spans.

An anchor with more than ``cap`` places (a passage that very many documents
share) is not indexed: its windows are hashed and counted in packed buckets
(``window_counts``), exactly and without gathering them.  cap is HOT_PLACES or a
HOT_LIST-th of all anchors, so at most HOT_LIST anchors are hot; that list
(8 bytes each) goes to the tasks.

Windows are judged on the input.  Defined cases: null and empty texts have no
bytes; texts shorter than LENGTH keep all; rows that repeat are documents of
their own; cuts may fall inside a character (the digest is over bytes).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.staging import row_key, staged
from tidemark.llm.substring_dedup import covered
from tidemark.llm.textbytes import SpanHash, fill_text, mix64, pieces
from tidemark.llm.window_counts import MARKS, PACKED, SEGMENTS, TOLD, Told, answer, bucket_count, count_rows, listed, pack, packed_table, repeated, rows_by_key

LENGTH = 400
GRAM = 64
#: Places of an anchor from which on its windows are counted instead of indexed, and hot anchors at most.
HOT_PLACES, HOT_LIST = 1000, 2_000_000
#: Window starts handled at a time; bytes indexed at a time (a group is never cut).
BLOCK, INDEX_BYTES = 2_000_000, 500_000
SEPARATOR = 0xFF

_GRAMS = SpanHash(41)
_WINDOWS = SpanHash(43)
_PLACE_BITS = 28


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """min(x[j: j + width]) for every j with a whole window."""
    n = len(x)
    rows = -(-n // width)
    padded = np.full(rows * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = x
    grid = padded.reshape(rows, width)
    head = np.minimum.accumulate(grid, axis=1).ravel()
    tail = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(tail[: n - width + 1], head[width - 1: n])


def segments(raw: np.ndarray, off: np.ndarray, length: int = LENGTH, gram: int = GRAM):
    """(text, anchor hash, first window start, number of windows) of every segment of a piece; starts count in the piece."""
    found = []
    mask = np.uint64((1 << _PLACE_BITS) - 1)
    for lo in range(0, len(raw) - length + 1, BLOCK):
        part = raw[lo: min(lo + BLOCK + length - 1, len(raw))]
        starts = np.arange(len(part) - gram + 1)
        h = mix64(_GRAMS.spans(_GRAMS.table[part], starts, starts + gram))
        key = (h & ~mask) | (mask - starts.astype(np.uint64))
        place = (mask - (_sliding_min(key, length - gram + 1) & mask)).astype(np.int64)
        window = np.arange(len(place)) + lo
        text = np.searchsorted(off, window, side="right") - 1
        good = window + length <= off[text + 1]
        window, text, place = window[good], text[good], place[good]
        new = np.ones(len(window), bool)
        new[1:] = (place[1:] != place[:-1]) | (text[1:] != text[:-1])
        at = np.flatnonzero(new)
        found.append((text[at], h[place[at]], window[at], np.diff(np.append(at, len(window)))))
    if not found:
        z = np.zeros(0, np.int64)
        return z, np.zeros(0, np.uint64), z, z
    return tuple(np.concatenate(c) for c in zip(*found))


class RunLengthIndex:
    """Run-compressed Burrows-Wheeler transform of a byte string, with the
    longest common prefixes sampled at the ends of runs."""

    def __init__(self, text: np.ndarray) -> None:
        n = len(text)
        padded = np.concatenate([text, np.zeros(8, np.uint8)]).astype(np.uint64)
        self.word = np.zeros(n, np.uint64)
        for k in range(8):
            self.word |= padded[k: n + k] << np.uint64(56 - 8 * k)
        self.levels: list[tuple[int, np.ndarray]] = []
        key, step = self.word, 4
        while True:
            order = np.argsort(key)
            sorted_key = key[order]
            rank_sorted = np.concatenate([[0], np.cumsum(sorted_key[1:] != sorted_key[:-1])])
            rank = np.empty(n, np.int64)
            rank[order] = rank_sorted
            step *= 2
            if rank_sorted[-1] == n - 1:
                break
            self.levels.append((step, rank.astype(np.int32)))
            second = np.zeros(n, np.int64)
            second[: max(n - step, 0)] = rank[step:] + 1
            key = rank * (n + 1) + second
        bwt = text[order - 1].astype(np.int16)
        bwt[order == 0] = 256  # nothing precedes the first place
        edge = np.flatnonzero(bwt[1:] != bwt[:-1])
        #: The transform as runs: symbol and first row of each.
        self.run_first = np.concatenate([[0], edge + 1])
        self.run_symbol = bwt[self.run_first]
        #: Samples: text place of each run's first and last row and its match with the row before or after.
        self.first_place, self.last_place = order[edge + 1], order[edge]
        self.first_match = self.last_match = self._common(self.last_place, self.first_place)
        self.n, self.low_place, self.high_place = n, int(order[0]), int(order[-1])

    def _common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the common prefix of the suffixes at a and b."""
        a, b = a.copy(), b.copy()
        total = np.zeros(len(a), np.int64)
        n = len(self.word)
        for step, rank in reversed(self.levels):
            inside = (a < n) & (b < n)
            same = np.zeros(len(a), bool)
            same[inside] = rank[a[inside]] == rank[b[inside]]
            total[same] += step
            a[same] += step
            b[same] += step
        inside = (a < n) & (b < n)
        diff = self.word[a[inside]] ^ self.word[b[inside]]
        lead = np.zeros(len(diff), np.int64)
        open_ = np.ones(len(diff), bool)
        for k in range(8):
            open_ &= (diff >> np.uint64(56 - 8 * k)) & np.uint64(255) == 0
            lead += open_
        total[inside] += np.minimum(lead, n - np.maximum(a[inside], b[inside]))
        return total

    def matching_statistics(self) -> np.ndarray:
        """Longest match elsewhere of every place, streamed over the text from the samples."""
        index = np.arange(self.n)
        best = np.zeros(self.n, np.int64)
        for place, match, edge in ((self.first_place, self.first_match, self.low_place), (self.last_place, self.last_match, self.high_place)):
            reach = np.zeros(self.n, np.int64)
            reach[place] = match + place
            reach[edge] = max(reach[edge], edge)
            best = np.maximum(best, np.maximum.accumulate(reach) - index)
        return best


def _mark_groups(group: np.ndarray, texts: list[bytes], windows: np.ndarray, length: int) -> list[np.ndarray]:
    """Mask of the window starts of each distinct segment that occur in another one; group: ascending."""
    out: list[np.ndarray] = [np.zeros(int(w), bool) for w in windows]
    edge = np.flatnonzero(np.append(True, group[1:] != group[:-1])) if len(group) else np.zeros(0, int)
    size = np.diff(np.append(edge, len(group)))
    some: list[int] = []
    held = 0

    def index() -> None:
        if not some:
            return
        at = np.cumsum([0] + [len(texts[s]) + 1 for s in some])
        blob = np.frombuffer(b"".join(texts[s] + bytes([SEPARATOR]) for s in some), np.uint8)
        match = RunLengthIndex(blob).matching_statistics() >= length
        for s, a in zip(some, at):
            out[s] = match[a: a + int(windows[s])]

    for e, n in zip(edge, size):
        if n > 1:
            some.extend(range(e, e + n))
            held += sum(len(texts[s]) + 1 for s in range(e, e + n))
            if held >= INDEX_BYTES:
                index()
                some, held = [], 0
    index()
    return out


def _ranges(mask: np.ndarray, shift: int) -> np.ndarray:
    """(first, end) pairs of the marked runs."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], mask.astype(np.int8), [0]])))
    return (edge + shift).astype(np.int64)


def _index_bucket(length: int, buckets: int):
    def run(table: pa.Table) -> pa.Table:
        is_segment = table.column("kind").to_numpy() == SEGMENTS
        told = count_rows(table.filter(pa.array(~is_segment)), buckets)
        part = table.filter(pa.array(is_segment))
        seen: dict[tuple[int, bytes], int] = {}
        places: list[tuple[int, int, int]] = []
        for keys, sizes, blob in zip(*(part.column(c).to_pylist() for c in ("keys", "sizes", "hashes"))):
            keys = np.frombuffer(keys, np.int64).reshape(-1, 2)
            sizes = np.frombuffer(sizes, np.int64).reshape(-1, 3)
            data = zstandard.ZstdDecompressor().decompress(blob)
            cut = np.concatenate([[0], np.cumsum(np.where(sizes[:, 2] < 0, sizes[:, 1] + length - 1, 0))])
            local: list[int] = []
            for k, ((rk, anchor), (start, _, ref)) in enumerate(zip(keys.tolist(), sizes.tolist())):
                which = local[ref] if ref >= 0 else seen.setdefault((anchor, data[cut[k]: cut[k + 1]]), len(seen))
                local.append(which)
                places.append((which, rk, start))
        if places:
            items = list(seen)
            copies = np.bincount([p[0] for p in places], minlength=len(items))
            anchors = np.array([a for a, _ in items], np.int64)
            order = np.argsort(anchors, kind="stable")
            texts = [items[i][1] for i in order]
            masks = _mark_groups(anchors[order], texts, np.array([len(t) - length + 1 for t in texts]), length)
            by = dict(zip(order.tolist(), range(len(order))))
            keys, data = [], []
            for which, rk, start in places:
                mask = masks[by[which]]
                pairs = _ranges(np.ones(len(mask), bool) if copies[which] > 1 else mask, start)
                if len(pairs):
                    keys.append(rk)
                    data.append(pairs)
            if keys:
                told += rows_by_key(MARKS, buckets, np.array(keys, np.int64), np.array([len(d) for d in data]), np.concatenate(data).view(np.uint64))
        return packed_table(told)
    return run


def _anchor_rows(length: int, gram: int):
    """One row per segment: its anchor."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for _, _, raw, off in pieces(fill_text(b.column("text"))):
                yield pa.record_batch([pa.array(segments(raw, off, length, gram)[1].view(np.int64))], names=["anchor"])
    return run


def _anchor_windows(length: int, gram: int, buckets: int):
    """Packed anchors of each document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def stream():
            for b in batches:
                keys = b.column("rk").to_numpy()
                for i, j, raw, off in pieces(fill_text(b.column("text"))):
                    text, anchor, _, _ = segments(raw, off, length, gram)
                    yield keys[i:j], np.bincount(text, minlength=j - i), anchor
        yield from pack(stream(), buckets)
    return run


def _segment_rows(bucket: np.ndarray, key: np.ndarray, anchor: np.ndarray, start: np.ndarray, windows: np.ndarray,
                  texts: list[bytes]) -> pa.RecordBatch:
    """Packed segments, one row per bucket; a segment that the row already holds is a reference."""
    order = np.argsort(bucket, kind="stable")
    rows: list[list] = [[], [], [], []]
    cut = np.flatnonzero(np.append(True, np.diff(bucket[order]) != 0)) if len(order) else []
    for part in np.split(order, cut[1:]) if len(order) else []:
        seen: dict[tuple[int, bytes], int] = {}
        ref, blob = [], []
        for n, k in enumerate(part.tolist()):
            first = seen.setdefault((int(anchor[k]), texts[k]), n)
            ref.append(first if first < n else -1)
            if first == n:
                blob.append(texts[k])
        rows[0].append(int(bucket[part[0]]))
        rows[1].append(np.stack([key[part], anchor[part].view(np.int64)], axis=1).astype(np.int64).tobytes())
        rows[2].append(np.stack([start[part], windows[part], np.array(ref)], axis=1).astype(np.int64).tobytes())
        rows[3].append(zstandard.ZstdCompressor(level=3).compress(b"".join(blob)))
    return pa.record_batch([pa.array(rows[0], pa.int32()), pa.array([SEGMENTS] * len(rows[0]), pa.int32()),
                            *(pa.array(c, pa.binary()) for c in rows[1:])], names=["bucket", "kind", "keys", "sizes", "hashes"])


def _candidates(length: int, gram: int, buckets: int, hot: np.ndarray):
    """Segments of repeated anchors, and packed window hashes of the hot ones."""
    def run(docs: pa.Table, told: pa.Table) -> pa.Table:
        known, keys = Told(told, TOLD), docs.column("rk").to_numpy()
        hashed: list = []
        held: list = []
        for i, j, raw, off in pieces(fill_text(docs.column("text"))):
            mine = [known.of(k) for k in keys[i:j]]
            if not any(map(len, mine)):
                continue
            text, anchor, start, windows = segments(raw, off, length, gram)
            first = np.searchsorted(text, np.arange(j - i + 1))
            again = np.concatenate([listed(anchor[first[k]: first[k + 1]], mine[k]) for k in range(j - i)])
            is_hot = again & np.isin(anchor, hot)
            if is_hot.any():
                at = np.repeat(start[is_hot] - np.cumsum(windows[is_hot]) + windows[is_hot], windows[is_hot]) + np.arange(windows[is_hot].sum())
                h = mix64(_WINDOWS.spans(_WINDOWS.table[raw], at, at + length))
                hashed.append((keys[i:j], np.bincount(np.repeat(text[is_hot], windows[is_hot]), minlength=j - i), h))
            pick = np.flatnonzero(again & ~is_hot)
            whole = raw.tobytes()
            held.append((keys[i:j][text[pick]], anchor[pick], start[pick] - off[text[pick]], windows[pick],
                         [whole[s: s + w + length - 1] for s, w in zip(start[pick].tolist(), windows[pick].tolist())]))
        out = list(pack(iter(hashed), buckets))
        if held:
            key, anchor, start, windows = (np.concatenate(c) for c in list(zip(*held))[:4])
            out.append(_segment_rows((anchor % np.uint64(buckets)).astype(np.int64), key, anchor, start, windows, [t for h in held for t in h[4]]))
        return pa.Table.from_batches(out) if out else packed_table([])
    return run


def _cut(length: int, with_kept: bool):
    def run(docs: pa.Table, told: pa.Table) -> pa.Table:
        marks, hashes, keys = Told(told, MARKS), Told(told, TOLD), docs.column("rk").to_numpy()
        rows: list[list] = [[], [], [], [], []]
        for i, j, raw, off in pieces(fill_text(docs.column("text"))):
            for k in range(j - i):
                part = raw[off[k]: off[k + 1]]
                mask = np.zeros(max(len(part) - length + 1, 0), np.int64)
                if len(pairs := marks.of(keys[i + k]).view(np.int64).reshape(-1, 2)):
                    edge = np.zeros(len(mask) + 1, np.int64)
                    np.add.at(edge, pairs[:, 0], 1)
                    np.add.at(edge, pairs[:, 1], -1)
                    mask = np.cumsum(edge[:-1])
                if len(known := hashes.of(keys[i + k])):
                    at = np.arange(len(mask))
                    mask = mask + listed(mix64(_WINDOWS.spans(_WINDOWS.table[part], at, at + length)), known)
                gone = covered(mask > 0, len(part), length) if mask.any() else np.zeros(len(part), bool)
                spans = int(np.count_nonzero(gone[1:] & ~gone[:-1]) + (len(gone) > 0 and gone[0]))
                kept = part[~gone].tobytes()
                for column, v in zip(rows, (len(part), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest(), kept if with_kept else None)):
                    column.append(v)
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
        return pa.table([docs.column("doc_id"), *(pa.array(c, t) for c, t in zip(rows, kinds))],
                        names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])
    return run


def remove_long_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, hot_places: int = HOT_PLACES, with_kept: bool = True) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept (bytes; null unless ``with_kept``) of every document."""
    spark = docs.sparkSession
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), row_key("doc_id", "text").alias("rk"), "text")
    texts = src.select("rk", "text")
    places = staged(spark, texts.mapInArrow(_anchor_rows(length, gram), "anchor long").groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1"), "anchors")
    total = places.agg(F.sum("n")).first()[0] or 0
    cap = max(hot_places, total // HOT_LIST)
    hot = np.array([r["anchor"] for r in places.where(F.col("n") > cap).select("anchor").collect()], np.int64).view(np.uint64)  # at most HOT_LIST
    text_bytes = src.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = bucket_count(src, text_bytes // 6)
    told = repeated(texts.mapInArrow(_anchor_windows(length, gram, buckets), PACKED), buckets)
    packed = answer(texts, told, buckets, _candidates(length, gram, buckets, hot), PACKED)
    found = packed.groupBy("bucket").applyInArrow(_index_bucket(length, buckets), PACKED)
    return answer(src, staged(spark, found, "long-matches"), buckets, _cut(length, with_kept),
                  "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_long_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"), with_kept=False).drop("kept")


QUERIES = {"op9_runlength_index": query}
ORACLE: dict[str, str] = {}
