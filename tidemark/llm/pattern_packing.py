"""Best-fit packing by length patterns and non-negative least squares.

1. Tasks tokenise whole texts, append the end id and cut documents longer than
   ``capacity`` into pieces; the first piece takes the remainder.
2. Spark counts the pieces of each length: a histogram of at most ``capacity``
   numbers, the only thing the driver sees.
3. Patterns of one, two and three lengths that fill a sequence exactly are
   enumerated.  Non-negative least squares fits how often each repeats so that
   the histogram is met; the counts are rounded down and never use more pieces
   than exist.
4. What is left of the histogram is packed best-fit: the longest length first,
   then again and again the longest that still fits; each such pattern repeats
   while its lengths last.
5. Pieces of equal length are numbered (salted row numbers plus offsets, so a
   length that a third of all pieces share is spread over tasks).  Number and
   length give the sequence and the offset there by a lookup in the plan,
   whose size depends on ``capacity`` only.

Defined cases: null and empty texts are the end id alone; special-token strings
are ordinary text; rows that repeat are packed as separate pieces; an
empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import re
import sys
import types
import zlib
from array import array
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.staging import row_key, staged
from tidemark.llm.textbytes import fill_text, pieces

CAPACITY = 1024
END_ID = 2
#: Entries of each of the two generations of a worker's word cache: when the young one is full it
#: becomes the old one, and words met again come back from there.
CACHE_WORDS = 600_000
#: Bytes of whole texts whose words are looked up together.
PIECE_BYTES = 4_000_000
#: Pieces of one length that a task numbers, about; and parts at most.
ROWS_PER_SALT, MAX_SALTS = 2_000_000, 4096

PIECES = "doc_id long, rk long, piece int, start long, length long, ids_crc32 long"


def tokenizer_json(path: str | None = None) -> str:
    """The tokenizer file's text; the default is the public 50k byte-level BPE."""
    if path is None:
        import public_tokenizers
        path = public_tokenizers.path("byte_bpe_50k.json")
    with open(path, encoding="utf-8") as f:
        return f.read()


#: One token run of letters, with a blank before them or not, and one of ASCII signs after it or none.
_WORD = re.compile("([ ]?[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+)([!-/:-@\\[-`{-~]*)").fullmatch
#: Sign runs that a worker keeps.
TAILS = 10_000


def _bytes(*ranges: tuple[int, int]) -> np.ndarray:
    table = np.zeros(256, bool)
    for first, last in ranges:
        table[first: last + 1] = True
    return table


#: ASCII signs, digits and letters; these and the first bytes of characters from U+00C0 to U+07FF.
_VISIBLE, _STARTS = _bytes((0x21, 0x7E)), _bytes((0x21, 0x7E), (0xC3, 0xDF))


def cut_places(raw: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Where the texts raw[off[i]:off[i + 1]] can be cut because the tokenizer surely starts a new
    token: at each start, before a blank that a visible character follows (whatever precedes it), and
    around a line feed between visible ones."""
    after, second = np.append(raw[1:], np.uint8(0)), np.append(raw[2:], np.zeros(min(2, len(raw)), np.uint8))[: len(raw)]
    seen = _STARTS[after] | ((after == 0xC2) & (second >= 0xA1))
    starts = off[:-1][off[1:] > off[:-1]]
    seen[off[1:][off[1:] > off[:-1]] - 1] = False  # nothing follows a text's last byte
    behind = np.append(False, _VISIBLE[raw[:-1]]) if len(raw) else np.zeros(0, bool)
    behind[starts] = False
    cut = (raw == 0x20) & seen
    feeds = np.flatnonzero((raw == 0x0A) & seen & behind)
    cut[feeds] = True
    cut[feeds + 1] = True
    cut[starts] = True
    return np.flatnonzero(cut)


def byte_letters() -> dict[int, str]:
    """The letters that byte-level tokenizers write for bytes (as latin-1 characters):
    printable ones stand for themselves, the others are numbered from 256."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    return {b: chr(256 + n) for n, b in enumerate(b for b in range(256) if b not in set(plain))}


class WordCoder:
    """Token ids of whole texts, as little-endian uint32 bytes.

    A text is cut at places that the tokenizer never joins characters across, so the
    ids of the parts, joined, are the ids of the text.  Parts are looked up in a
    cache of bounded size.  A new part that is letters, with ASCII signs after them or not, is one
    run for the tokenizer's model, which merges it directly, and one run of signs;
    any other part goes through the tokenizer.
    """

    def __init__(self, json_text: str) -> None:
        home = sys.modules.setdefault("_tidemark_token_cache", types.ModuleType("_tidemark_token_cache"))
        key = zlib.crc32(json_text.encode())
        if getattr(home, "key", None) != key:
            from tokenizers import Tokenizer
            home.key, home.cache, home.old, home.tails = key, {}, {}, {}
            home.tokenizer = Tokenizer.from_str(json_text)
            home.tokenizer.encode_special_tokens = True
            home.tokenizer.no_padding()
            home.tokenizer.no_truncation()
        self.home, self.tokenizer, self.model, self.letters = home, home.tokenizer, home.tokenizer.model, byte_letters()
        self.blank = self.letters[ord(" ")]

    def _letters(self, run: str) -> bytes:
        if run.isascii():  # letters stand for themselves
            run = run.replace(" ", self.blank)
        else:
            run = run.encode().decode("latin-1").translate(self.letters)
        return array("I", [t.id for t in self.model.tokenize(run)]).tobytes()

    def _whole(self, part: str) -> bytes:
        return array("I", self.tokenizer.encode(part, add_special_tokens=False).ids).tobytes()

    def _signs(self, run: str) -> bytes:
        ids = self.home.tails.get(run)
        if ids is None:
            ids = self._whole(run)
            if len(self.home.tails) < TAILS:
                self.home.tails[run] = ids
        return ids

    def _ids(self, words: list[str]) -> list[bytes]:
        """The ids of different words; those that the young generation lacks come from the old one or are made."""
        home, get, old = self.home, self.home.cache.get, self.home.old.get
        found, fresh = list(map(get, words)), {}
        for i, w in enumerate(words):
            if found[i] is None:
                ids = old(w)
                if ids is None:
                    word = _WORD(w)
                    if word is None:
                        ids = self._whole(w)
                    else:
                        run, signs = word.groups()
                        ids = (get(run) or old(run) or self._letters(run)) + self._signs(signs) if signs else self._letters(run)
                found[i] = fresh[w] = ids
        home.cache.update(fresh)
        if len(home.cache) >= CACHE_WORDS:
            home.old, home.cache = home.cache, {}
        return found

    def piece_ids(self, raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts of a piece, where each text's ids start and the last ones end).

        Every different part is looked up once; the texts' ids are gathered from theirs."""
        at = cut_places(raw, off)
        parts = pa.LargeStringArray.from_buffers(len(at), pa.py_buffer(np.append(at, len(raw)).astype(np.int64)), pa.py_buffer(raw.tobytes()))
        code = parts.dictionary_encode()
        known = self._ids(code.dictionary.to_pylist())
        ids = np.frombuffer(b"".join(known), "<u4")
        size = np.fromiter(map(len, known), np.int64, len(known)) // 4
        first, part = np.cumsum(size) - size, code.indices.to_numpy()
        length = size[part]
        end = np.append(0, np.cumsum(length))
        flat = ids[np.repeat(first[part] - end[:-1], length) + np.arange(end[-1])]
        return flat, end[np.searchsorted(at, off)]

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, as little-endian uint32 bytes."""
        out = []
        for _, _, raw, off in pieces(pa.array(texts, pa.large_string()), PIECE_BYTES):
            flat, at = self.piece_ids(raw, off)
            out += [flat[a:b].tobytes() for a, b in zip(at[:-1], at[1:])]
        return out


def cut_pieces(n_ids: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of each piece of a document of ``n_ids`` ids."""
    first = n_ids % capacity or min(n_ids, capacity)
    starts = [0, *range(first, n_ids, capacity)]
    return [(s, min(first if s == 0 else capacity, n_ids - s)) for s in starts]


def _piece_batches(json_text: str, capacity: int, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = WordCoder(json_text)
        tail = np.array([end_id], "<u4").tobytes()
        for b in batches:
            doc_ids, keys = b.column("doc_id").to_pylist(), b.column("rk").to_pylist()
            for i, j, raw, off in pieces(fill_text(b.column("text")), PIECE_BYTES):
                flat, at = coder.piece_ids(raw, off)
                whole, rows = memoryview(flat).cast("B"), [[] for _ in range(6)]
                for doc_id, rk, first, last in zip(doc_ids[i:j], keys[i:j], at[:-1].tolist(), at[1:].tolist()):
                    for k, (start, length) in enumerate(cut_pieces(last - first + 1, capacity)):
                        a, z = first + start, first + start + length
                        crc = zlib.crc32(whole[4 * a: 4 * min(z, last)])
                        for column, v in zip(rows, (doc_id, rk, k, start, length, zlib.crc32(tail, crc) if z > last else crc)):
                            column.append(v)
                kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
                yield pa.record_batch([pa.array(c, t) for c, t in zip(rows, kinds)],
                                      names=["doc_id", "rk", "piece", "start", "length", "ids_crc32"])
    return run


def tokenised(docs: DataFrame, json_text: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """doc_id, rk, piece, start, length, ids_crc32 of every piece."""
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), row_key("doc_id", "text").alias("rk"), "text")
    return src.mapInArrow(_piece_batches(json_text, capacity, end_id), PIECES)


def patterns(capacity: int) -> np.ndarray:
    """Every multiset of one to three lengths that fills ``capacity`` exactly; zero-padded rows."""
    a = np.arange(1, capacity + 1)
    two = np.stack([a, capacity - a, 0 * a], axis=1)
    two = two[(two[:, 0] >= two[:, 1])]
    x, y = np.meshgrid(a, a, indexing="ij")
    x, y = x.ravel(), y.ravel()
    z = capacity - x - y
    fit = (x >= y) & (y >= z) & (z > 0)
    return np.concatenate([two, np.stack([x[fit], y[fit], z[fit]], axis=1)])


def fit_repeats(pats: np.ndarray, hist: np.ndarray, rounds: int = 250) -> np.ndarray:
    """Non-negative least squares: x >= 0 that minimises |A x - hist| where column p of A counts the lengths of pattern p.

    Accelerated projected gradient with a diagonal step (the inverse of the row and column sums)."""
    used = pats > 0
    hist = hist.astype(float)
    deg = np.bincount(pats[used], minlength=len(hist)).astype(float)
    step = 1 / np.maximum((deg[pats] * used).sum(axis=1), 1)
    x = y = np.zeros(len(pats))
    t = 1.0
    for _ in range(rounds):
        cover = np.bincount(pats.ravel(), weights=np.repeat(y, pats.shape[1]), minlength=len(hist))
        gap = cover - hist
        gap[0] = 0
        new = np.maximum(y - step * gap[pats].sum(axis=1), 0)
        t2 = (1 + np.sqrt(1 + 4 * t * t)) / 2
        y = new + (t - 1) / t2 * (new - x)
        y = np.maximum(y, 0)
        x, t = new, t2
    return x


def plan(hist: np.ndarray, capacity: int = CAPACITY) -> list[tuple[tuple[int, ...], int]]:
    """(lengths, repeats) of every sequence pattern; uses each piece of the histogram exactly once."""
    left = hist.astype(np.int64).copy()
    out: list[tuple[tuple[int, ...], int]] = []

    def take(lengths: tuple[int, ...], most: int | None = None) -> None:
        kinds, mult = np.unique(lengths, return_counts=True)
        times = int((left[kinds] // mult).min())
        times = times if most is None else min(times, most)
        if times > 0:
            left[kinds] -= times * mult
            out.append((lengths, times))

    take((capacity,))
    present = left > 0
    present[0] = True
    pats = patterns(capacity)
    pats = pats[present[pats].all(axis=1)]
    if len(pats):
        x = fit_repeats(pats, left)
        for p in np.argsort(-x, kind="stable"):
            if x[p] < 1:
                break
            take(tuple(int(v) for v in pats[p] if v), int(x[p]))
    while left.any():  # each turn uses up at least one length's pieces or leaves fewer than the pattern needs
        room, lengths = capacity, []
        rest = left.copy()
        while room > 0:
            fits = np.flatnonzero(rest[: room + 1])
            if len(fits) == 0:
                break
            lengths.append(int(fits[-1]))
            rest[fits[-1]] -= 1
            room -= int(fits[-1])
        take(tuple(lengths))
    return out


class Placer:
    """From (length, number among the pieces of that length) to (sequence, offset)."""

    def __init__(self, planned: list[tuple[tuple[int, ...], int]], capacity: int) -> None:
        used, rows, base = np.zeros(capacity + 1, np.int64), [], 0
        for lengths, times in planned:
            for length, offset in zip(lengths, accumulate(lengths, initial=0)):
                rows.append((length, used[length], base, offset))
                used[length] += times
            base += times
        self.sequences = base
        self.table = np.array(sorted(rows), np.int64).reshape(-1, 4)
        self.first = np.searchsorted(self.table[:, 0], np.arange(capacity + 2))
        #: One sorted key for lookups: length and first number.
        self.key = (self.table[:, 0].astype(object) * (1 << 52) + self.table[:, 1]).astype(np.int64) if len(rows) else np.zeros(0, np.int64)

    def place(self, length: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.searchsorted(self.key, length * (1 << 52) + number, side="right") - 1
        row = self.table[at]
        return row[:, 2] + number - row[:, 1], row[:, 3]


def _place_batches(placer: Placer):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            seq, offset = placer.place(b.column("length").to_numpy(), b.column("number").to_numpy())
            kept = [b.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
            yield pa.record_batch([*kept, pa.array(seq), pa.array(offset)],
                                  names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])
    return run


def pack(docs: DataFrame, capacity: int = CAPACITY, end_id: int = END_ID, tokenizer_path: str | None = None) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece."""
    spark = docs.sparkSession
    cut = staged(spark, tokenised(docs, tokenizer_json(tokenizer_path), capacity, end_id), "pieces")
    total = cut.count()
    salts = min(MAX_SALTS, total // ROWS_PER_SALT + 1) * 4
    salted = cut.withColumn("salt", F.pmod(F.xxhash64("rk", "piece"), F.lit(salts)).cast("int"))
    counts = staged(spark, salted.groupBy("length", "salt").agg(F.count("*").alias("n")), "piece-counts")
    hist = np.zeros(capacity + 1, np.int64)
    for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect():  # at most `capacity` rows
        hist[r["length"]] = r["n"]
    placer = Placer(plan(hist, capacity), capacity)
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("length", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    numbered = salted.withColumn("nth", F.row_number().over(Window.partitionBy("length", "salt").orderBy("rk", "piece")))
    numbered = numbered.join(F.broadcast(offsets), ["length", "salt"])  # at most capacity * 4 * MAX_SALTS rows
    numbered = numbered.select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("before") + F.col("nth") - 1).alias("number"))
    return numbered.mapInArrow(_place_batches(placer), "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet"))


QUERIES = {"op10_pattern_packing": query}
ORACLE: dict[str, str] = {}
