"""Quality classifier: a factorisation machine over hashed words, structure
statistics and text metadata (its length).

    y = w0 + sum_i w_i x_i + 1/2 sum_f [ (sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2 ]

Pairwise interactions are scored in linear time by the sum-of-squares identity
above.  Words are hashed into ``WORD_BUCKETS`` features (value: square root of
the bucket's share of the text's words); ``STATS`` structure statistics follow.

Training uses a bounded sample of labelled rows: at most ``sample_rows`` of
them (default ``SAMPLE_ROWS``), those with the smallest hash of doc_id.  Their
sparse features (not their texts) reach the driver.  Scoring covers every
whole text in one pass without a shuffle.

Defined cases: a null text counts as empty and gets a score like any other;
rows with a null doc_id are scored, never held out and never trained on;
repeated rows are scored alike; null labels are left out; without labels of
both kinds the score is the smoothed share of label 1.  Only doc_id and text
of the documents are read, so other columns may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.textbytes import SPACE, fill_text, pieces, word_hashes, words_of

WORD_BUCKETS = 1 << 13
FACTORS = 8
#: Labelled rows used for training at most.
SAMPLE_ROWS = 6000
THRESHOLD = 0.3

STAT_NAMES = ("bias_free_length", "mean_word", "upper", "digit", "ascii_symbol", "high_byte", "space", "newline",
              "bang", "pipe", "sentence_end", "distinct_words", "top_word", "short_line", "repeated_line", "long_word",
              "symbol_word", "upper_word", "word_again", "empty")
N_STATS = len(STAT_NAMES)
N_FEATURES = WORD_BUCKETS + N_STATS


#: Byte classes: 0 other, 1 upper, 2 digit, 3 symbol, 4 high, 5 space, 6 newline, 7 bang, 8 pipe, 9 sentence end.
N_CLASSES = 10


def _byte_classes() -> np.ndarray:
    t = np.zeros(256, np.int8)
    t[65:91] = 1
    t[48:58] = 2
    t[list(b"#$%&*+/<=>@[]^_`{}~\\")] = 3
    t[128:] = 4
    t[[32, 10, ord("!"), ord("|")]] = [5, 6, 7, 8]
    t[list(b".?")] = 9
    return t


BYTE_CLASS = _byte_classes()
_LINE = np.zeros(256, bool)
_LINE[10] = True


def _share_repeated(row: np.ndarray, key: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per row: distinct keys, the largest key's count, and rows' key counts (all at least 0)."""
    distinct, top, total = np.zeros(n), np.zeros(n), np.bincount(row, minlength=n).astype(float)
    if len(row):
        order = np.lexsort((key, row))
        r, k = row[order], key[order]
        new = np.ones(len(r), bool)
        new[1:] = (r[1:] != r[:-1]) | (k[1:] != k[:-1])
        at = np.flatnonzero(new)
        size = np.diff(np.append(at, len(r)))
        distinct = np.bincount(r[at], minlength=n).astype(float)
        np.maximum.at(top, r[at], size)
    return distinct, top, total


def features(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sparse features (row, feature, value) of a piece of texts."""
    n = len(off) - 1
    size = np.diff(off).astype(float)
    some = np.maximum(size, 1)
    s, e, row = words_of(raw, off, SPACE)
    h = word_hashes(raw, s, e)
    words = np.bincount(row, minlength=n).astype(float)
    many = np.maximum(words, 1)
    kinds = BYTE_CLASS[raw]
    cls = np.stack([np.bincount(kinds[off[i]: off[i + 1]], minlength=N_CLASSES) for i in range(n)])[:, 1:]
    distinct, top, _ = _share_repeated(row, h, n)
    ls, le, lrow = words_of(raw, off, _LINE)
    lines = np.maximum(np.bincount(lrow, minlength=n), 1).astype(float)
    ldistinct, _, ltotal = _share_repeated(lrow, word_hashes(raw, ls, le), n)
    length = (e - s).astype(float)
    symbol = np.isin(kinds[e - 1], (3, 7, 8))
    shout = (kinds[s] == 1) & (kinds[np.minimum(s + 1, len(raw) - 1)] == 1) & (length > 1) if len(s) else symbol
    again = np.zeros(len(h), bool)
    again[1:] = (h[1:] == h[:-1]) & (row[1:] == row[:-1])
    per = lambda mask: np.bincount(row, weights=mask.astype(float), minlength=n) / many
    stats = np.stack([
        np.log1p(size) / 12, np.minimum(size / many / 12, 2), cls[:, 0] / some, cls[:, 1] / some, 4 * cls[:, 2] / some, cls[:, 3] / some,
        cls[:, 4] / some, 4 * cls[:, 5] / some, 4 * cls[:, 6] / some, 4 * cls[:, 7] / some, 4 * cls[:, 8] / some, distinct / many, top / many,
        np.bincount(lrow, weights=(le - ls < 30).astype(float), minlength=n) / lines, 1 - ldistinct / np.maximum(ltotal, 1) * (ltotal > 0) - (ltotal == 0),
        per(length > 20), per(symbol), per(shout), per(again), (words == 0).astype(float)], axis=1)
    code = row * WORD_BUCKETS + (h % np.uint64(WORD_BUCKETS)).astype(np.int64)
    uniq, count = np.unique(code, return_counts=True)
    wrow = uniq // WORD_BUCKETS
    value = np.sqrt(count / many[wrow])
    srow = np.repeat(np.arange(n), N_STATS)
    sfeat = np.tile(np.arange(WORD_BUCKETS, N_FEATURES), n)
    return (np.concatenate([wrow, srow]), np.concatenate([uniq % WORD_BUCKETS, sfeat]),
            np.concatenate([value, stats.ravel()]).astype(np.float32))


class FactorMachine:
    """Weights of a two-way factorisation machine; ``raw`` scores sparse rows."""

    def __init__(self, factors: int = FACTORS, seed: int = 5) -> None:
        rng = np.random.default_rng(seed)
        self.w0 = 0.0
        self.w = np.zeros(N_FEATURES, np.float32)
        self.v = rng.normal(0, 0.05, (N_FEATURES, factors)).astype(np.float32)

    def raw(self, row, feat, val, n: int) -> np.ndarray:
        """w0 + linear term + sum-of-squares identity, per row."""
        out = self.w0 + np.bincount(row, weights=self.w[feat] * val, minlength=n)
        for f in range(self.v.shape[1]):
            t = self.v[feat, f] * val
            out += 0.5 * (np.bincount(row, weights=t, minlength=n) ** 2 - np.bincount(row, weights=t * t, minlength=n))
        return out

    def score(self, row, feat, val, n: int) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.raw(row, feat, val, n), -30, 30)))

    def fit(self, rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, steps: int = 300, batch: int = 128,
            rate: float = 0.2, l2: float = 1e-4, seed: int = 7) -> "FactorMachine":
        """AdaGrad on the log loss, in whole passes of about ``steps`` steps in all; rows: (features, values) of each example."""
        rng = np.random.default_rng(seed)
        share = (y.sum() + 1) / (len(y) + 2) if len(y) else 0.5
        self.w0 = float(np.log(share / (1 - share)))
        if len(y) == 0 or y.min() == y.max():
            self.v[:] = 0
            return self
        gw, gv, g0 = np.full_like(self.w, 1e-2), np.full_like(self.v, 1e-2), 1e-2
        parts = max(1, len(y) // batch)
        for _ in range(-(-steps // parts)):
            for at in np.array_split(rng.permutation(len(y)), parts):
                feat = np.concatenate([rows[i][0] for i in at])
                val = np.concatenate([rows[i][1] for i in at])
                row = np.repeat(np.arange(len(at)), [len(rows[i][0]) for i in at])
                uniq, inv = np.unique(feat, return_inverse=True)
                err = (self.score(row, feat, val, len(at)) - y[at]) / len(at)
                e = err[row] * val
                dw = np.bincount(inv, weights=e, minlength=len(uniq)) + l2 * self.w[uniq]
                dv = np.empty((len(uniq), self.v.shape[1]))
                for f in range(self.v.shape[1]):
                    vf = self.v[feat, f]
                    total = np.bincount(row, weights=vf * val, minlength=len(at))
                    dv[:, f] = np.bincount(inv, weights=e * (total[row] - vf * val), minlength=len(uniq)) + l2 * self.v[uniq, f]
                g0 += err.sum() ** 2
                gw[uniq] += dw ** 2
                gv[uniq] += dv ** 2
                self.w0 -= rate * err.sum() / np.sqrt(g0)
                self.w[uniq] -= rate * dw / np.sqrt(gw[uniq])
                self.v[uniq] -= rate * dv / np.sqrt(gv[uniq])
        return self


def held_out(doc_id) -> F.Column:
    """True for the fifth of the ids that labels are never learnt from (null ids: false)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for i, j, raw, off in pieces(fill_text(b.column("text"))):
            row, feat, val = features(raw, off)
            order = np.argsort(row, kind="stable")
            cut = np.searchsorted(row[order], np.arange(j - i + 1))
            yield pa.record_batch([
                b.column("doc_id").slice(i, j - i), b.column("quality").slice(i, j - i),
                pa.ListArray.from_arrays(pa.array(cut, pa.int32()), pa.array(feat[order].astype(np.int32))),
                pa.ListArray.from_arrays(pa.array(cut, pa.int32()), pa.array(val[order], pa.float32()))],
                names=["doc_id", "quality", "feat", "val"])


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> FactorMachine:
    """Fit on at most ``sample_rows`` labelled documents outside the held-out fifth."""
    sample = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
              .where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & ~held_out(F.col("doc_id")))
              .groupBy("doc_id").agg(F.max("quality").alias("quality"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(sample), "doc_id").select("doc_id", "quality", "text")
    got = (texts.mapInArrow(_sparse, "doc_id long, quality int, feat array<int>, val array<float>")
           .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows).toArrow())
    y = np.array(got.column("quality").to_pylist(), float)
    feat, val = got.column("feat").combine_chunks(), got.column("val").combine_chunks()
    cut = feat.offsets.to_numpy() if len(y) else np.zeros(1, int)
    f, v = feat.values.to_numpy(), val.values.to_numpy()
    rows = [(f[cut[i]: cut[i + 1]], v[cut[i]: cut[i + 1]]) for i in range(len(y))]
    return FactorMachine().fit(rows, y)


def _scorer(model: FactorMachine, names: list[str], schema: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            scores = [np.zeros(0)]
            for i, j, raw, off in pieces(fill_text(b.column(names.index("text")))):
                scores.append(model.score(*features(raw, off), j - i))
            kept = [b.column(k) for k, c in enumerate(names) if c in schema]
            yield pa.record_batch([*kept, pa.array(np.concatenate(scores), pa.float64())], names=[*schema, "score"])
    return run


def score(docs: DataFrame, model: FactorMachine) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    src = docs.select("doc_id", "text")
    kind = dict(src.dtypes)["doc_id"]
    out = src.mapInArrow(_scorer(model, ["doc_id", "text"], ["doc_id"]), f"doc_id {kind}, score double")
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, model: FactorMachine) -> DataFrame:
    """The documents (all their columns) that the model doesn't reject."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ok = [np.zeros(0, bool)]
            for i, j, raw, off in pieces(fill_text(b.column(at))):
                ok.append(model.score(*features(raw, off), j - i) >= THRESHOLD)
            yield b.filter(pa.array(np.concatenate(ok)))
    at = docs.columns.index("text")
    return docs.mapInArrow(run, docs.schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return score(docs, train(docs, labels))


QUERIES = {"op1_quality_fm": query}
ORACLE: dict[str, str] = {}
