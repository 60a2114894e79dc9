"""Collocations, whitening and source mixing against brute force, and on awkward rows."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import BASE
from tidemark.llm import collocations, ranges, source_mixing, whitening

SMALL = "/root/testdata/sf0.001"


# ---------------------------------------------------------------- 11 collocations

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def phrases_by_hand(docs, least):
    """{lang: (n, {phrase: (a, l, r, score)})} of what candidates() returns."""
    count = {}
    for text, lang in docs:
        f = count.setdefault(lang if lang is not None else "und", Counter())
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", (text or "").translate(LOWER)):
            words = re.findall("[^ \t]+", piece)
            for k in (1, 2, 3):
                f.update(tuple(words[i: i + k]) for i in range(len(words) - k + 1))
    out = {}
    for lang, f in count.items():
        n = sum(v for p, v in f.items() if len(p) == 1)
        cands, rows = {p for p, v in f.items() if len(p) > 1 and v >= least}, {}
        for p in cands:
            longer = [q for q in cands if len(q) > len(p) and any(q[i: i + len(p)] == p for i in range(len(q) - len(p) + 1))]
            if any(100 * f[q] >= 50 * f[p] for q in longer):
                continue
            a = f[p]
            rows[" ".join(p)] = min(((1_000_000 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p))))
            score, k = rows[" ".join(p)]
            rows[" ".join(p)] = (a, f[p[:k]], f[p[k:]], score)
        out[lang] = n, rows
    return out


def frame(spark, docs):
    return spark.createDataFrame(docs, "text string, lang string")


def check_phrases(spark, docs, least):
    got = {}
    for r in collocations.candidates(frame(spark, docs), least).collect():
        got.setdefault(r.lang, (r.n, {}))[1][r.phrase] = (r.a, r.l, r.r, r.score)
        assert r.n == got[r.lang][0]
    want = {lang: v for lang, v in phrases_by_hand(docs, least).items() if v[1]}
    assert got == want


def random_docs(seed, n=80, vocabulary=9):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(vocabulary)] + ["Über", "日本", "A", "a"]
    weights = [20 / (i + 1) for i in range(len(words))]
    make = lambda: rng.choice([" ", " ", "\t ", ", ", ". ", "\n"]).join(rng.choices(words, weights, k=rng.randrange(1, 12)))
    return [(" ".join(make() for _ in range(rng.randrange(1, 5))), rng.choice(["en", "en", "en", "fr", None])) for _ in range(n)]


def test_phrases_equal_brute_force(spark):
    docs = random_docs(1) + [(None, "en"), ("", None), ("  \t ., !", "en"), ("alone", "de"), ("x " * 3000, "en"), ("A a.A a;a A" * 40, "es")]
    check_phrases(spark, docs + docs[:5], 3)


def test_groups_over_many_ranges_get_their_open_counts(spark):
    """More ranges than rows of a group: words, pairs and extensions come from earlier and later ranges."""
    saved = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        check_phrases(spark, random_docs(2, vocabulary=5), 2)
    finally:
        for k, v in saved.items():
            spark.conf.set(k, v)


def test_long_texts_are_counted_in_slices(spark, monkeypatch):
    monkeypatch.setattr(collocations, "CHUNK", 7)
    check_phrases(spark, random_docs(3, n=25), 2)


def test_scores_are_exact_past_64_bits(spark):
    big = 10 ** 12 + 7
    row = spark.createDataFrame([(big, big + 1, big + 9)], "f long, l long, r long")
    got = row.select(collocations._score("l", "r").alias("s")).first()["s"]
    assert got == 1_000_000 * big * big // ((big + 1) * (big + 9))


def test_ranks_break_ties_by_count_and_bytes(spark):
    rows = [("en", p, a, 1, 1, 9, s) for p, a, s in [("b x", 5, 7), ("a x", 5, 7), ("é x", 5, 7), ("Z x", 9, 7), ("c x", 1, 8)]] + [("fr", "q q", 1, 1, 1, 3, 1)]
    df = spark.createDataFrame(rows, "lang string, phrase string, a long, l long, r long, n long, score long")
    got = [(r.lang, r["rank"], r.phrase) for r in collocations.best(df, 4).orderBy("lang", "rank").collect()]
    assert got == [("en", 1, "c x"), ("en", 2, "Z x"), ("en", 3, "a x"), ("en", 4, "b x"), ("fr", 1, "q q")]


def test_phrases_awkward(spark, awkward, nothing):
    docs = [(t, lang) for _, t, lang, *_ in BASE]
    got = {(r.lang, r.phrase): (r.a, r.l, r.r, r.score) for r in collocations.candidates(awkward, 2).collect()}
    assert got == {(lang, p): v for lang, (_, rows) in phrases_by_hand(docs, 2).items() for p, v in rows.items()}
    assert collocations.best(collocations.candidates(nothing)).count() == 0
    assert collocations.candidates(frame(spark, [(None, None), ("", "en")])).count() == 0


# ---------------------------------------------------------------- 12 whitening

def exact(vectors):
    """(n, sums, scatter) of whole vectors, by hand."""
    n, d = len(vectors), len(vectors[0])
    s = [sum(v[i] for v in vectors) for i in range(d)]
    return n, s, [[n * sum(v[i] * v[j] for v in vectors) - s[i] * s[j] for j in range(d)] for i in range(d)]


def determinant(m):
    """Exact, by fractions."""
    m, out = [[Fraction(v) for v in r] for r in m], Fraction(1)
    for k in range(len(m)):
        p = next((i for i in range(k, len(m)) if m[i][k]), None)
        if p is None:
            return Fraction(0)
        if p != k:
            m[k], m[p], out = m[p], m[k], -out
        out *= m[k][k]
        for i in range(k + 1, len(m)):
            t = m[i][k] / m[k][k]
            m[i] = [a - t * b for a, b in zip(m[i], m[k])]
    return out


@pytest.mark.parametrize("seed", range(3))
def test_characteristic_polynomial_is_exact(spark, seed):
    rng = np.random.default_rng(seed)
    vectors = rng.integers(-300, 300, (9, 6)).tolist()
    if seed == 1:
        vectors = [[v[0], 0, v[0], 7, v[1], -v[1]] for v in vectors]       # rank two, empty columns
    _, _, m = exact(vectors)
    poly = whitening.characteristic(spark, m)
    assert len(poly) == 7 and poly[-1] == 1
    for x in (0, 1, -5, 10 ** 6):
        assert sum(c * x ** i for i, c in enumerate(poly)) == determinant([[(x if i == j else 0) - v for j, v in enumerate(r)] for i, r in enumerate(m)])
    roots = whitening.top_roots(poly, 6)
    near = [r for r in sorted(np.linalg.eigvalsh(np.array(m, float)))[::-1] if r > 1e-3]
    assert sum(k for *_, k in roots) == len(near)
    assert np.allclose([v / (1 << s) for v, s, k in roots for _ in range(k)], near, rtol=1e-9)


def product(*roots):
    """Coefficients of the polynomial with these roots, the constant first."""
    poly = [1]
    for r in roots:
        poly = [a - r * b for a, b in zip([0, *poly], [*poly, 0])]
    return poly


def test_roots_are_counted_with_multiplicity_and_isolated():
    poly = product(0, 0, 3, 3, 10 ** 9, 10 ** 9 + 1, 7)
    assert [whitening.roots_above(poly, m, 0) for m in (-1, 0, 2, 3, 7, 10 ** 9, 10 ** 9 + 1)] == [7, 5, 5, 3, 2, 1, 0]
    got = whitening.top_roots(poly, 10)
    assert [(round(v / (1 << s)), k) for v, s, k in got] == [(10 ** 9 + 1, 1), (10 ** 9, 1), (7, 1), (3, 2)]
    assert all(abs(Fraction(v, 1 << s) - round(v / (1 << s))) < Fraction(1, 1 << 100) for v, s, _ in got)
    assert [round(v / (1 << s)) for v, s, _ in whitening.top_roots(poly, 2)] == [10 ** 9 + 1, 10 ** 9]
    assert whitening.top_roots([0, 0, 1], 5) == []


def test_vectors_of_a_repeated_root_are_orthonormal():
    m = [[5, 0, 0, 0], [0, 5, 0, 0], [0, 0, 5, 0], [0, 0, 0, 2]]
    (root, *_) = whitening.top_roots(product(5, 5, 5, 2), 4)
    v = np.array(whitening.null_vectors(m, *root))
    assert v.shape == (3, 4) and np.allclose(v @ v.T, np.eye(3), atol=1e-14) and np.allclose(v[:, 3], 0)


def whole(embedding):
    return [int(np.floor(64 * float(c))) + 1_000_000 for c in embedding]


def check_whitened(rows, kept):
    """rows of whiten() against numpy on the kept (vec_id, embedding)."""
    xs = [whole(e) for _, e in kept]
    n, s, m = exact(xs)
    v = np.array([[float(Fraction(c, n * n)) for c in r] for r in m])
    values, vectors = np.linalg.eigh(v)
    values, vectors = values[::-1], vectors[:, ::-1]
    rank = int((values > values[0] * 1e-10).sum())
    k = min(32, rank)
    assert len(rows) == k * len(kept) and {r.n for r in rows} == {n}
    by = {}
    for r in rows:
        by.setdefault(r.component, {}).setdefault(r.vec_id, []).append(r)
    assert sorted(by) == list(range(1, k + 1))
    centred = np.array([[float(Fraction(n * x - t, n)) for x, t in zip(row, s)] for row in xs])
    got = np.array([[by[c][i][0].whitened for c in range(1, k + 1)] for i, _ in kept])
    want = centred @ vectors[:, :k] / np.sqrt(values[:k])
    for c in range(k):
        assert min(np.abs(got[:, c] - want[:, c]).max(), np.abs(got[:, c] + want[:, c]).max()) < 1e-6
        assert abs(by[c + 1][kept[0][0]][0].explained / (values[c] / values.sum()) - 1) < 1e-4
    deviation = {i: sum((n * x - t) ** 2 for x, t in zip(row, s)) for (i, _), row in zip(kept, xs)}
    assert all(r.deviation == deviation[r.vec_id] for r in rows)
    cov = (got - got.mean(0)).T @ (got - got.mean(0)) / n
    (error,) = {r.identity_error for r in rows}
    assert error < 1e-9 and np.abs(cov - np.eye(k)).max() < 1e-9


def test_whitening_equals_numpy_on_the_small_table(spark):
    kept = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()]
    check_whitened(whitening.query(spark, SMALL).collect(), kept)


def test_whitening_drops_what_holds_no_vector(spark):
    rng = np.random.default_rng(5)
    good = [(i, [float(v) for v in rng.normal(size=4) * (1 + i % 3)]) for i in range(12)]
    bad = [(100, None), (101, [1.0, None, 2.0, 3.0]), (102, [float("nan")] * 4), (103, [1.0, float("inf"), 0.0, 0.0]), (104, []), (105, [1.0, 2.0]),
           (106, [1e30, 0.0, 0.0, 0.0])]
    schema = "vec_id long, embedding array<double>"
    df = spark.createDataFrame(good + bad + [(None, good[0][1])], schema).withColumn("i", F.lit("x")).withColumn("n", F.lit(1)).withColumn("component", F.lit(1))
    got = whitening.whiten(df).collect()
    assert {r.vec_id for r in got} == {i for i, _ in good} | {None}
    check_whitened([r for r in got], good + [(None, good[0][1])])
    for few in (spark.createDataFrame([], schema), df.limit(1), spark.createDataFrame([(1, [2.0, 3.0])] * 5, schema), spark.createDataFrame(bad[:5], schema)):
        none = whitening.whiten(few)
        assert none.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"] and none.count() == 0


def test_whitening_with_fewer_rows_than_dimensions_and_a_constant_one(spark):
    rng = np.random.default_rng(6)
    kept = [(i, [*(float(v) for v in rng.normal(size=7)), 1.5]) for i in range(5)]
    check_whitened(whitening.whiten(spark.createDataFrame(kept, "vec_id long, embedding array<double>")).collect(), kept)


def test_scatter_is_exact_for_huge_entries(spark):
    rng = random.Random(2)
    vectors = [[rng.randrange(-10 ** 15, 10 ** 15) for _ in range(3)] for _ in range(40)]
    rows = spark.createDataFrame([(i, [v / 64 for v in x]) for i, x in enumerate(vectors)], "vec_id long, embedding array<double>").repartition(5)
    n, sums, scatter = whitening.sums_of(whitening.valid(rows))
    assert (n, sums, scatter) == exact(vectors)
    with pytest.raises(Exception, match="(?i)too large|overflow|convert"):
        whitening.whiten(rows).collect()                              # a deviation past 64 bits stops


# ---------------------------------------------------------------- 13 mixing

def seeded(value):
    return int(hashlib.md5(f"{source_mixing.SEED}|{'' if value is None else value}".encode()).hexdigest()[:8], 16)


def targets_by_hand(sizes):
    """The contract's rounds: shares by weight, capped ones leave, the rest shares what they leave."""
    order = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: (1, 2, 3)[i % 3] for i, s in enumerate(order)}
    left, free, out = Fraction(sum(sizes.values())), set(order), {}
    while free:
        level = left / sum(weight[s] for s in free)
        over = {s for s in free if weight[s] * level > 3 * sizes[s]}
        if not over:
            out |= {s: weight[s] * level for s in free}
            break
        for s in over:
            out[s] = Fraction(3 * sizes[s])
            left -= out[s]
        free -= over
    return out


def mixed(df, **more):
    return source_mixing.copies(df, df.columns, **more).collect()


def check_mix(rows, docs):
    """rows of copies() for docs (doc_id, text, source)."""
    size = lambda t: len(re.findall("[^ \t\n\x0b\x0c\r]+", t or ""))
    sizes = Counter()
    for _, t, s in docs:
        sizes[s] += size(t)
    target = targets_by_hand({s: sizes[s] for s in {s for *_, s in docs}})
    assert len(rows) == len(docs)
    for r in rows:
        assert r.size == size(r["_row"].text) and r.source_size == sizes[r["_row"].source]
        assert abs(r.target - float(target[r["_row"].source])) < 1e-6
        assert 0 <= r.copies <= 3
    for s, t in target.items():
        mine = [r for r in rows if r["_row"].source == s]
        longest = max((r.size for r in mine), default=0)
        assert abs(sum(r.size * r.copies for r in mine) - t) <= longest + 1
        if sizes[s]:
            rate = Fraction(round(t), sizes[s])
            assert abs(sum(r.copies for r in mine) - rate * len(mine)) < 1
            assert {r.copies for r in mine} <= {int(rate), int(rate) + 1}


def corpus(seed, n=400):
    rng = random.Random(seed)
    names = ["b", "a", "Z", "é", "日", "", None, "zz"]
    share = [40, 9, 3, 2, 1, 1, 4, 30]
    out = []
    for i in range(n):
        s = rng.choices(names, share)[0]
        out.append((i, " ".join(["w"] * rng.choice([0, 1, 3, 20, 20, 60])), s))
    return out


@pytest.mark.parametrize("seed", range(2))
def test_mix_meets_its_targets(spark, seed):
    docs = corpus(seed)
    df = spark.createDataFrame(docs, "doc_id long, text string, source string")
    rows = mixed(df)
    check_mix(rows, docs)
    again = mixed(df.repartition(7))
    pick = lambda rs: sorted((r["_row"].doc_id, r.copies) for r in rs)
    assert pick(rows) == pick(again)
    got = Counter(r.doc_id for r in source_mixing.emit(df).collect())
    assert got == Counter({r["_row"].doc_id: r.copies for r in rows if r.copies})


def test_targets_stop_at_three_times_in_several_rounds():
    got = targets_by_hand({"a": 1, "b": 10, "c": 40, "d": 1000})
    assert got["a"] == 3 and got["b"] == 30 and got["c"] == 120 and got["d"] == 1051 - 153


def test_capped_sources_are_taken_exactly(spark):
    docs = [(0, "w", "a"), (1, "w " * 10, "b"), (2, "w " * 40, "c")] + [(3 + i, "w " * 10, "d") for i in range(100)]
    rows = mixed(spark.createDataFrame(docs, "doc_id long, text string, source string"))
    check_mix(rows, docs)
    assert [r.copies for r in sorted(rows, key=lambda r: r["_row"].doc_id)[:3]] == [3, 3, 3]


def test_mix_awkward(spark, awkward, nothing):
    rows = mixed(awkward)
    check_mix(rows, [(d, t, s) for d, t, _, s, _ in BASE])
    assert source_mixing.emit(awkward).columns == awkward.columns
    assert mixed(nothing) == [] and source_mixing.emit(nothing).columns == nothing.columns
    empty = spark.createDataFrame([(1, None, "a"), (2, "", None), (2, "", None), (None, " \t", "a")], "doc_id long, text string, source string")
    assert [(r.size, r.source_size, r.target, r.copies) for r in mixed(empty)] == [(0, 0, 0.0, 0)] * 4


def test_places_run_through_groups_that_fill_many_ranges(spark):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "23")
    try:
        rows = [("hot", i % 50, i) for i in range(600)] + [(None, 1, i) for i in range(5)] + [(f"g{i}", 0, i) for i in range(40)]
        got = ranges.numbered(spark, spark.createDataFrame(rows, "g string, v int, i long").repartition(9), "g", ["v", "i"]).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    by = {}
    for r in sorted(got, key=lambda r: (r.v, r.i)):
        by.setdefault(r.g, []).append(r.position)
    assert len(got) == len(rows) and all(p == list(range(len(p))) for p in by.values())
