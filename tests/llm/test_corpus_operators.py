"""The operators of tidemark.llm on awkward documents and against brute force."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tests.llm.conftest import BASE, PASSAGE, texts
from tidemark.llm import (decontaminate, line_winnow, page_template, pattern_packing, quality_fm, registry, runlength_index, simhash_grid,
                          spot_signatures, substring_dedup, url_templates)

SMALL = "/root/testdata/sf0.001"
TABLES = ("documents", "pages", "benchmark", "labels")


def same(got, want):
    assert sorted(map(repr, got)) == sorted(map(repr, want))


def rows(df, *columns):
    return [tuple(r[c] for c in columns or df.columns) for r in df.collect()]


# ---------------------------------------------------------------- against SQL

@pytest.mark.parametrize("name", sorted(registry()[1]))
def test_query_equals_its_sql(spark, name):
    queries, oracle = registry()
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    got = queries[name](spark, SMALL)
    columns = sorted(got.columns)
    same(rows(got, *columns), con.execute(f"SELECT {', '.join(columns)} FROM ({oracle[name]})").fetchall())


@pytest.mark.parametrize("name", ["op3_spot_signatures", "op4_decontaminate", "op5_substring_dedup", "op6_line_winnow"])
def test_awkward_documents_equal_sql(spark, awkward, tmp_path, name):
    awkward.dropDuplicates(["doc_id"]).select("doc_id", "text").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, PASSAGE), (2, "short"), (2, "short"), (3, None), (None, "日本語 text naïve"), (4, "")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{tmp_path}/{t}.parquet/*.parquet'")
    queries, oracle = registry()
    got = queries[name](spark, str(tmp_path))
    columns = sorted(got.columns)
    if name == "op3_spot_signatures":  # DuckDB sorts the null id last
        columns = ["doc_id", "n_chars", "fingerprint"]
    same(rows(got, *columns), con.execute(f"SELECT {', '.join(columns)} FROM ({oracle[name]})").fetchall())


# ---------------------------------------------------------------- 1 quality

def test_sum_of_squares_identity():
    m = quality_fm.FactorMachine(factors=3)
    rng = np.random.default_rng(0)
    m.w = rng.normal(size=quality_fm.N_FEATURES)
    m.v = rng.normal(size=(quality_fm.N_FEATURES, 3))
    feat, val = np.array([3, 9, 40, quality_fm.N_FEATURES - 1]), np.array([.5, 1, 2, .25])
    pairs = sum(m.v[feat[i]] @ m.v[feat[j]] * val[i] * val[j] for i in range(4) for j in range(i))
    want = m.w0 + m.w[feat] @ val + pairs
    assert np.allclose(m.raw(np.zeros(4, int), feat, val, 1), [want])


def test_quality_learns_and_ignores_held_out_labels(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    got = {r["doc_id"]: r for r in quality_fm.score(docs, quality_fm.train(docs, labels)).collect()}
    assert len(got) == docs.count()
    truth = {r["doc_id"]: r["quality"] for r in labels.collect()}
    assert all(r["held_out"] == (zlib.crc32(str(d).encode()) % 5 == 0) for d, r in got.items())
    held = [(r["score"], r["predicted"], truth[d]) for d, r in got.items() if r["held_out"] and d in truth]
    assert all(p == 1 for _, p, t in held if t == 1)
    assert np.mean([p == t for _, p, t in held]) > 0.95
    flipped = labels.selectExpr("doc_id", f"CASE WHEN crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) % 5 = 0 THEN 1 - quality ELSE quality END AS quality")
    again = {r["doc_id"]: r["score"] for r in quality_fm.score(docs, quality_fm.train(docs, flipped)).collect()}
    assert again == {d: r["score"] for d, r in got.items()}


def test_quality_awkward(spark, awkward, nothing):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    model = quality_fm.train(awkward, none)
    got = rows(quality_fm.score(awkward, model), "doc_id", "score", "predicted")
    assert len(got) == len(BASE) and all(0 <= s <= 1 for _, s, _ in got)
    assert quality_fm.score(nothing, model).count() == 0
    labels = spark.createDataFrame([(1, 1, 0), (5, None, 0), (13, 0, 0), (None, 0, 0), (2, 1, None)], "doc_id long, quality int, toxic int")
    kept = quality_fm.keep_good(awkward, quality_fm.train(awkward, labels))
    assert kept.columns == awkward.columns and kept.count() <= len(BASE)
    assert quality_fm.keep_good(nothing, model).columns == nothing.columns


# ---------------------------------------------------------------- 2 pages

PAGE = """<!DOCTYPE html><html><head><title>T &amp; x</title><style>p{{}}</style></head><body class="page with-sidebar"><header>Site</header>
<nav><ul><li><a href="/a">Menu</a></ul></nav><div class="cookie-notice">We use cookies</div><aside>Side</aside>
<article><h1>{title}</h1><p>First &eacute;  para\n graph <b>bold<br>line<p>Second &lt;b&gt; &#8212; {title}<script>var p = "</p>";</script>
<div class="ad">Buy</div><form>Mail<input></form><ul><li>one<li>two</ul></article><section id="comments"><p>nice</p></section><footer>(c)</footer></body></html>"""


def test_page_extraction(spark):
    data = [(i, f"https://h.example.com/{i}", PAGE.format(title=f"Title {i}")) for i in range(9)]
    data += [(20, None, None), (21, "x", ""), (22, "http://one.example.org/", "<article><p>Only &amp; one"), (22, "http://one.example.org/", "<article><p>Only &amp; one"),
             (23, "http://two.example.org/", "plain text, no markup"), (24, "http://two.example.org/b", "<p>a<p>b</body></html>")]
    pages = spark.createDataFrame(data, "page_id long, url string, html string").withColumn("_host", F.lit("x"))
    got = sorted(rows(page_template.extract(pages), "page_id", "text"))
    want = [(i, f"Title {i}\nFirst é para graph bold line\nSecond <b> — Title {i}\none\ntwo") for i in range(9)]
    want += [(20, ""), (21, ""), (22, "Only & one"), (22, "Only & one"), (23, "plain text, no markup"), (24, "a\nb")]
    assert got == want
    assert page_template.extract(pages.limit(0)).count() == 0


def test_page_template_classes():
    pages = [page_template.tokens(f"<body><div class=x><p>Same</p><p>text {i}</p></div><table><tr><td>{i}</td></tr></table></body>") for i in range(6)]
    t = page_template.Template(pages)
    assert any(r[0] == "t" and r[1] == "Same" for r in t.fixed_text)
    assert page_template.article(pages[2], t).split("\n")[0] == "text 2"


def test_template_text_by_support_and_nested_classes():
    notice, share = "<div><p>We moved house</p></div>", "<span>Share this</span>"
    pages = [f"<body>{notice if i else ''}<div><p>text {i}</p></div><ul><li>a{i} {share}</li><li>b{i} {share}</li></ul></body>" for i in range(6)] + ["", "<body></body>"]
    tokens = [page_template.tokens(p) for p in pages]
    t = page_template.Template(tokens)
    assert [page_template.article(p, t) for p in tokens] == [f"text {i}\na{i}\nb{i}" for i in range(6)] + ["", ""]


@pytest.mark.parametrize("page, want", [
    ("<div id=page class='has-sidebar'><article><p>One</p></article></div>", "One"),
    ("<article class='post has-related'><p>One</p></article>", "One"),
    ("<article class=related><p>One</p></article>", "One"),
    ("<main class='no-comments'><p>One</p></main>", "One"),
    ("<article><div class='article-header'><h1>Title</h1></div><h2 class=header>Two</h2><p>One</p></article>", "Title\nTwo\nOne"),
    ("<article><p data-id=footer data-role='menu'>One</p></article>", "One"),
    ("<div class=content data-x='1' class=search><p>nearly all of the text of the page</p></div><p>rest</p>", "nearly all of the text of the page\nrest"),
    ("<article><p>Long enough to be the main text</p><div class='x site-footer'>f</div><div id='cookie-notice'>c</div><p class=menu>m</p><p class='share-links'>s</p></article>", "Long enough to be the main text"),
])
def test_names_mark_whole(page, want):
    tokens = [page_template.tokens(f"<html><body>{page}</body></html>")]
    assert page_template.article(tokens[0], page_template.Template(tokens)) == want


def test_slots_beside_the_largest_element_stay():
    pages = [page_template.tokens(f"<body><div class=intro>Intro {i}</div><div class=body><p>{f'body {i} ' * 20}</p></div><div class=footer>f{i}</div></body>") for i in range(6)]
    t = page_template.Template(pages)
    assert [page_template.article(p, t) for p in pages] == [f"Intro {i}\n{(f'body {i} ' * 20).strip()}" for i in range(6)]


# ---------------------------------------------------------------- 3 fingerprints

def test_spot_signatures_awkward(awkward, nothing):
    got = {}
    for r in spot_signatures.fingerprints(awkward).collect():
        got.setdefault(r["doc_id"], []).append(r)
    assert sum(map(len, got.values())) == len(BASE)
    assert got[5][0]["fingerprint"] == got[6][0]["fingerprint"] != ""
    assert got[5][0]["near_next"] == 1.0  # an equal text follows
    assert got[2][0]["fingerprint"] == "" and got[2][0]["near_next"] == 1.0  # null, then empty
    assert got[2][0]["n_chars"] == 0 and got[2][0]["edited_sha256"] == hashlib.sha256(b"").hexdigest()
    first = BASE[-4][1]  # the null id sorts first, so it follows the last
    last = BASE[-1][1]
    edited = last[: len(last) - len(last) // 2] + first[: len(last) // 2]
    assert got[13][0]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
    assert spot_signatures.fingerprints(nothing).count() == 0


def test_next_document_over_many_ranges(spark, monkeypatch):
    monkeypatch.setattr(spot_signatures, "RANGE_ROWS", 3)
    ids = [5, 9, 10, 11, 400, 401, 70000, -3, 8, 100000]
    docs = spark.createDataFrame([(i, f"text number {i} of the set") for i in ids], "doc_id long, text string")
    got = dict(rows(spot_signatures.fingerprints(docs), "doc_id", "edited_sha256"))
    order = sorted(ids)
    for a, b in zip(order, order[1:] + order[:1]):
        t, u = f"text number {a} of the set", f"text number {b} of the set"
        assert got[a] == hashlib.sha256((t[: len(t) - len(t) // 2] + u[: len(t) // 2]).encode()).hexdigest()


def test_length_partition_prunes_only_unlike_sets(spark):
    sizes = spark.createDataFrame([(n, list(map(str, range(n)))) for n in range(0, 200)], "n int, s array<string>")
    part = dict(rows(sizes.select("n", spot_signatures.length_partition("s").alias("p")), "n", "p"))
    for a in range(1, 200):
        for b in range(a, 200):
            if a / b >= spot_signatures.THRESHOLD:
                assert abs(part[a] - part[b]) <= 1


# ---------------------------------------------------------------- 4 decontamination

def test_decontamination_drop_and_cut(spark, awkward, nothing):
    bench = spark.createDataFrame([(1, " ".join(PASSAGE.split()[10:25]).upper()), (2, "ñandú"), (3, None)], "item_id long, text string")
    left = decontaminate.drop(awkward, bench)
    assert left.columns == awkward.columns
    assert {5, 6, 7, 8}.isdisjoint({r["doc_id"] for r in left.collect()}) and left.count() == len(BASE) - 4
    cut = {r["doc_id"]: r for r in decontaminate.cut(awkward, bench).collect()}
    words = PASSAGE.split()
    assert cut[5]["text"].split() == words[:10] + words[25:] and cut[5]["n_chars"] == len(cut[5]["text"])
    assert cut[1]["text"] == BASE[0][1]
    assert decontaminate.drop(nothing, bench).count() == 0
    empty = decontaminate.report(awkward, bench.limit(0))
    assert empty.count() == len(BASE) and empty.where("contaminated").count() == 0


def test_decontamination_without_broadcast(spark, awkward, monkeypatch):
    bench = spark.createDataFrame([(1, PASSAGE), (2, "short")], "item_id long, text string")
    want = rows(decontaminate.report(awkward, bench))
    monkeypatch.setattr(decontaminate, "bounded", lambda df, rows=0: df)
    same(rows(decontaminate.report(awkward, bench)), want)


# ---------------------------------------------------------------- 5 substrings

def brute_substrings(data, window):
    words = [re.findall("[^\x20\x09-\x0d]+", t or "") for _, t in data]
    seen = Counter(tuple(w[i: i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for (d, _), w in zip(data, words):
        gone = {p for i in range(len(w) - window + 1) if seen[tuple(w[i: i + window])] > 1 for p in range(i, i + window)}
        kept = " ".join(x for p, x in enumerate(w) if p not in gone)
        out.append((d, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


@pytest.mark.parametrize("window", [3, 35])
def test_substrings_equal_brute_force(awkward, nothing, window):
    got = substring_dedup.remove_repeats(awkward, window)
    same(rows(got, "doc_id", "n_words", "n_removed", "kept_sha256"), brute_substrings(texts(), window))
    assert substring_dedup.remove_repeats(nothing).count() == 0


def test_window_counts_over_small_macros(awkward, monkeypatch):
    """Counting in many small parts gives the same answer as in one."""
    from tidemark.llm import window_counts
    monkeypatch.setattr(window_counts, "MACRO", 50)
    got = substring_dedup.remove_repeats(awkward, 4)
    same(rows(got, "doc_id", "n_words", "n_removed", "kept_sha256"), brute_substrings(texts(), 4))


# ---------------------------------------------------------------- 6 lines

def test_lines_awkward(awkward, nothing):
    out = line_winnow.dedup_lines(awkward)
    assert out.columns == awkward.columns and out.count() == len(BASE)
    got = {r["doc_id"]: r for r in out.collect()}
    assert got[1]["text"] == BASE[0][1]
    assert got[9]["text"] == "another ending" and got[9]["n_chars"] == 14
    assert got[5]["text"] == PASSAGE and got[6]["text"] == ""  # one line of 50 words or more
    assert got[2]["text"] is None and got[4]["text"] == BASE[3][1] and got[12]["text"] == BASE[-2][1]
    assert line_winnow.dedup_lines(nothing).count() == 0


def test_lines_long_runs_and_self_repeats(spark):
    run = [f"line {i} of the run" for i in range(30)]
    docs = [(1, "\n".join(["intro"] + run)), (2, "\n".join(run[5:20] + ["own"])), (3, "a\nb\n\nz\na\nb"), (4, "\n".join(run[3:5] + run[10:12])), (5, "line 7 of the run")]
    got = dict(rows(line_winnow.dedup_lines(spark.createDataFrame(docs, "doc_id long, text string"))))
    assert got == {1: docs[0][1], 2: "own", 3: "a\nb\n\nz", 4: "", 5: "line 7 of the run"}


def test_single_lines_between_unlike_neighbours(spark, awkward):
    line = "This work is licensed under the GNU General Public License, version 3."
    docs = [(i, f"before {i}\n{line}\nafter {i}") for i in range(5)] + [(7, "own\n" + line.replace(" ", "\t")), (8, line.replace(" ", "\t")), (9, "seven words are not enough for this\nx"), (10, "seven words are not enough for this")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = dict(rows(line_winnow.dedup_lines(df, single_words=line_winnow.SINGLE_WORDS)))
    assert got == {0: docs[0][1], **{i: f"before {i}\nafter {i}" for i in range(1, 5)}, 7: docs[5][1], 8: "", 9: docs[7][1], 10: docs[8][1]}
    import corpus_pipeline as p
    assert dict(rows(p.line_dedup(spark, df, SMALL))) == got
    documents = awkward.dropDuplicates(["doc_id"]).select("doc_id", "text").union(df.where("doc_id > 7")).toArrow()
    con = duckdb.connect()
    con.register("documents", documents)
    want = con.execute(f"SELECT doc_id, text, n_removed FROM ({line_winnow.SQL_SINGLE})").fetchall()
    mixed = spark.createDataFrame(documents)
    same(rows(line_winnow.dedup_lines(mixed, report=True, single_words=line_winnow.SINGLE_WORDS), "doc_id", "text", "n_removed"), want)


# ---------------------------------------------------------------- 7 urls

def test_url_parts_and_rules(spark):
    urls = ["https://WWW.Example.COM/en/1?x#y", "http://m.example.com/en/", "http://a.net/es/5", "http://b.a.net/de/5", "http://x.com", "no scheme", None, "", "http://",
            "ftp://h.org?q", "https://example.com/de/1#t", "x://y://z/p", "http://notexample.com/en/1"]
    pages = spark.createDataFrame([(i, u, None) for i, u in enumerate(urls)], "page_id long, url string, good int")
    got = sorted(rows(url_templates.judged(pages), "page_id", "host", "path", "rule", "verdict"))
    want = [("www.example.com", "/en/1", "www.example.com/en/", "allow"), ("m.example.com", "/en/", "example.com/en/", "block"), ("a.net", "/es/5", "net/es/", "block"),
            ("b.a.net", "/de/5", None, "allow"), ("x.com", "", None, "allow"), ("", "", None, "allow"), ("", "", None, "allow"), ("", "", None, "allow"), ("", "", None, "allow"),
            ("h.org", "", None, "allow"), ("example.com", "/de/1", "com/", "allow"), ("y:", "//z/p", None, "allow"), ("notexample.com", "/en/1", "com/", "allow")]
    assert got == [(i, *w) for i, w in enumerate(want)]
    assert url_templates.judged(pages.limit(0)).count() == 0


def test_url_templates_split_bad_branches(spark):
    pages = [(i, f"http://h.org/{'spam' if i % 2 else 'news'}/{i}/view", 0 if i % 2 else 1) for i in range(60)]
    pages += [(100 + i, f"http://h.org/{'blog' if i % 2 else 'wiki'}/{i}", 1) for i in range(60)]
    got = url_templates.judged(spark.createDataFrame(pages, "page_id long, url string, good int")).collect()
    assert {r["verdict"] for r in got if "/spam/" in r["path"]} == {"block"}
    assert {r["verdict"] for r in got if "/spam/" not in r["path"]} == {"allow"}
    assert all("*" in r["template"] for r in got)


def test_url_templates_many_labels_on_one_host(spark):
    pages = spark.range(240_000).select(F.col("id").alias("page_id"), F.expr("concat('http://h.org/', if(id % 2 = 0, 'news/', 'spam/'), id)").alias("url"), (1 - F.col("id") % 2).alias("good"))
    got = rows(url_templates.judged(pages).groupBy(F.split("path", "/")[1].alias("top"), "verdict").count())
    assert sorted(got) == [("news", "allow", 120_000), ("spam", "block", 120_000)]


def test_url_branches_of_a_large_host_and_deep_paths(spark, monkeypatch):
    pages = [f"/s{i % 100}/{i}" for i in range(3000)] + [f"/a/b/c/d/e/f/g/h/{'spam' if i % 2 else 'news'}/{i}" for i in range(80)]
    pages += ["/z" * 700, "/z/1/2/3/4/5/6"]  # long paths of their own
    data = [(i, f"http://h.org{p}", 0 if p.startswith("/s7/") or "spam" in p else 1) for i, p in enumerate(pages)]
    df = spark.createDataFrame(data, "page_id long, url string, good int")
    for most in (url_templates.MAX_BROADCAST, 0):  # broadcast, then salted
        monkeypatch.setattr(url_templates, "MAX_BROADCAST", most, raising=False)
        got = url_templates.judged(df).collect()
        assert len(got) == len(data) == len({r["page_id"] for r in got})
        assert {r["path"] for r in got if r["verdict"] == "block"} == {p for p in pages if p.startswith("/s7/") or "spam" in p}


# ---------------------------------------------------------------- 8 simhash

def simhash(text):
    w = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    grams = [" ".join(w[i: i + 4]) for i in range(len(w) - 3)] if len(w) >= 4 else ([" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << k for k in range(64) if 2 * sum(x >> k & 1 for x in h) > len(h))


def brute_groups(ids, fps, bits=4):
    up = list(range(len(fps)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x
    for i in range(len(fps)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= bits:
                a, b = root(i), root(j)
                up[max(a, b)] = min(a, b)
    low = {}
    for i, d in enumerate(ids):
        if d is not None:
            low[root(i)] = min(low.get(root(i), d), d)
    return [low.get(root(i)) for i in range(len(fps))]


def test_simhash_equals_brute_force(spark, awkward, nothing):
    data = texts() + [(100 + r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    docs = spark.createDataFrame(data, "doc_id long, text string")
    fps = [simhash(t) for _, t in data]
    want = [(d, f, g) for (d, _), f, g in zip(data, fps, brute_groups([d for d, _ in data], fps))]
    got = [(d, f % (1 << 64), g) for d, f, g in rows(simhash_grid.near_groups(docs), "doc_id", "fp", "component_id")]
    same(got, want)
    assert simhash_grid.near_groups(nothing).count() == 0
    kept = simhash_grid.keep_one(awkward)
    assert kept.columns == awkward.columns
    ids = [r["doc_id"] for r in kept.collect()]
    groups = {g for _, _, g in [w for w in want if w[0] is None or w[0] < 100]}
    assert len(ids) == len(set(ids)) == len(groups) and {2, 5, 9} <= set(ids) and not {3, 4, 6} & set(ids)


@pytest.mark.parametrize("block", [50_000, 8])
def test_simhash_links_are_complete(spark, block):
    """Random clusters of close fingerprints, chains included; small blocks split the cells."""
    rng = np.random.default_rng(3)
    fps = []
    for _ in range(40):
        x = int(rng.integers(0, 1 << 63))
        for _ in range(int(rng.integers(1, 30))):
            fps.append(x)
            for k in rng.integers(0, 64, int(rng.integers(0, 6))):
                x ^= 1 << int(k)
    fps = sorted({np.uint64(f).astype(np.int64).item() for f in fps})
    nodes = spark.createDataFrame([(f,) for f in fps], "fp long")
    from tidemark.llm.staging import components
    root = dict(rows(components(spark, simhash_grid.links(nodes, block=block))))
    want = brute_groups(fps, [f % (1 << 64) for f in fps])
    assert [root.get(f, f) for f in fps] == want


def test_popcount_embedding_bounds_hamming():
    rng = np.random.default_rng(4)
    a, b = rng.integers(0, 1 << 63, (2, 500), dtype=np.uint64)
    gap = np.abs(simhash_grid.embedding(a) - simhash_grid.embedding(b)).sum(axis=1)
    assert (gap <= simhash_grid.hamming(a, b)).all()


# ---------------------------------------------------------------- 9 long repeats

def brute_bytes(data, length):
    raw = [(t or "").encode() for _, t in data]
    seen = Counter(t[i: i + length] for t in raw for i in range(len(t) - length + 1))
    out = []
    for (d, _), t in zip(data, raw):
        gone = np.zeros(len(t) + 1, int)
        for i in range(len(t) - length + 1):
            if seen[t[i: i + length]] > 1:
                gone[i] += 1
                gone[i + length] -= 1
        gone = np.cumsum(gone)[:-1] > 0
        kept = bytes(np.frombuffer(t, np.uint8)[~gone])
        spans = int(np.sum(np.diff(np.concatenate([[0], gone.astype(int)])) == 1))
        out.append((d, len(t), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("length,gram,hot", [(400, 64, 3000), (40, 8, 3000), (40, 8, 1)])
def test_long_repeats_equal_brute_force(awkward, nothing, length, gram, hot):
    got = runlength_index.remove_long_repeats(awkward, length, gram, hot)
    same(rows(got, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"), brute_bytes(texts(), length))
    assert runlength_index.remove_long_repeats(nothing).count() == 0


@pytest.mark.parametrize("seed", range(8))
def test_matching_statistics(seed):
    rng = np.random.default_rng(seed)
    text = rng.integers(97, 98 + seed % 4, int(rng.integers(1, 150))).astype(np.uint8)
    text = np.append(np.tile(text, 1 + seed % 3), runlength_index.SEPARATOR).astype(np.uint8)
    b, n = text.tobytes(), len(text)

    def common(i, j):
        k = 0
        while i + k < n and j + k < n and b[i + k] == b[j + k]:
            k += 1
        return k
    want = [max([common(i, j) for j in range(n) if j != i], default=0) for i in range(n)]
    assert runlength_index.RunLengthIndex(text).matching_statistics().tolist() == want


# ---------------------------------------------------------------- 10 packing

def test_packing(spark, awkward, nothing):
    import public_tokenizers
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tok.encode_special_tokens = True
    extra = [(200, "a<|endoftext|>b  c\n\n d\u00a0e \u3000 f' s't \t\t x"), (201, " lead"), (202, "trail "), (203, "\n  a\r\n b")]
    docs = awkward.select("doc_id", "text").union(spark.createDataFrame(extra, "doc_id long, text string")).withColumn("piece", F.lit(1))
    got = pattern_packing.pack(docs).collect()
    want = Counter()
    for d, t in texts() + extra:
        ids = tok.encode(t or "", add_special_tokens=False).ids + [2]
        first = len(ids) % 1024 or 1024 if len(ids) > 1024 else len(ids)
        start, k = 0, 0
        while start < len(ids):
            end = first if start == 0 else start + 1024
            want[d, k, start, end - start, zlib.crc32(np.array(ids[start:end], "<u4").tobytes())] += 1
            start, k = end, k + 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == want
    sequences = {}
    for r in got:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024
    assert pattern_packing.pack(nothing).count() == 0


@pytest.mark.parametrize("seed", range(5))
def test_plan_uses_every_piece_once(seed):
    rng = np.random.default_rng(seed)
    hist = np.zeros(1025, int)
    np.add.at(hist, np.clip(rng.lognormal(4 + seed / 2, 1, 4000).astype(int), 1, 1024), 1)
    used = np.zeros(1025, int)
    sequences = 0
    for lengths, times in pattern_packing.plan(hist):
        assert sum(lengths) <= 1024 and times > 0
        np.add.at(used, list(lengths), times)
        sequences += times
    assert (used == hist).all()
    least = -(-int((hist * np.arange(1025)).sum()) // 1024)
    assert sequences <= max(least * 1.03 + 2, hist[513:].sum() + 2)


def test_words_cut_nowhere_the_tokenizer_joins():
    import public_tokenizers
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tok.encode_special_tokens = True
    coder = pattern_packing.WordCoder(pattern_packing.tokenizer_json())
    rng = np.random.default_rng(1)
    alphabet = list("ab1' \n\t!éß\u00a0\u2003\u0301\u200b日😀") + ["'s", "  ", " the", "\r\n"]
    samples = ["".join(rng.choice(alphabet, int(rng.integers(0, 40)))) for _ in range(1500)]
    want = [np.array(tok.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in samples]
    assert coder.encode(samples) == want


# ---------------------------------------------------------------- pipeline

def test_pipeline_runs_and_matches_its_stages(spark):
    import corpus_pipeline as p
    assert [n for n, _ in p.STAGES] == ["quality_classifier", "line_dedup", "simhash_near_dedup", "benchmark_decontamination", "best_fit_packing"]
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    now, sizes = docs, []
    for _, stage in p.STAGES[:-1]:
        now = stage(spark, now, SMALL)
        assert now.columns == docs.columns and now.dtypes == docs.dtypes
        sizes.append(now.count())
    data = [(r["doc_id"], r["text"]) for r in now.collect()]
    assert sizes == sorted(sizes, reverse=True) and 0 < len(data) < docs.count()
    fps = [simhash(t) for _, t in data]
    assert brute_groups([d for d, _ in data], fps) == [d for d, _ in data]  # no near copies are left
    grams = {tuple(w[i: i + 10]) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()
             for w in [re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", r["text"].lower())] for i in range(len(w) - 9)}
    for _, t in data:
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t.lower())
        assert not any(tuple(w[i: i + 10]) in grams for i in range(len(w) - 9))
    out = p.run(spark, SMALL).collect()
    assert {r["doc_id"] for r in out} == {d for d, _ in data}
    per = Counter()
    for r in out:
        per[r["sequence_id"]] += r["length"]
    assert max(per.values()) <= 1024 and len(per) <= sum(per.values()) / 1024 + 3


def test_pipeline_on_awkward_documents(spark, awkward):
    import corpus_pipeline as p
    now = awkward
    for name, stage in p.STAGES[1:]:
        now = stage(spark, now, SMALL)
    assert now.count() > 0
