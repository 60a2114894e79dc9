"""Page templates inside articles, URL trees against their recursive SQL, and every repeated line."""

from __future__ import annotations

from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from tidemark.llm import line_winnow, page_template, url_templates


# ---------------------------------------------------------------- 2 pages

def extracted(pages):
    tokens = [page_template.tokens(p) for p in pages]
    t = page_template.Template(tokens)
    return [page_template.article(p, t) for p in tokens]


BODY = "<p>{i} the main text of page {i} that is long enough to be it, with words of its own {i}</p>"


@pytest.mark.parametrize("junk", [
    "<section class='comments-area'><article class='comment-body'><p>reader says</p></article></section>",
    "<article class='comment-body'><p>reader says</p></article>",
    "<article class='teaser'><p>another one</p></article>",
    "<div class='related-posts'><p>more</p></div>",
    "<div class='post-navigation'><p>next</p></div>",
    "<div class='share-this'><p>share</p></div>",
    "<div class='ad-slot'><p>buy</p></div>",
    "<div class='author-comments'><p>reply</p></div>",
])
@pytest.mark.parametrize("place", ["<article>{body}{junk}</article>", "<main><article>{body}</article>{junk}</main>", "<article>{body}</article>{junk}"])
def test_junk_in_and_beside_the_article_goes(junk, place):
    page = "<html><body>" + place.format(body=BODY.format(i=1), junk=junk) + "</body></html>"
    assert extracted([page]) == ["1 the main text of page 1 that is long enough to be it, with words of its own 1"]


def test_main_keeps_the_lead_before_its_article():
    page = "<body><main><p>Lead of it</p><article><h1>Title</h1><p>and the text</p></article></main><p>outside</p></body>"
    assert extracted([page]) == ["Lead of it\nTitle\nand the text"]


def test_template_text_goes_inside_articles_but_headings_stay():
    pages = [f"<body><article><h2>Introduction</h2>{BODY.format(i=i)}<p>We moved to a new house.</p></article></body>" for i in range(8)]
    want = [f"Introduction\n{i} the main text of page {i} that is long enough to be it, with words of its own {i}" for i in range(8)]
    assert extracted(pages) == want
    # the template alone does it: without it the sentence stays
    tokens = [page_template.tokens(p) for p in pages]
    t = page_template.Template(tokens)
    t.fixed_text = set()
    assert [page_template.article(p, t) for p in tokens] == [w + "\nWe moved to a new house." for w in want]
    # copies count once, and pages that are copies of each other keep their text
    assert extracted(pages[:2] * 5) == [w + "\nWe moved to a new house." for w in want[:2]] * 5
    near = [f"<body><article><p>{'the same long text ' * 9}</p><p>{i}</p></article></body>" for i in range(6)]
    assert extracted(near) == [f"{('the same long text ' * 9).strip()}\n{i}" for i in range(6)]


def classes_by_hand(pages):
    """Roles by occurrence vector: position by position counts, no grouping of the operator's."""
    counts = [Counter(page_template.Template.role(t) for t in p) for p in pages]
    roles = {r for c in counts for r in c}
    return {frozenset(q for q in roles if all(c[q] == c[r] for c in counts)) for r in roles}


def test_spine_holds_the_classes_that_occur_once_in_most_pages():
    pages = [page_template.tokens(f"<body><div><b>x</b><i>{i}</i></div>{'<p>a</p>' * (i % 3)}<u>end</u></body>") for i in range(7)]
    t = page_template.Template(pages)
    n = len(pages)
    once = {r for c in classes_by_hand(pages) for r in c
            if all(Counter(page_template.Template.role(x) for x in p)[r] <= 1 for p in pages)
            and sum(any(page_template.Template.role(x) == r for x in p) for p in pages) >= page_template.SUPPORT * n}
    assert t.spine == once and any(r[0] == "t" and r[1] == "end" for r in t.fixed_text)


def test_very_long_pages_and_clashing_columns(spark):
    long = "<body><article>" + "".join(f"<p>paragraph number {i}</p>" for i in range(20000)) + "</article></body>"
    pages = spark.createDataFrame([(1, "http://h.org/1", long), (2, "http://h.org/2", None)], "page_id long, url string, html string")
    for c in ("_host", "_n", "_block", "text"):
        pages = pages.withColumn(c, F.lit("own"))
    got = {r.page_id: r.text for r in page_template.extract(pages).collect()}
    assert got[2] == "" and got[1] == "\n".join(f"paragraph number {i}" for i in range(20000))


# ---------------------------------------------------------------- 7 urls

def url_case(spark, path, urls, labels):
    spark.createDataFrame(urls, "page_id long, url string").withColumn("_salt", F.lit("own")).withColumn("template", F.lit("own")).write.parquet(f"{path}/pages.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int").write.parquet(f"{path}/labels.parquet")
    con = duckdb.connect()
    for t in ("pages", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{path}/{t}.parquet/*.parquet'")
    want = con.execute(f"SELECT page_id, host, path, rule, verdict FROM ({url_templates.SQL})").fetchall()
    got = [tuple(r) for r in url_templates.query(spark, str(path)).select("page_id", "host", "path", "rule", "verdict").collect()]
    return sorted(got, key=repr), sorted(want, key=repr)


@pytest.mark.parametrize("broadcast", [True, False])
def test_deep_and_wide_trees_equal_the_recursive_sql(spark, tmp_path, monkeypatch, broadcast):
    if not broadcast:
        monkeypatch.setattr(url_templates, "MAX_BROADCAST", 0)
    urls, labels = [], []
    for i in range(400):                                    # six levels, bad below one of them
        urls.append(f"http://deep.org/a/b/{'x' if i % 3 else 'y'}/c/{'spam' if i % 4 == 0 else 'news'}/{i}")
        labels.append((i, 0 if i % 4 == 0 else 1))
    for i in range(400, 2400):                              # a hundred branches of one host, two of them bad
        urls.append(f"http://wide.org/s{i % 100}/{i}?q")
        labels.append((i, 0 if i % 100 in (7, 70) else 1))
    urls += ["http://wide.org/about", "http://wide.org/", None, "nothing", "http://com/x/1", "http://deep.org/a/b/x/c/news/1"] * 3
    urls += [f"http://one.org/page/5/{'abc'[i % 3]}" for i in range(200)]   # one number names a label for many pages
    rows = [(i % 2390, u) for i, u in enumerate(urls)]      # some ids repeat
    got, want = url_case(spark, tmp_path, rows, labels + [(None, 0), (5, None)])
    assert got == want and len(got) == len(urls)
    blocked = {p for _, h, p, r, v in got if v == "block" and h == "wide.org"}
    assert blocked == {f"/s{i % 100}/{i}" for i in range(400, 2400) if i % 100 in (7, 70)}
    assert {p.split("/")[5] for _, h, p, _, v in got if v == "block" and h == "deep.org"} == {"spam"}


def test_ties_and_pages_without_labels_equal_sql(spark, tmp_path):
    urls = [(i, f"http://h.org/{'ab'[i % 2]}/{i}") for i in range(32)] + [(i, "http://h.org/a/x") for i in range(3)]
    got, want = url_case(spark, tmp_path, urls, [])
    assert got == want and {v for *_, v in got} == {"allow"}
    got, want = url_case(spark, tmp_path / "even", urls, [(i, i // 2 % 2) for i in range(32)])
    assert got == want
    got, want = url_case(spark, tmp_path / "none", [], [(1, 1)])
    assert got == want == []


@pytest.mark.parametrize("most", [60_000, 0])
def test_broadcasts_are_bounded_in_bytes_over_all_levels(spark, tmp_path, monkeypatch, most):
    monkeypatch.setattr(url_templates, "MAX_HELD", most, raising=False)
    monkeypatch.setattr(url_templates, "HOT", 60, raising=False)
    sent, broadcast, staged = [0], F.broadcast, url_templates.staged

    def size(df):
        found = df.collect()
        return 160 * len(found) + 2 * sum(len(x) for r in found for x in r if isinstance(x, str))

    def noted(df):
        sent[-1] += size(df)
        return broadcast(df)

    def cut(session, df, name):
        out = staged(session, df, name)
        if name == "url-levels":
            sent.append(0)
        return out

    monkeypatch.setattr(url_templates.F, "broadcast", noted)
    monkeypatch.setattr(url_templates, "staged", cut)
    urls, labels = [], []
    for i in range(900):                                    # a hundred sections of long names on each of five levels
        n = i // 9
        urls.append(f"http://h{n // 20}.org/" + "/".join(f"{k}-{n}-{'section' * (5 + n % 9)}" for k in "abcde") + f"/{i}")
        labels.append((i, 0 if n % 10 == 3 else 1))
    urls += [f"http://hot.org/page/7/{i % 40}" for i in range(300)]   # one host, template and label of many pages
    urls += [None, "nothing", "http://hot.org/"] * 30
    got, want = url_case(spark, tmp_path, list(enumerate(urls)), labels)
    assert got == want and len(got) == len(urls)
    assert {v for *_, v in got} == {"allow", "block"}
    assert max(sent) <= 3 * most                            # labels, what the levels before carry on, and one level's table


# ---------------------------------------------------------------- 6 lines

def test_no_later_copy_of_any_line_stays(spark, awkward, nothing):
    texts = ["one\ntwo\nthree", "three\n\n one \nfour", "four\nfour", "two", None, ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.text for r in line_winnow.dedup_lines(docs, single_words=line_winnow.EVERY_LINE).collect()}
    assert got == {0: "one\ntwo\nthree", 1: "\nfour", 2: "", 3: "", 4: None, 5: ""}
    rows = line_winnow.dedup_lines(awkward, report=True, single_words=line_winnow.EVERY_LINE).dropDuplicates(["doc_id", "text"]).collect()
    kept = Counter(x.strip(" ") for r in rows for x in (r.text or "").split("\n") if x.strip(" "))
    assert max(kept.values()) == 1
    assert line_winnow.dedup_lines(nothing, single_words=line_winnow.EVERY_LINE).count() == 0
