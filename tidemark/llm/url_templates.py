"""URL filter by a path-template tree.

Rules decide first.  Every other page goes by its template:

1. Paths are split into segments.  From the root of each host downwards, the
   values of the next segment under one template are counted.  A value that is
   rare there (under ``MIN_PAGES`` pages) is variable and becomes the wildcard ``*``,
   however large the host is.
2. Frequent siblings whose share of good labels does not differ from their
   parent's (chi-square of one degree below ``SAME``) merge into one branch ``~``;
   the others stay literal.
3. A template's purity is its share of good labels, smoothed towards the share
   of all pages by ``PRIOR`` pages.  Below ``REJECT`` it is blocked.

Each level is one map-side combined count per (host, template, value) and a join with
the frequent values only, which is broadcast behind a checked size in bytes, else by shuffle
with hot keys salted, so a host with a third of all pages is never gathered.  The pages are
written whenever the broadcasts of their plan pass ``MAX_HELD``, so the driver's memory
follows neither the pages nor the levels.  The tree goes down as far as any
template still has ``MIN_PAGES`` pages with segments; below that all values are rare.

The SQL grows the same tree by recursion, level by level, over single pages instead of counts.

Only DataFrame functions run here.  Defined cases: a null url, or one without
``://``, has an empty host and path; pages without a label shape the tree but not
the purity; repeated rows count each; without labels everything is allowed.
"""

from __future__ import annotations

import math
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.decontaminate import LOWER, MAX_BROADCAST, UPPER
from tidemark.llm.staging import staged

MIN_PAGES = 8
SAME = 3.84
PRIOR = 20
REJECT = 0.7
#: Levels between two written tables of the pages, at most.
STEP = 4
#: Bytes of one broadcast, and of those that the levels of one plan carry on.
MAX_HELD = 8 * 1024 * 1024
#: What a row of a broadcast takes besides its texts, as measured (140 to 180 for rows of texts, 57 for numbers).
ROW_BYTES = 160
#: Where a looked-up table is too large to broadcast: rows from which on a key is hot, and parts into which it is dealt.
HOT = 10_000
SALTS = 16

#: The contract's rules (verdict, host, path).
RULES = (("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/"))


def split_url(url: Column) -> tuple[Column, Column]:
    """(host, path) of a url."""
    text = F.coalesce(url, F.lit(""))
    at = F.instr(text, "://")
    rest = F.when(at > 0, F.substring(text, at + 3, F.length(text))).otherwise("")
    return F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, else nulls."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for action, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):  # the longest ends up outermost
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule, verdict = F.when(fits, F.lit(h + p)).otherwise(rule), F.when(fits, F.lit(action)).otherwise(verdict)
    return rule, verdict


def _deepest(df: DataFrame) -> int:
    """Levels down to which some template has MIN_PAGES pages with segments; one long path adds none."""
    sizes = df.groupBy("host", "template", F.size("_segs").alias("_size")).count()
    longer = F.sum("count").over(Window.partitionBy("host", "template").orderBy(F.desc("_size")))
    return sizes.withColumn("_longer", longer).where(F.col("_longer") >= MIN_PAGES).agg(F.max("_size")).first()[0] or 0


def _held(table: DataFrame) -> float:
    """Bytes that a broadcast of ``table`` holds, in the driver too: its texts twice, as key and as value."""
    texts = reduce(add, [F.coalesce(F.octet_length(c), F.lit(0)) for c, kind in table.dtypes if kind == "string"], F.lit(0))
    n, size = table.agg(F.count("*"), F.coalesce(F.sum(texts), F.lit(0))).first()
    return n * ROW_BYTES + 2 * size if n <= MAX_BROADCAST else math.inf


def _looked_up(df: DataFrame, table: DataFrame, keys: list[str], held: float) -> DataFrame:
    """``df`` with the columns of ``table`` (one row per ``keys``, ``held`` bytes; nulls where it has none).

    A small table is broadcast.  A larger one is joined by shuffle, each hot key dealt in ``SALTS`` parts, so that
    the rows of a key that a third of ``df`` has are spread over as many tasks; rows with a null key are dealt by
    all their columns.  The caller writes what comes from a shuffle if it is used more than once."""
    if held <= MAX_HELD:
        return df.join(F.broadcast(table), keys, "left")
    complete = reduce(lambda x, y: x & y, [F.col(k).isNotNull() for k in keys])
    own = F.xxhash64(*df.columns)
    hot = df.where(complete).groupBy(*keys).count().where(F.col("count") > HOT).select(*keys, F.lit(SALTS).alias("_parts"))
    hot = staged(df.sparkSession, hot, "url-hot")  # at most a HOT-th of the rows
    if _held(hot) <= MAX_HELD:
        df, table = (x.join(F.broadcast(hot), keys, "left").fillna(1, ["_parts"]) for x in (df, table))
    else:
        df, table = (x.withColumn("_parts", F.lit(SALTS)) for x in (df, table))
    salted = df.withColumn("_salt", F.when(complete, F.pmod(own, "_parts")).otherwise(own)).drop("_parts")
    dealt = table.withColumn("_salt", F.explode(F.expr("sequence(0L, _parts - 1L)"))).drop("_parts")
    return salted.join(dealt.hint("merge"), [*keys, "_salt"], "left").drop("_salt")  # else planned by the size of its files


def templates(pages: DataFrame) -> DataFrame:
    """``pages`` (page_id, host, path, good: 1, 0 or null) with ``template``."""
    segs = F.array_remove(F.split("path", "/"), "")
    df = pages.withColumn("_segs", segs).withColumn("template", F.lit(""))
    done, level, depth, held = [], 0, _deepest(df), 0
    while level < depth:
        df = df.withColumn("_seg", F.expr(f"CASE WHEN size(_segs) > {level} THEN _segs[{level}] END"))
        child = (df.where("_seg IS NOT NULL").groupBy("host", "template", "_seg")
                 .agg(F.count("*").alias("n"), F.count("good").alias("k"), F.coalesce(F.sum("good"), F.lit(0)).alias("g")))
        parent = child.groupBy("host", "template").agg(F.sum("k").alias("pk"), F.sum("g").alias("pg"))
        kept = child.join(parent, ["host", "template"]).where(F.col("n") >= MIN_PAGES)
        # (g - k p)^2 / (k p (1 - p)) with p = pg / pk, without divisions
        # in doubles: a bigint square overflows from 110,000 labelled pages of a host on
        g, k, pk, pg = (F.col(c).cast("double") for c in ("g", "k", "pk", "pg"))
        gap = g * pk - k * pg
        same = gap * gap <= SAME * k * pg * (pk - pg)
        kept = kept.select("host", "template", "_seg", F.when(same, F.lit("~")).otherwise(F.col("_seg")).alias("_token"))
        kept = staged(df.sparkSession, kept, "url-branches")  # at most a MIN_PAGES-th of the pages; cuts the lineage of the levels above
        more = _held(kept)
        df = _looked_up(df, kept, ["host", "template", "_seg"], more)
        step = F.concat(F.lit("/"), F.coalesce("_token", F.lit("*")))
        df = df.withColumn("template", F.when(F.col("_seg").isNull(), F.col("template")).otherwise(F.concat("template", step))).drop("_token", "_seg")
        level, held = level + 1, held + more
        if held > MAX_HELD or level % STEP == 0 and level < depth:  # cuts the lineage of the pages; finished ones are not carried on
            df, held = staged(df.sparkSession, df.drop("_segs"), "url-levels").withColumn("_segs", segs), 0
            done.append(df.where(F.size("_segs") <= level))
            df = df.where(F.size("_segs") > level)
            depth = _deepest(df)
    rest = F.repeat(F.lit("/*"), F.greatest(F.size("_segs") - F.lit(level), F.lit(0)))  # only rare values are left there
    out = df.withColumn("template", F.concat("template", rest))
    for part in done:  # what was finished when its pages were written
        out = out.unionByName(part)
    return out.drop("_segs")


def judged(pages: DataFrame, rules=RULES) -> DataFrame:
    """page_id, host, path, rule, verdict, template, purity of pages (page_id, url, good)."""
    host, path = split_url(F.col("url"))
    df = pages.select("page_id", host.alias("host"), path.alias("path"), F.col("good").cast("long").alias("good"))
    total, good = df.agg(F.count("good"), F.coalesce(F.sum("good"), F.lit(0))).first()
    base = (good + 1) / (total + 2) if total else 1.0
    df = templates(df)
    stats = df.groupBy("host", "template").agg(F.count("good").alias("k"), F.coalesce(F.sum("good"), F.lit(0)).alias("g"))
    stats = stats.select("host", "template", ((F.col("g") + F.lit(PRIOR * base)) / (F.col("k") + F.lit(float(PRIOR)))).alias("purity"))
    stats = staged(df.sparkSession, stats, "url-purity")
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    own = F.when(F.col("purity") < REJECT, F.lit("block")).otherwise("allow")
    return _looked_up(df, stats, ["host", "template"], _held(stats)).select(
        "page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, own).alias("verdict"), "template", "purity")


def labelled(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """page_id, url, good: the label of the document that the path's first whole number names."""
    number = F.regexp_extract(split_url(F.col("url"))[1], r"/([0-9]{1,18})(?:[/.]|$)", 1)
    named = pages.select("page_id", "url", F.when(number != "", number).cast("long").alias("_doc"))
    known = labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("_doc")).agg(F.max("quality").alias("good"))
    known = staged(pages.sparkSession, known, "url-labels")
    held = _held(known)
    out = _looked_up(named, known, ["_doc"], held).select("page_id", "url", "good")
    return out if held <= MAX_HELD else staged(pages.sparkSession, out, "url-labelled")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    return judged(labelled(pages, spark.read.parquet(f"{sf_dir}/labels.parquet"))).select("page_id", "host", "path", "rule", "verdict")


_FIT = " ".join(f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN '{{}}'".replace("{}", h + p)
                for _, h, p in sorted(RULES, key=lambda r: -len(r[1] + r[2])))

SQL = rf"""
WITH RECURSIVE u AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
h AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{UPPER}', '{LOWER}') AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
lab AS (SELECT doc_id, max(quality) AS good FROM labels GROUP BY 1),
t0 AS (SELECT page_id, host, path, good, list_filter(string_split(path, '/'), lambda x: x <> '') AS segs
   FROM h LEFT JOIN lab ON try_cast(nullif(regexp_extract(path, '/([0-9]{{1,18}})(?:[/.]|$)', 1), '') AS BIGINT) = lab.doc_id),
t AS (SELECT *, '' AS tpl, 0 AS level FROM t0
   UNION ALL SELECT page_id, host, path, good, segs,
     tpl || '/' || CASE WHEN n < {MIN_PAGES} THEN '*' WHEN (g * pk - k * pg) * (g * pk - k * pg) <= {SAME} * k * pg * (pk - pg) THEN '~' ELSE segs[level + 1] END, level + 1
   FROM (SELECT *, count(*) OVER s AS n, count(good) OVER s AS k, coalesce(sum(good) OVER s, 0) AS g, count(good) OVER p AS pk, coalesce(sum(good) OVER p, 0) AS pg
         FROM t WHERE len(segs) > level WINDOW s AS (PARTITION BY host, tpl, segs[level + 1]), p AS (PARTITION BY host, tpl))),
z AS (SELECT * FROM t WHERE level = len(segs)),
b AS (SELECT CASE WHEN count(good) > 0 THEN CAST(coalesce(sum(good), 0) + 1 AS DOUBLE) / (count(good) + 2) ELSE 1.0 END AS base FROM t0),
s AS (SELECT host, tpl, (coalesce(sum(good), 0) + {PRIOR} * any_value(base)) / (count(good) + {float(PRIOR)}) AS purity FROM z, b GROUP BY host, tpl),
r AS (SELECT page_id, host, path, CASE {_FIT} END AS rule, purity FROM z JOIN s USING (host, tpl))
SELECT page_id, host, path, rule, CASE WHEN rule IN ({', '.join(f"'{h + p}'" for a, h, p in RULES if a == 'allow')}) THEN 'allow'
   WHEN rule IS NOT NULL THEN 'block' WHEN purity < {REJECT} THEN 'block' ELSE 'allow' END AS verdict FROM r
"""

QUERIES = {"op7_url_templates": query}
ORACLE = {"op7_url_templates": SQL}
