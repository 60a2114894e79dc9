"""HTML extraction by equivalence-class template deduction.

Pages of one host are taken in blocks of about ``BLOCK`` pages (a host with more
pages has more blocks, so no group grows with the data).  In each block:

1. Pages become tokens: tags and text blocks, each told apart by its path of open
   elements.
2. Tokens with the same occurrence vector (how often in each page) form an
   equivalence class.  A class of tokens that occur once in most pages, in the same
   order everywhere, is valid and is the template's spine; classes of repeated
   tokens are valid if they keep their order and nest inside one gap of the spine.
3. Text of the spine or of a valid repeated class (the same at the same path in
   ``SUPPORT`` of the different pages with content, if these are ``MIN_PAGES`` or more) belongs to
   the template, inside an article too, where headings are spared.  What lies in the gaps are
   slots.  Pages that would lose more than half of their article that way are copies of
   each other rather than filled templates, and keep it.
4. Slots are extracted if they lie inside the article (anywhere if no page names
   one; the whole ``main`` where it holds the article), outside menus, headers, footers,
   sidebars, notices, adverts, forms, scripts, styles and comments.  A class, id or role marks
   such a region if the whole name says so, but never on main or a heading, on an article only if it
   says comment or teaser, and never on an element that holds more than half of the page's text.

A page that does not follow its block's template is read by the same rules from its own
tokens.  Text: references decoded, white space inside a block to one space,
trimmed, blocks joined by a line feed.

Defined cases: null and empty pages give an empty text; broken or unclosed markup is
read as far as it goes; a null url has an empty host; repeated rows are pages
of their own; other columns are not read.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter, defaultdict

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.decontaminate import bounded
from tidemark.llm.staging import staged
from tidemark.llm.url_templates import split_url

BLOCK = 48
MIN_PAGES = 4
#: Share of a block's pages in which a spine token occurs.
SUPPORT = 0.6

#: Elements without content, with raw content, that break lines, and that never hold main text.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title iframe svg math object select option".split())
BREAKS = frozenset(("address article aside blockquote body caption center dd details div dl dt fieldset figcaption figure footer form "
                    "h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul").split())
OUTSIDE = frozenset("head nav header footer aside form button dialog menu input label fieldset".split()) | RAW
MAIN = frozenset(("article", "main"))
#: Words in class, id or role that mark the same regions.
OUTSIDE_WORDS = frozenset((
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies copyright disqus "
    "dropdown footer form header masthead menu modal nav navbar navigation newsletter notice notices notification pager pagination popup promo promoted "
    "related replies search share sharing sidebar signup skip social sponsor sponsored subscribe teaser teasers toolbar widget complementary contentinfo").split())
#: Words that a whole name may hold beside these (``site-footer``; ``has-sidebar`` and ``article-header`` say something else).
BESIDE_WORDS = frozenset(("site global top bottom left right bar box button buttons link links list wrapper container area block body inner item items "
                          "panel section slot this author reader user post posts story stories page pages").split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
UNMARKED = HEADINGS | frozenset("html body main".split())
#: The words that mark an article as none.
NO_ARTICLE = frozenset("comment comments replies teaser teasers".split())
#: Elements whose start closes an open one of the same kind.
SELF_CLOSING = {"p": ("p",), "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
SCOPES = frozenset("ul ol dl table article section div nav aside footer header main form body".split())

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)", re.S)
_MARK = re.compile(r"""(?<![^\s"'/])(?:class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.I)
_SPACE = re.compile(r"\s+")


class Token:
    """One token of a page: its role (path and content) and, for text, the block it belongs to."""
    __slots__ = ("role", "path", "text", "block")

    def __init__(self, role, path, text, block):
        self.role, self.path, self.text, self.block = role, path, text, block


def _marks(attrs: str) -> str:
    """The class names, ids and roles, by spaces."""
    return " ".join(sorted({w for m in _MARK.findall(attrs) for w in m.strip("\"'").lower().split()}))


def tokens(page: str) -> list[Token]:
    """Tags and texts of a page in order, with the path of open elements at each."""
    out: list[Token] = []
    stack: list[str] = []  # names, with their marks after a colon
    block, at, end = 0, 0, len(page)

    def text(raw: str) -> None:
        if raw and not raw.isspace():
            out.append(Token(None, tuple(stack), raw, block))
        elif raw:
            out.append(Token(None, tuple(stack), " ", block))

    while at < end:
        m = _TOKEN.search(page, at)
        if m is None:
            text(page[at:])
            break
        text(page[at: m.start()])
        at = m.end()
        if m[2] is None:
            continue
        name = m[2].lower()
        if m[1]:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k].split(":")[0] == name:
                    del stack[k:]
                    out.append(Token(("/", name, tuple(stack)), tuple(stack), None, block))
                    break
            block += name in BREAKS
            continue
        if name in BREAKS:
            block += 1
            for k in range(len(stack) - 1, -1, -1):  # an open p ends at any block; li, td and the like at their own kind
                open_ = stack[k].split(":")[0]
                if open_ in SELF_CLOSING.get(name, ()) or open_ == "p":
                    del stack[k:]
                    break
                if open_ in SCOPES:
                    break
        label = f"{name}:{_marks(m[3])}" if m[3] else name
        out.append(Token(("<", label, tuple(stack)), tuple(stack), None, block))
        if name == "br":
            out.append(Token(None, tuple(stack), " ", block))
        if name in RAW:
            close = re.compile(rf"</{re.escape(name)}\b[^>]*>", re.I).search(page, at)
            at = close.end() if close else (end if name in ("script", "style", "title", "textarea") else at)
        elif name not in VOID and not m[3].rstrip().endswith("/"):
            stack.append(label)
    return out


def _marked(part: str) -> bool:
    """Whether a class name, id or role of a path part marks a region without main text."""
    name, _, marks = part.partition(":")
    if not marks or name in UNMARKED:
        return False
    for mark in marks.split():
        words = set(re.split(r"[^a-z0-9]+", mark)) - {""}
        if words & (NO_ARTICLE if name == "article" else OUTSIDE_WORDS) and words <= OUTSIDE_WORDS | BESIDE_WORDS:
            return True
    return False


def _outside_paths(page: list[Token]) -> set[tuple[str, ...]]:
    """The paths of a page's texts that lie outside its main text."""
    size: Counter = Counter()
    for t in page:
        if t.text is not None and (n := len(t.text.strip())):
            size[t.path] += n
    marked = {part: _marked(part) for path in size for part in path}
    held: Counter = Counter()  # text below each marked element
    for path, n in size.items():
        for i, part in enumerate(path):
            if marked[part]:
                held[path[: i + 1]] += n
    most = sum(size.values()) / 2
    return {path for path in size if any(part.split(":")[0] in OUTSIDE or (marked[part] and held[path[: i + 1]] <= most) for i, part in enumerate(path))}


class Template:
    """Equivalence classes of a block of pages."""

    def __init__(self, pages: list[list[Token]]) -> None:
        different = {tuple((t.role, t.text) for t in page): page for page in pages if any(t.text and not t.text.isspace() for t in page)}
        pages = list(different.values())
        n = len(pages)
        counts: dict = defaultdict(Counter)
        for p, page in enumerate(pages):
            for t in page:
                counts[self.role(t)][p] += 1
        classes: dict = defaultdict(list)
        for role, where in counts.items():
            classes[tuple(where[p] for p in range(n))].append(role)
        self.spine = self._ordered(pages, {r for vector, roles in classes.items() if max(vector) == 1 and sum(vector) >= SUPPORT * n for r in roles})
        #: Repeated classes that stay inside one gap of the spine.
        self.repeated = self._nested(pages, {r: k for k, (vector, roles) in enumerate(classes.items()) if max(vector) > 1 and sum(v > 0 for v in vector) >= SUPPORT * n for r in roles})
        self.fixed_text = {r for r in self.spine | self.repeated if r[0] == "t" and r[1]} if n >= MIN_PAGES else set()
        self.fixed_text = {r for r in self.fixed_text if not self._in_article(r[2]) or HEADINGS.isdisjoint(x.split(":")[0] for x in r[2])}
        self.main = self._main(pages)

    @staticmethod
    def _in_article(path: tuple[str, ...]) -> bool:
        return not MAIN.isdisjoint(x.split(":")[0] for x in path)

    @staticmethod
    def role(t: Token):
        return t.role or ("t", t.text.strip(), t.path)

    def _ordered(self, pages: list[list[Token]], roles: set) -> set:
        """The roles that keep one order in every page (those that break it are left out)."""
        place: dict = defaultdict(list)
        for page in pages:
            k = 0
            for t in page:
                if (r := self.role(t)) in roles:
                    place[r].append(k)
                    k += 1
        rank = {r: i for i, r in enumerate(sorted(place, key=lambda r: sum(place[r]) / len(place[r])))}
        broken: set = set()
        for page in pages:
            last = -1
            for t in page:
                r = self.role(t)
                if r in rank and r not in broken:
                    if rank[r] < last:
                        broken.add(r)
                    else:
                        last = rank[r]
        return set(rank) - broken

    def _nested(self, pages: list[list[Token]], roles: dict) -> set:
        gaps: dict = defaultdict(set)
        for page in pages:
            gap = None
            for t in page:
                r = self.role(t)
                if r in self.spine:
                    gap = r
                elif r in roles:
                    gaps[r].add(gap)
        return {r for r in roles if len(gaps[r]) == 1}

    def slot(self, t: Token) -> bool:
        return t.text is not None and self.role(t) not in self.fixed_text

    def _main(self, pages: list[list[Token]]) -> str | None:
        """Name of the element that holds the article, if any page names one: ``main`` where articles lie in it."""
        named: Counter = Counter()
        for page in pages:
            outside = _outside_paths(page)
            for t in page:
                if t.text is not None and t.path not in outside:
                    for name in _containers(t.path):
                        named[name] += len(t.text)
        return _container(named)


def _containers(path: tuple[str, ...]) -> set[str]:
    """``article`` and ``main`` if the path lies in them, and ``main article`` if it lies in an article inside main."""
    names = [part.split(":")[0] for part in path]
    found = MAIN.intersection(names)
    return found | {"main article"} if len(found) == 2 and names.index("main") < names.index("article") else found


def _container(named: Counter) -> str | None:
    if not named:
        return None
    if not named["article"]:
        return "main"
    return "main" if 2 * named["main article"] > named["article"] else "article"


def _inside(path: tuple[str, ...], main: str | None) -> bool:
    return main is None or any(part == main or part.split(":")[0] == main for part in path)


def article(page: list[Token], template: Template) -> str:
    """The slots of the article as text."""
    named = any(_inside(t.path, template.main) for t in page if t.text is not None)
    main = template.main if named else next((m for m in ("article", "main") if any(_inside(t.path, m) for t in page)), None)
    outside = _outside_paths(page)
    inside = [t for t in page if t.text is not None and _inside(t.path, main) and t.path not in outside]
    slots = [t for t in inside if template.slot(t)]
    size = lambda ts: sum(len(t.text.strip()) for t in ts)
    if main is not None and 2 * size(slots) < size(inside):
        slots = inside
    blocks: dict[int, list[str]] = defaultdict(list)
    for t in slots:
        blocks[t.block].append(t.text)
    lines = (_SPACE.sub(" ", entities.unescape("".join(parts))).strip() for _, parts in sorted(blocks.items()))
    return "\n".join(x for x in lines if x)


def _extract(table: pa.Table) -> pa.Table:
    pages = [tokens(x or "") for x in table.column("html").to_pylist()]
    template = Template(pages)
    texts = [article(p, template) for p in pages]
    return pa.table([table.column("page_id"), table.column("url"), pa.array(texts, pa.string())], names=["page_id", "url", "text"])


def extract(pages: DataFrame, block: int = BLOCK) -> DataFrame:
    """page_id, url, text of every page."""
    src = pages.select("page_id", "url", F.col("html"), split_url(F.col("url"))[0].alias("_host"))
    sizes = src.groupBy("_host").agg(F.count("*").alias("_n")).where(F.col("_n") > block)
    sizes = bounded(staged(pages.sparkSession, sizes, "large-hosts"))
    src = src.join(sizes, "_host", "left")
    parts = F.coalesce(F.ceil(F.col("_n") / block), F.lit(1)).cast("int")
    src = src.withColumn("_block", F.pmod(F.xxhash64("page_id", "url"), parts))
    kinds = dict(src.dtypes)
    return src.select("_host", "_block", "page_id", "url", "html").groupBy("_host", "_block").applyInArrow(
        _extract, f"page_id {kinds['page_id']}, url {kinds['url']}, text string")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    return out.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


QUERIES = {"op2_page_template": query}
ORACLE: dict[str, str] = {}
