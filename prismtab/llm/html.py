"""Main text of web pages, with site templates removed.

Every element's subtree (tags, classes, text) is hashed.  Spark counts, for each host, in how many different
pages a subtree occurs; a subtree that recurs across many pages of its host is
part of the site's template and is deleted from them all.  Pages with the same
content count once, so copies of an article do not make it a template, and
single text blocks inside an article are left alone, as a sentence may recur.
All text that is left is the main text, whether in one article, several or none.

What HTML itself marks as something else than content goes as well: menus,
headers, footers, asides, forms, scripts and elements whose class, id or role
says advert, notice, sidebar, comments and the like, unless they hold the page's own text.
"""

from __future__ import annotations

import html as references
import re
from itertools import accumulate

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from prismtab.llm.arrays import batches, small_batches
from prismtab.llm.language import host_of
from prismtab.session import cut_lineage

#: a subtree is template from so many different pages of a host on, and from such a share of them
LEAST_PAGES, LEAST_SHARE = 5, 0.05
#: template subtrees up to this count are broadcast, more are joined by host
BROADCAST_ROWS = 100_000

#: name and value of an attribute; an unquoted value ends at white space or the tag's end and may hold quotes
_VALUE = r"(?:\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s\"'>][^\s>]*+)))?+"
_ATTRIBUTE = re.compile(r"([^\s\"'>/=][^\s>/=]*+)" + _VALUE)
#: attributes one by one up to the tag's end; a quote that is never closed is a character like others
_ATTRIBUTES = r"(?:[\s/]++|[^\s\"'>/=][^\s>/=]*+" + _VALUE.replace("(\"", "(?:\"").replace("([", "(?:[") + r"|[\"'=])*+"
_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*+)(" + _ATTRIBUTES + r")>|<[!?][^>]*(?:>|\Z)|</?[a-zA-Z][^<]*\Z", re.S)
_RAW = {name: re.compile(rf"</{name}\s*>|\Z", re.I) for name in ("script", "style", "textarea", "title", "noscript", "iframe")}
_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
_INLINE = frozenset("a abbr b bdi bdo big cite code data del dfn em font i ins kbd label mark q ruby rt rp s samp small span strike strong sub sup time tt u var wbr img".split())
_TEXT_BLOCK = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre li dt dd td th tr figcaption".split()) | _INLINE
_DROPPED = frozenset("head nav footer aside form button select option dialog menu template svg object audio video canvas map".split())
_ENDS_P = frozenset("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split())
_SAME = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_HOLDS = frozenset("ul ol dl table select article section div body main".split())
_MARKED = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices alert popup modal overlay "
    "newsletter subscribe signup login nav navbar navigation menu menus breadcrumb breadcrumbs sidebar footer comment comments disqus respond replies share sharing "
    "social related recommended recommendations pagination pager toolbar widget widgets masthead complementary contentinfo search".split())
#: marks of blocks whose articles are not the page's own
_FOREIGN = frozenset("ad ads advert adverts advertisement advertising sponsor sponsored promo promotion comment comments disqus respond replies related recommended recommendations".split())
_HEADERS = frozenset("header site-header page-header masthead topbar top-bar".split())
BREAK = None
#: how an element is marked as no content: by any mark, by the first part of a word of ``_FOREIGN``, by a whole such word
MARKED, FOREIGN, SURELY = 1, 2, 3


def _marks(attributes: str) -> tuple[str, bool, int, bool]:
    """(what of the attributes counts for the hash, whether they hide the element, how they mark it as no content, whether they mark a main element).

    A word marks as a whole or by its first part (cookie-notice), not by a later one (no-sidebar).
    """
    if not attributes or attributes.isspace():
        return "", False, 0, False
    key, drop, mark, main = [], False, 0, False
    for m in _ATTRIBUTE.finditer(attributes):
        name, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
        if name == "hidden":
            drop = True
        elif name == "style":
            rules = dict([x.strip() for x in rule.split(":", 1)] for rule in value.split(";") if ":" in rule)
            drop |= rules.get("display", "").split("!")[0].strip() == "none"
        elif name in ("class", "id", "role"):
            words = value.split()
            for w in words:
                first = re.split(r"[-_:]+", w, maxsplit=1)[0]
                if w in _HEADERS or first in _MARKED:
                    mark = max(mark, SURELY if w in _FOREIGN else FOREIGN if first in _FOREIGN else MARKED)
            main |= name == "role" and value == "main"
            key.append(f"{name}={value}")
    return " ".join(key), drop, mark, main


class Element:
    __slots__ = ("tag", "key", "start", "parts", "drop", "mark", "article", "heading", "articles", "mains")

    def __init__(self, tag: str, key: str, start: int, drop: bool, mark: int, article: bool, main: bool):
        self.tag, self.key, self.start, self.drop, self.mark, self.article = tag, key, start, drop, mark, article
        self.parts: list[bytes] = []
        self.heading = False
        self.articles, self.mains = int(article), int(main)  # how many it is and holds


def _joined(pieces: list[str | None]) -> str:
    """The blocks of some pieces, white space inside a block as one space."""
    blocks, block = [], []
    for p in [*pieces, BREAK]:
        if p is not BREAK:
            block.append(p)
        elif block:
            line = " ".join("".join(block).split())
            if line:
                blocks.append(line)
            block = []
    return "\n\n".join(blocks)


def parse(page: str, templates=frozenset()) -> tuple[str, list[tuple[int, bool]], str]:
    """(main text, [(hash of a subtree that may be template, whether it stood in the article)], what tells copies) of one page.

    Subtrees whose hash is in ``templates`` are deleted, marked blocks go then, and the main text is all that is left.
    A mark does not hold for html, body and what holds a main element; for what holds an article, unless
    the mark says that it is not the page's own; and for what holds more than half of the page's text, unless
    a whole word says so and there is an article or main element that is not inside it.  Copies
    are told by the text of all articles that are left, or by the main text if there is none.  Tags that are not
    closed end where HTML ends them; a tag cut off at the page's end is markup.
    """
    pieces: list[str | None] = []
    root = Element("", "", 0, False, 0, False, False)
    stack, found = [root], []
    articles: list[tuple[int, int]] = []  # ranges of pieces
    marked: list[tuple[int, int, Element]] = []
    inside = 0  # open articles or main elements

    def close() -> None:
        nonlocal inside
        e = stack.pop()
        digest = xxhash.xxh64(f"{e.tag}|{e.key}|".encode() + b"".join(e.parts)).digest()
        parent = stack[-1]
        parent.parts.append(digest)
        parent.heading |= e.heading or e.tag in ("h1", "h2", "h3", "h4", "h5", "h6")
        parent.articles += e.articles
        parent.mains += e.mains
        inside -= e.article
        if e.tag not in _INLINE:
            pieces.append(BREAK)
        gone = False
        # counted before any tag or word is judged: what recurs on a site is found by that alone
        if not e.article and e.tag not in ("body", "html", "head") and not (inside and e.tag in _TEXT_BLOCK):
            number = int.from_bytes(digest, "big", signed=True)
            if any(p and not p.isspace() for p in pieces[e.start :]):
                found.append((number, inside > 0))
            gone = number in templates
        if gone or e.drop or e.tag == "header" and not (inside and e.heading):
            del pieces[e.start :]
            pieces.append(BREAK)
            for ranges in (articles, marked):
                while ranges and ranges[-1][0] >= e.start:
                    ranges.pop()
            return
        if e.article and not inside:
            articles.append((e.start, len(pieces)))
        if e.mark and not e.mains and (not e.articles or e.mark >= FOREIGN):
            marked.append((e.start, len(pieces), e))

    def text(part: str) -> None:
        part = references.unescape(part)
        pieces.append(part)
        words = " ".join(part.split())
        if words:
            stack[-1].parts.append(words.encode("utf-8", "surrogatepass"))

    at, end = 0, len(page)
    while at < end:
        m = _TOKEN.search(page, at)
        if m is None:
            text(page[at:])
            break
        if m.start() > at:
            text(page[at : m.start()])
        at = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if m[1]:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].tag == tag:
                    while len(stack) > depth:
                        close()
                    break
            else:
                if tag not in _INLINE:
                    pieces.append(BREAK)
            continue
        if tag in _VOID:
            pieces.append(" " if tag in ("br", "wbr", "img") else BREAK)
            if tag == "br":
                pieces[-1] = "\n"
            continue
        if tag in _RAW:
            at = _RAW[tag].search(page, at).end()
            continue
        enders = _SAME.get(tag)
        if tag in _ENDS_P or enders:
            for depth in range(len(stack) - 1, 0, -1):
                own = stack[depth].tag
                if own == "p" and tag in _ENDS_P or enders and own in enders:
                    while len(stack) > depth:
                        close()
                    break
                if own in _HOLDS:
                    break
        if m[3].rstrip().endswith("/") and tag in ("svg", "path"):
            continue
        key, drop, mark, main = _marks(m[3])
        main |= tag == "main"
        article = tag == "article" or main
        if article and mark >= FOREIGN and not main:
            article = False
        elif article:
            drop = False
        if article or tag in ("html", "body"):
            mark = 0
        if tag not in _INLINE:
            pieces.append(BREAK)
        stack.append(Element(tag, key, len(pieces), drop or tag in _DROPPED, mark, article, main))
        inside += article
    while len(stack) > 1:
        close()
    if marked:
        upto = [0, *accumulate(len(p.strip()) if p else 0 for p in pieces)]
        for a, b, e in marked:
            most = 2 * (upto[b] - upto[a]) > upto[-1]
            if not most or e.mark == SURELY and root.articles > e.articles:
                pieces[a:b] = [BREAK] * (b - a)
    main = _joined(pieces)
    own = _joined([p for a, b in articles for p in [*pieces[a:b], BREAK]]) if articles else main
    return main, found, own


def template_subtrees(rows: DataFrame, least_pages: int = LEAST_PAGES, least_share: float = LEAST_SHARE) -> DataFrame:
    """(host, subtrees): for each host the hashes of the subtrees that recur across many of its pages.

    ``rows`` has host and html.  A host's list is bounded: each entry takes ``least_share`` of the host's pages.
    """

    def run(frames):
        for batch in batches(frames):
            hosts, contents, trees = [], [], []
            for host, page in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                _, found, own = parse(page or "")
                content = xxhash.xxh64_intdigest(own.encode("utf-8", "surrogatepass")) - (1 << 63)
                for tree in {0, *(t for t, _ in found)}:  # 0 stands for the page itself
                    hosts.append(host)
                    contents.append(content)
                    trees.append(tree)
            yield pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), pa.array(trees, pa.int64()), pa.array(contents, pa.int64())], ["host", "tree", "content"])

    seen = rows.select("host", "html").mapInArrow(run, "host string, tree long, content long").distinct()
    counted = seen.groupBy("host", "tree").count()
    counted = cut_lineage(counted.where((F.col("tree") == 0) | (F.col("count") >= least_pages)))
    pages = counted.where("tree = 0").select("host", F.col("count").alias("pages"))
    many = counted.where("tree <> 0").join(pages, "host").where(F.col("count") >= F.lit(least_share) * F.col("pages"))
    return many.groupBy("host").agg(F.sort_array(F.collect_set("tree")).alias("subtrees"), F.count("*").alias("n"))


def main_text(df: DataFrame, html: str = "html", url: str = "url", text: str = "text",
              least_pages: int = LEAST_PAGES, least_share: float = LEAST_SHARE) -> DataFrame:
    """All rows and columns of ``df`` with ``text``, the page's main text.

    Character references are decoded, white space inside a block becomes one
    space, blocks are trimmed and joined by an empty line, in page order.  All text
    that is left after the deletions is taken, in articles (or main elements) and beside them.  A
    null or empty page has an empty text.  Pages without a URL share the empty
    host.  An input column named as ``text`` is replaced.
    """
    df = small_batches(df).drop(text)
    own = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    rows = df.select(own.alias("row"), F.col(html).alias("html"), host_of(F.col(url)).alias("host"))
    templates = cut_lineage(template_subtrees(rows, least_pages, least_share))
    small = (templates.agg(F.sum("n")).first()[0] or 0) <= BROADCAST_ROWS
    templates = templates.select("host", "subtrees")
    joined = rows.join(F.broadcast(templates) if small else templates, "host", "left").select("row", "html", "subtrees")
    schema = T.StructType([T.StructField("row", rows.schema["row"].dataType), T.StructField(text, T.StringType())])

    def run(frames):
        for batch in batches(frames):
            texts = [parse(page or "", frozenset(trees or ()))[0] for page, trees in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([t.encode("utf-8", "replace").decode() for t in texts], pa.string())], ["row", text])

    return joined.mapInArrow(run, schema).select("row.*", text)
