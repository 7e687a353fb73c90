"""Operator 5: main text of web pages by tag-path ratios.

Every page is cut into text blocks, each with the path of block-level tags from
the root (a tag carries its first class, so ``body/div.ad`` is a path of its
own). Over all pages of a host, which share their templates, text length and punctuation
are summed per path. The two ratios of a path, characters and punctuation marks per block, are
smoothed with those of its sibling paths, so that a short headline inside an article keeps the
article's company, and fused into one score. A path is high on a page if its score reaches
``THRESHOLD`` times the host's mean, with the host's sums or with the page's own: an article is
found even if the same path holds short items on the host's other pages. Hosts do not touch each other.
Low paths, and paths inside page furniture (menus, adverts, reader comments and the like), are
dropped; the blocks of the remaining paths make up a page's text.

A list, a table or a heading of an article has short blocks, and its path need not
be a sibling of the paragraphs'. So low paths inside a content container stay too,
unless most of their text is links. The high paths speak for
each element around them, up to the nearest ``article``, else ``main``, else to
below ``body``; a container is an element for most of whose text on the page they speak.

Furniture is told by tags, roles, whole class names and ids, and by parts of such names
between hyphens (``post-comments``, ``sidebar-left``). A part may as well name what a wrapper has
inside or beside, so names with words such as ``has`` or ``with`` do not count, nor
does an element by a part of its name if it holds the page's ``h1`` or ``main``. A ``header`` inside an
``article`` is the article's own.

The path statistics are aggregated by Spark with partial sums. Up to ``MAX_SENT_PATHS`` high
paths of all hosts are sent to the tasks, which then cut each page a second time and keep the
content blocks, with no shuffle of text. Beyond that, blocks are joined to the
high paths and gathered again per page.

Defined cases: null or empty HTML, and a page without content, give the empty
string; a document of text alone is one block of path ''; unknown and unclosed
tags and unfinished constructs are tolerated; a URL without a host is of the host ''; repeated rows
give equal rows; an empty table gives an empty result; only page_id, url and html are read.
"""

from __future__ import annotations

import html as _html
import math
import re
from collections.abc import Container, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recoflow.llm.common import materialize
from recoflow.llm.url_graph import url_parts

MAX_SENT_PATHS = 50_000
THRESHOLD = 0.4
PUNCTUATION = r"[.,;:!?]"

# HTML tag names by role.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = ("script", "style", "textarea", "title", "noscript", "iframe", "xmp", "template", "svg")
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby "
                   "s samp small span strike strong sub sup time tt u var wbr".split())
FURNITURE_TAGS = frozenset("head nav header footer aside form button select menu dialog object canvas audio video "
                           "fieldset input".split()) | frozenset(RAW)
_WORDS = frozenset("ad ads advert adverts advertisement advertising sponsor sponsored promo banner nav navbar "
                            "navigation menu breadcrumb breadcrumbs header masthead footer sidebar aside widget related "
                            "comment comments reply replies discussion cookie cookies consent notice alert popup modal "
                            "share social newsletter subscribe login".split())
#: Whole names: a word, a word with the place of its element, or with the kind of it.
FURNITURE_WORDS = _WORDS | {f"{a}-{w}" for w in _WORDS for a in "site main page top bottom left right global".split()} | {
    f"{w}-{b}" for w in _WORDS for b in "list section area box block container wrapper bar item items link links slot unit".split()}
#: Words that tell furniture also as a part of a name, and parts that say that an element only has or lacks such a thing.
FURNITURE_PARTS = frozenset("ad ads advert adverts advertisement advertising sponsor sponsored promo banner nav navbar navigation "
                            "menu breadcrumb breadcrumbs masthead footer sidebar aside related comment comments reply replies "
                            "discussion cookie cookies consent notice newsletter subscribe".split())
WRAPPER_PARTS = frozenset("has have with without no not is hide show layout grid".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert".split())

_TOKEN = re.compile(r"""<!--(?P<note>.*?)(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(?P<end>/)?(?P<tag>[a-zA-Z][^\s/>]*)"""
                    r"""(?P<attrs>(?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<(?P<end2>/)?(?P<tag2>[a-zA-Z][^\s/>]*)[^>]*(?:>|\Z)""", re.S)
_MARKS = re.compile(r"""\b(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
_RAW_END = {t: re.compile(rf"</{t}[\s/>]", re.I) for t in RAW}
_PUNCT = re.compile(PUNCTUATION)


def _step(tag: str, attrs: str) -> tuple[str, bool, bool]:
    """A tag's step in a path (its name and first class), whether it is page furniture, and whether it is by a
    part of a name only."""
    if not attrs or "=" not in attrs:
        return tag, tag in FURNITURE_TAGS, False
    marks = {k.lower(): v.strip("\"'").lower().split() for k, v in _MARKS.findall(attrs)}
    names = [n.replace("_", "-") for k in ("class", "id") for n in marks.get(k, ())]
    furniture = tag in FURNITURE_TAGS or not FURNITURE_WORDS.isdisjoint(names) or not ROLES.isdisjoint(marks.get("role", ()))
    # A step holds no slash, so that paths can be cut at slashes.
    step = f"{tag}.{marks['class'][0]}".replace("/", "_") if marks.get("class") else tag
    parts = [n.split("-") for n in names if "-" in n]
    weak = any(not FURNITURE_PARTS.isdisjoint(p) and WRAPPER_PARTS.isdisjoint(p) for p in parts)
    top = tag in ("html", "body")
    return step, furniture and not top, weak and not top


def blocks(page: str | None) -> list[tuple[str, str, int]]:
    """(path, text, characters in links) of each text block of a page outside page furniture, in page order."""
    wrappers: set[int] = set()
    return [block[:3] for block in list(_cut(page, wrappers)) if wrappers.issuperset(block[3])]


def _cut(page: str | None, wrappers: set[int]) -> Iterator[tuple[str, str, int, list[int]]]:
    """Blocks, each with the numbers of the elements around it that are furniture by a part of their names;
    ``wrappers`` takes up those that turn out to hold the page's ``h1`` or ``main``."""
    stack: list[tuple[str, str, bool, int]] = []  # (tag, step, furniture, number if by a part of a name) of open block-level tags
    count = 0
    text: list[str] = []
    linked, links = False, 0
    page, at = page or "", 0

    def flush() -> tuple[str, str, int, list[int]] | None:
        nonlocal links
        said, n = " ".join("".join(text).split()), links
        text.clear()
        links = 0
        if not said or any(f for _, _, f, _ in stack):
            return None
        return "/".join(s for _, s, _, _ in stack), said, min(n, len(said)), [w for _, _, _, w in stack if w]

    while at < len(page):
        m = _TOKEN.search(page, at)
        start = m.start() if m else len(page)
        if start > at:
            text.append(_html.unescape(page[at:start]))
            links += len(text[-1].strip()) if linked else 0
        if not m:
            break
        at = m.end()
        tag = (m["tag"] or m["tag2"] or "").lower()
        if not tag:
            continue
        end = m["end"] or m["end2"]
        if tag in INLINE:
            if tag == "a":
                linked = not end and "href" in (m["attrs"] or "").lower()
            if tag == "br":
                text.append(" ")
            continue
        if done := flush():
            yield done
        if end:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == tag:
                    del stack[i:]
                    break
            continue
        if tag in _RAW_END and not (m["attrs"] or "").endswith("/"):
            close = _RAW_END[tag].search(page, at)
            at = close.start() if close else len(page)
            stack.append((tag, tag, True, 0))
            continue
        if tag in VOID:
            continue
        # A new p, li, cell or option ends an open one of its kind, and a block ends an open p.
        shut = {"li": ("li",), "td": ("td", "th"), "th": ("td", "th"), "tr": ("tr",), "dt": ("dt", "dd"), "dd": ("dt", "dd"),
                "option": ("option",)}.get(tag, ())
        stop = ("ul", "ol", "table", "dl", "select")
        for i in range(len(stack) - 1, -1, -1):
            if stack[i][0] == "p" or stack[i][0] in shut:
                del stack[i:]
                break
            if stack[i][0] in stop:
                break
        step, furniture, weak = _step(tag, m["attrs"] or "")
        if tag == "header" and any(t == "article" for t, _, _, _ in stack):
            furniture = False
        if tag in ("h1", "main"):
            wrappers.update(w for _, _, _, w in stack if w)
        count += weak
        stack.append((tag, step, furniture, count if weak else 0))
    if done := flush():
        yield done


def _sums(parts: list[tuple[str, str, int]], sums: dict) -> None:
    """Adds blocks to path -> [blocks, characters, punctuation marks, characters in links]."""
    for path, text, links in parts:
        s = sums.setdefault(path, [0, 0, 0, 0])
        s[0] += 1
        s[1] += len(text)
        s[2] += len(_PUNCT.findall(text))
        s[3] += links


def _path_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Per batch of pages, the sums of every path met on each host."""
    for batch in batches:
        hosts: dict[str, dict] = {}
        for host, page in zip(batch["host"], batch["html"]):
            _sums(blocks(page), hosts.setdefault(host, {}))
        yield pd.DataFrame([(h, p, *s) for h, sums in hosts.items() for p, s in sums.items()], columns=["host", "path", "n", "chars", "marks", "links"])


def path_ratios(pages: DataFrame) -> DataFrame:
    """(host, path, n, chars, marks, links, score) of every path outside page furniture."""
    sums = (pages.select("host", "html").mapInPandas(_path_rows, "host string, path string, n long, chars long, marks long, links long")
            .groupBy("host", "path").agg(*(F.sum(c).alias(c) for c in ("n", "chars", "marks", "links"))))
    sums = materialize(sums.withColumn("parent", F.regexp_replace("path", "/?[^/]*$", "")), "paths")
    near = sums.groupBy("host", "parent").agg((F.sum("chars") / F.sum("n")).alias("near_chars"), (F.sum("marks") / F.sum("n")).alias("near_marks"))
    both = sums.join(near, ["host", "parent"])
    chars = (F.col("chars") / F.col("n") + F.col("near_chars")) / 2
    marks = (F.col("marks") / F.col("n") + F.col("near_marks")) / 2
    return both.select("host", "path", "n", "chars", "marks", "links", (chars * F.log1p(1 + marks)).alias("score"))


def high_paths(pages: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(host, cut, path): the paths whose score reaches the host's cut, ``threshold`` times the mean score of its text by length."""
    scored = materialize(path_ratios(pages), "path-scores")
    cuts = scored.groupBy("host").agg((threshold * F.sum(F.col("score") * F.col("chars")) / F.sum("chars")).alias("cut"))
    return materialize(scored.join(cuts, "host").where("score >= cut").select("host", "cut", "path"), "high-paths")


def _steps_around(path: str) -> list[tuple[str, bool]]:
    """The elements around a path, outermost first and its own included: the path up to each, and whether the
    path, if it is high, speaks for it."""
    steps = path.split("/")
    tags = [s.partition(".")[0] for s in steps]
    top = next((len(tags) - 1 - tags[::-1].index(t) for t in ("article", "main") if t in tags), 0)
    return [("/".join(steps[:i + 1]), i >= top and tags[i] not in ("", "html", "body") and (i + 1 < len(steps) or tags[i] in ("article", "main")))
            for i in range(len(steps))]


def page_text(parts: list[tuple[str, str, int]], high: Container[str], cut: float) -> str:
    """The main text of a page from its blocks, its host's high paths and cut."""
    sums: dict[str, list[int]] = {}
    _sums(parts, sums)
    family: dict[str, list[int]] = {}
    for path, (n, chars, marks, _) in sums.items():
        near = family.setdefault(path.rpartition("/")[0], [0, 0, 0])
        for i, x in enumerate((n, chars, marks)):
            near[i] += x
    top = set()
    for path, (n, chars, marks, _) in sums.items():
        m, near_chars, near_marks = family[path.rpartition("/")[0]]
        if path in high or (chars / n + near_chars / m) / 2 * math.log1p(1 + (marks / n + near_marks / m) / 2) >= cut:
            top.add(path)
    held: dict[str, int] = {}  # twice what is spoken for, less all text, of each element
    around = {path: _steps_around(path) for path in sums}
    for path, (_, chars, _, _) in sums.items():
        for inner, spoken in around[path]:
            held[inner] = held.get(inner, 0) + (chars if path in top and spoken else -chars)
    kept = top | {path for path, (_, chars, _, links) in sums.items() if 2 * links <= chars and any(held[inner] >= 0 for inner, _ in around[path])}
    return "\n\n".join(text for path, text, _ in parts if path in kept)


def main_text(pages: DataFrame, threshold: float = THRESHOLD, max_sent: int = MAX_SENT_PATHS) -> DataFrame:
    """One row per page: page_id, url, text, n_chars."""
    host, _ = url_parts(F.col("url"))
    pages = pages.select("page_id", "url", "html", host.alias("host"))
    high = high_paths(pages, threshold)
    if high.count() <= max_sent:
        found: dict[str, tuple[float, set]] = {}
        for r in high.collect():
            found.setdefault(r.host, (r.cut, set()))[1].add(r.path)
        sent = pages.sparkSession.sparkContext.broadcast(found)

        def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                texts = []
                for host, page in zip(b.column("host").to_pylist(), b.column("html")):
                    least, known = sent.value.get(host, (0.0, ()))
                    texts.append(page_text(blocks(page.as_py()), known, least))
                yield pa.RecordBatch.from_arrays([b.column("page_id"), b.column("url"), pa.array(texts, pa.string())],
                                                 names=["page_id", "url", "text"])

        out = pages.mapInArrow(cut, pages.select("page_id", "url", F.lit("").alias("text")).schema)
    else:
        rows = "array<struct<at:int,path:string,text:string,links:int>>"

        @F.pandas_udf(rows)
        def split(h: pd.Series) -> pd.Series:
            return h.map(lambda x: [{"at": i, "path": p, "text": t, "links": n} for i, (p, t, n) in enumerate(blocks(x))])

        @F.pandas_udf("string")
        def text_of(blocks: pd.Series, cut: pd.Series) -> pd.Series:
            return pd.Series([page_text([(x["path"], x["text"], x["links"]) for x in b], {x["path"] for x in b if x["high"]}, c) for b, c in zip(blocks, cut)], dtype=object)

        cutup = materialize(pages.select(F.monotonically_increasing_id().alias("row"), "host", "page_id", "url", split("html").alias("b")), "blocks")
        known = high.select("host", "path", F.lit(True).alias("high"))
        each = cutup.select("row", "host", F.explode("b").alias("b")).select("row", "host", "b.*").join(known, ["host", "path"], "left")
        each = each.groupBy("row", "host").agg(F.array_sort(F.collect_list(F.struct("at", "path", "text", "links", "high"))).alias("b"))
        cuts = high.groupBy("host").agg(F.max("cut").alias("cut"))
        text = each.join(cuts, "host", "left").select("row", text_of("b", F.coalesce("cut", F.lit(0.0))).alias("text"))
        out = cutup.drop("b").join(text, "row", "left").select("page_id", "url", F.coalesce("text", F.lit("")).alias("text"))
    return out.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))
