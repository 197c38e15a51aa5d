"""Main text of web pages by removing each site's template.

Every block element outside a page's article is a subtree with a hash over its
tags, its class and id, and its text.  Spark counts per host on how many different pages
each hash occurs; subtrees that recur on many of them are the site's template and
are deleted.  Pages with equal content count once, so copies of a page do not turn it
into a template.  Inside an article only containers (boxes, lists, tables) are counted, over
different articles, and a larger share of the host's articles must have them: a
paragraph that many articles quote stays.  HTML's own marks then take what does not recur
(rotating adverts, a menu that differs from page to page, pages of small hosts):
elements and class names that mean menu, header, footer, sidebar, notice, advert, form
or comments.  A class or id counts as such a name if it is the word, or, on a container
that does not hold most of the page's text, begins or ends with it (``post-comments``) and
tells of no state (``no-sidebar``).  No name deletes ``html``, ``body``, a heading, or what
is or holds the named article (an article of reader comments is none).  If the page
names its article, that is what is left of it.

Blocks are joined by one newline, in page order; white space within a block is
one space; character references are decoded.  A null or empty page has the empty text;
pages without a url share one host.  Repeated rows get equal results, an empty table
an empty result; input columns with the names of result columns are replaced.
"""

from __future__ import annotations

import html as html_lib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import read_table, same, strings, text_slices, without, written

#: A subtree is template if it occurs on so many different pages of its host, and
#: on this share of them.
MANY_PAGES = 3
SHARE = 0.02
#: The share of the host's different articles for a container inside the article.
INSIDE_SHARE = 0.3

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*+)(?P<rest>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>?", re.S)
_ATTRIBUTE = re.compile(r"([^\s=\"'/]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")

# fixed values: elements of HTML by their role
_VOID = set("area base br col embed hr img input link meta param source track wbr".split())
_RAW = set("script style title textarea xmp iframe noembed noframes".split())
_BLOCK = set("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset "
             "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav "
             "ol p pre section summary table tbody tfoot thead tr ul".split())
_CONTAINER = set("center dir div dl figure hgroup ol section table ul".split())
_CELL = {"td", "th", "br"}
_HEADING = {"h1", "h2", "h3", "h4", "h5", "h6"}
_DROPPED = set("aside audio button canvas datalist dialog fieldset footer form head iframe input label menu "
               "nav noembed noframes noscript object option script select style svg template textarea "
               "title video xmp".split())
_ROLES = set("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation "
             "search tablist toolbar".split())
# an open element of the first kind ends when one of the second begins, unless one of the third is between
_ENDS = (("p", _BLOCK, {"button", "td", "th", "caption", "object"}),
         ("li", {"li"}, {"ul", "ol", "menu"}),
         ("dt", {"dt", "dd"}, {"dl"}), ("dd", {"dt", "dd"}, {"dl"}),
         ("option", {"option", "optgroup"}, {"select"}),
         ("td", {"td", "th", "tr", "tbody", "tfoot"}, {"table"}),
         ("th", {"td", "th", "tr", "tbody", "tfoot"}, {"table"}),
         ("tr", {"tr", "tbody", "tfoot"}, {"table"}))
# fixed values: words in class and id that mark what is no article text
_MARKS = set("ad ads adv advert advertisement advertisements adverts banner breadcrumb breadcrumbs comment "
             "comments consent cookie cookies copyright disqus footer gdpr login menu modal nav navbar "
             "navigation newsletter notice notices overlay pager pagination popup promo recommended related "
             "replies respond search share sharing sidebar signup social sponsor sponsored subscribe "
             "toolbar widget".split())
_REMARKS = set("comment comments replies respond disqus".split())
# a name with one of these tells of a state or an option, not what the element is
_STATES = set("no not non has have with without is enabled disabled on off hide show".split())
# elements that some sites wrap around the whole page
_WRAPPERS = set("form fieldset object label menu canvas dialog".split())
_NEVER = {"html", "body"}
_WORDS = re.compile(r"[a-z]+|[A-Z][a-z]*|[0-9]+")

KEEP, HEADINGS, DROP = 0, 1, 2


@dataclass
class Page:
    """A parsed page; element 0 is the document, and parents come before children."""

    parent: list[int] = field(default_factory=lambda: [0])
    tag: list[str] = field(default_factory=lambda: [""])
    attributes: list[dict] = field(default_factory=lambda: [{}])
    hash: list[int] = field(default_factory=lambda: [0])
    has_text: list[bool] = field(default_factory=lambda: [False])
    #: ``(element, text)``; a None text is the border of a block.
    pieces: list[tuple[int, str | None]] = field(default_factory=list)


def _attributes(rest: str) -> dict:
    out: dict[str, str] = {}
    for name, value in _ATTRIBUTE.findall(rest) if rest.strip(" /") else ():
        out.setdefault(name.lower(), html_lib.unescape(value.strip("\"'")))
    return out


def parse(source: str) -> Page:
    page = Page()
    open_, parts = [0], [[]]
    at, low = 0, None

    def close():
        me, own = open_.pop(), parts.pop()
        a = page.attributes[me]
        head = "\0".join((page.tag[me], a.get("class", ""), a.get("id", "")))
        page.hash[me] = xxhash.xxh64_intdigest(head.encode("utf-8", "surrogatepass") + b"\0" + b"".join(own))
        if parts:
            parts[-1].append(page.hash[me].to_bytes(8, "big") + b"\1")
            page.has_text[open_[-1]] |= page.has_text[me]
        if page.tag[me] in _BLOCK:
            page.pieces.append((open_[-1] if open_ else 0, None))
        elif page.tag[me] in _CELL:
            page.pieces.append((open_[-1], " "))

    def text(raw: str):
        if raw:
            raw = html_lib.unescape(raw) if "&" in raw else raw
            page.pieces.append((open_[-1], raw))
            words = " ".join(raw.split())
            if words:
                page.has_text[open_[-1]] = True
                parts[-1].append(words.encode("utf-8", "surrogatepass") + b"\2")

    while True:
        found = _TOKEN.search(source, at)
        if not found:
            text(source[at:])
            break
        text(source[at:found.start()])
        at = found.end()
        tag = (found["tag"] or "").lower()
        if not tag:
            continue
        if found["end"]:
            for k in range(len(open_) - 1, 0, -1):
                if page.tag[open_[k]] == tag:
                    while len(open_) > k:
                        close()
                    break
                if tag not in _BLOCK and page.tag[open_[k]] in _BLOCK:
                    break
            continue
        if tag in ("html", "body") and tag in page.tag:
            continue
        for ends, by, unless in _ENDS:
            if tag in by:
                for k in range(len(open_) - 1, 0, -1):
                    if page.tag[open_[k]] == ends:
                        while len(open_) > k:
                            close()
                        break
                    if page.tag[open_[k]] in unless:
                        break
        page.parent.append(open_[-1])
        page.tag.append(tag)
        page.attributes.append(_attributes(found["rest"]))
        page.hash.append(0)
        page.has_text.append(False)
        open_.append(len(page.tag) - 1)
        parts.append([])
        if tag in _BLOCK:
            page.pieces.append((open_[-1], None))
        if tag in _RAW:
            low = source.lower() if low is None else low
            low = low if len(low) == len(source) else re.sub("[A-Z]", lambda m: m[0].lower(), source)
            end = low.find(f"</{tag}", at)
            at = len(source) if end < 0 else end
            if end < 0:
                close()
        elif tag in _VOID:
            close()
    while open_:
        close()
    return page


def _named(a: dict, marks: set[str], parts: bool) -> bool:
    """Whether class or id is one of ``marks``, or (``parts``) begins or ends with one."""
    for token in f"{a.get('class', '')} {a.get('id', '')}".split():
        if token.lower() in marks:
            return True
        words = [w.lower() for w in _WORDS.findall(token)] if parts else ()
        if words and (words[0] in marks or words[-1] in marks) and not _STATES.intersection(words):
            return True
    return False


def _hidden(a: dict) -> bool:
    return ("hidden" in a or a.get("aria-hidden", "").lower() == "true" or a.get("role", "").lower() in _ROLES
            or bool(re.search(r"display\s*:\s*none", a.get("style", ""))))


#: What names the article, the strongest first.
_ARTICLE = (lambda tag, a: tag == "article",
            lambda tag, a: tag == "main" or a.get("role", "").lower() == "main",
            lambda tag, a: a.get("itemprop", "").lower() == "articlebody")


def _articles(page: Page) -> set[int]:
    """The elements that name the article: none inside menus, comments and the like; one
    with a mark of its own only if all have one."""
    n = len(page.tag)
    off = [False] * n
    for i in range(1, n):
        tag, a = page.tag[i], page.attributes[i]
        off[i] = off[page.parent[i]] or tag not in _NEVER and (
            tag in _DROPPED - _WRAPPERS or bool(a) and (_hidden(a) or _named(a, _REMARKS, True)))
    for rule in _ARTICLE:
        found = {i for i in range(1, n) if not off[i] and rule(page.tag[i], page.attributes[i])}
        plain = {i for i in found if not _named(page.attributes[i], _MARKS, False)}
        if found:
            return plain or found
    return set()


def _text_lengths(page: Page) -> list[int]:
    """Characters under each element that scripts and styles do not hold."""
    out = [0] * len(page.tag)
    for element, piece in page.pieces:
        if piece and page.tag[element] not in _RAW:
            out[element] += len(piece.strip())
    for i in range(len(out) - 1, 0, -1):
        out[page.parent[i]] += out[i]
    return out


def _layout(page: Page) -> tuple[list[int], list[bool], list[bool]]:
    """Of each element: what its marks say of it, whether it is inside the article,
    and whether it holds the article."""
    n = len(page.tag)
    roots, lengths = _articles(page), _text_lengths(page)
    inside, holds = [False] * n, [False] * n
    for i in range(1, n):
        inside[i] = inside[page.parent[i]] or i in roots
    for i in roots:
        j = i
        while j and not holds[page.parent[j]]:
            j = page.parent[j]
            holds[j] = True
    state = [KEEP] * n
    for i in range(1, n):
        up, tag, a = state[page.parent[i]], page.tag[i], page.attributes[i]
        article = i in roots or holds[i]
        parts = tag not in _HEADING and tag in _BLOCK - {"p"} and 2 * lengths[i] <= lengths[0]
        named = bool(a) and not article and tag not in _HEADING and _named(a, _MARKS, parts)
        dropped = tag in _DROPPED and not (article and tag in _WRAPPERS)
        if up == DROP or tag not in _NEVER and (dropped or named or bool(a) and not article and _hidden(a)):
            state[i] = DROP
        elif tag in _HEADING or i in roots and not inside[page.parent[i]]:
            state[i] = KEEP
        elif tag == "header" or tag not in _NEVER and bool(a) and not article and _named(
                {"class": a.get("class", "")}, {"header"}, parts):
            state[i] = HEADINGS
        else:
            state[i] = up
    if not roots:  # headers of the whole page
        state = [DROP if s == HEADINGS else s for s in state]
        for i in range(1, n):
            state[i] = DROP if state[page.parent[i]] == DROP else state[i]
    return state, inside, holds


def _inner(page: Page, i: int, inside: list[bool], holds: list[bool]) -> bool:
    """Whether element ``i`` is a container in an article."""
    return inside[page.parent[i]] and not holds[i] and page.tag[i] in _CONTAINER


def candidates(page: Page) -> tuple[list[int], list[int], int | None]:
    """Hashes of the subtrees that may be template, outside and inside the article, and the
    hash of the article."""
    _, inside, holds = _layout(page)
    texts = [i for i in range(1, len(page.tag)) if page.has_text[i]]
    roots = [i for i in range(1, len(page.tag)) if inside[i] and not inside[page.parent[i]]]
    return (sorted({page.hash[i] for i in texts if not inside[i] and not holds[i]
                    and page.tag[i] in _BLOCK and page.tag[i] not in ("html", "body")}),
            sorted({page.hash[i] for i in texts if _inner(page, i, inside, holds)}),
            xxhash.xxh64_intdigest(b"".join(page.hash[i].to_bytes(8, "big") for i in roots)) if roots else None)


def main_text(page: Page, template: set[int], inner: set[int] = frozenset()) -> tuple[str, int]:
    """Text, and how many subtrees were deleted as template, outside the article and inside."""
    state, inside, holds = _layout(page)
    n, deleted = len(page.tag), 0
    has_root = any(inside)
    gone = [False] * n
    for i in range(1, n):
        own = page.hash[i] in template and not inside[i] and not holds[i] and page.tag[i] in _BLOCK
        own = own or (page.hash[i] in inner and _inner(page, i, inside, holds))
        deleted += own and not gone[page.parent[i]]
        gone[i] = own or gone[page.parent[i]]
    blocks, now = [], []
    for element, piece in [*page.pieces, (0, None)]:
        if piece is None:
            block = " ".join("".join(now).split())
            if block:
                blocks.append(block)
            now = []
        elif state[element] == KEEP and not gone[element] and (inside[element] or not has_root):
            now.append(piece)
    return "\n".join(blocks), deleted


def host_of(url: Column) -> Column:
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#]*@)?([^/?#:]+)", 1)),
                      F.lit(""))


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _subtrees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a, b in text_slices([len(t or "") for t in strings(batch, "html")]):
            part, rows = batch.slice(a, b - a), []
            for i, source in enumerate(strings(part, "html")):
                if source:
                    page = parse(source)
                    outer, inner, article = candidates(page)
                    rows += [(i, _signed(page.hash[0]), _signed(h), False) for h in outer]
                    if article is not None:  # every article counts, also one without a container
                        rows += [(i, _signed(article), h if h is None else _signed(h), True) for h in (None, *inner)]
            if rows:
                at, content, h, inside = map(list, zip(*rows))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(at)), part.column(1).take(pa.array(at)),
                     pa.array(content, pa.int64()), pa.array(h, pa.int64()),
                     pa.array(inside, pa.bool_())], ["host", "page", "content", "h", "inside"])


def templates(subtrees: DataFrame, many: int = MANY_PAGES, share: float = SHARE) -> DataFrame:
    """``(host, inside, h, n_pages)`` of the subtrees that recur on the host's pages, and
    ``inside`` of those that recur in its articles."""
    pages = (subtrees.select("host", "inside", "content").distinct()
             .groupBy("host", "inside").agg(F.count("*").alias("of")))
    counts = (subtrees.where("h is not null").select("host", "inside", "h", "content").distinct()
              .groupBy("host", "inside", "h").agg(F.count("*").alias("n_pages")).where(F.col("n_pages") >= many))
    least = F.when(F.col("inside"), F.greatest(F.lit(share), F.lit(INSIDE_SHARE))).otherwise(share)
    return (counts.join(pages, ["host", "inside"]).where(F.col("n_pages") >= F.col("of") * least)
            .select("host", "inside", "h", "n_pages"))


def extract_main_text(pages: DataFrame, url: str = "url", html: str = "html", many: int = MANY_PAGES,
                      share: float = SHARE) -> DataFrame:
    """``pages`` with ``text`` and ``n_template``, the subtrees deleted as template."""
    kept = without(pages, "text", "n_template")
    keyed = pages.select(host_of(F.col(url)).alias("host"), F.xxhash64(html).alias("page"),
                         F.col(html).alias("html"))
    subtrees = written(keyed.mapInArrow(_subtrees, "host string, page long, content long, h long, inside boolean"), "subtrees")
    of_page = (subtrees.join(templates(subtrees, many, share), ["host", "inside", "h"])
               .groupBy("host", "page").agg(F.collect_set(F.when(~F.col("inside"), F.col("h"))).alias("_phx_template"),
                                            F.collect_set(F.when(F.col("inside"), F.col("h"))).alias("_phx_inner"))
               .select(F.col("host").alias("_phx_host"), F.col("page").alias("_phx_page"), "_phx_template",
                       "_phx_inner"))
    joined = kept.join(of_page, (host_of(F.col(url)) == F.col("_phx_host"))
                       & same(F.xxhash64(html), F.col("_phx_page")), "left").drop("_phx_host", "_phx_page")
    names = kept.columns
    schema = T.StructType([*kept.schema.fields, T.StructField("text", T.StringType()),
                           T.StructField("n_template", T.LongType())])

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sources = strings(batch, html)
            for a, b in text_slices([len(t or "") for t in sources]):
                part = batch.slice(a, b - a)
                found = [main_text(parse(s), *({h % (1 << 64) for h in x or ()} for x in found)) if s else ("", 0)
                         for s, *found in zip(sources[a:b], strings(part, "_phx_template"), strings(part, "_phx_inner"))]
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(part.schema.get_field_index(c)) for c in names],
                     pa.array([x[0] for x in found], pa.string()),
                     pa.array([x[1] for x in found], pa.int64())], [*names, "text", "n_template"])

    return joined.mapInArrow(extract, schema)


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = extract_main_text(read_table(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"), "n_template")
