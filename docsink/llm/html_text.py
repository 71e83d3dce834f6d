"""Main text of web pages by a site style tree (operator 9).

Each page is parsed once into blocks of text and branches of its tree. A branch
is named by the tags and classes on its path; the pages of a host are merged
path by path. A path's importance combines how much its content and its
presentation (the run of tags below it) vary over the host's pages, as entropies
between 0, equal everywhere, and 1, different everywhere; with more child
branches presentation counts more. Blocks below paths of low importance go.

Entropy alone cannot give right results: menus, adverts and footers differ from
page to page on many sites, and an article that a host carries many times looks
like boilerplate. So elements that by their tag or role are navigation, header,
footer, sidebar, notice, advert, script or style are never main text, unless the
page's article or main element lies below them. A class or id that is a noise
word lowers the importance of its branch, a part of one less so; whole names also
take their text from the page, but never more than leaves ``LEAST_SHARE`` of what
is left after the style tree. Of that text a page gives its articles, or its main
element if the articles hold less than half of both, or everything if both hold
little. A branch goes only if what lies around it (inside articles, their text)
differs between the pages that have it, so copied articles stay.

Entropies are sums over (host, path, content), combined before the shuffle. Every
path on ``MIN_PAGES`` pages is judged, whatever its share of the host. Removed
paths meet the paths of the pages as (host, path) rows, under a salt, so a host
with a third of all pages is spread out. Hosts that have any are noted in
``HOST_MARKS`` marks by hash, a broadcast of bounded size; other pages, and pages
whose names take the removed paths anyway, are not shuffled.

Defined results: null and empty html give an empty text. White space in a block
becomes one space; blocks are joined by one space. A null or odd url is a host
of its own, the empty one. Repeated rows count like further pages.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docsink.llm.common import text_of, written

MIN_PAGES = 8  # of a host, before its statistics say anything
LOW = 0.2  # importance below this is boilerplate
LOW_INSIDE = 0.05  # inside an article
VARIED = 0.5  # entropy of what differs from page to page
NAMED = 0.5  # what a noise word in a name (as a part, as the whole) leaves of the importance, once or twice
LEAST_SHARE = 0.1  # of a page's varied text, for names to take the rest or an area to be the page's
HALF = 0.5  # of the text in areas, for articles to be chosen before the main element
DAMPING = 0.9
SALT = 16
HOST_MARKS = 1 << 16
CHUNK_PAGES = 64

# Tags of HTML by their role.
BLOCK = frozenset(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure"
    " footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search"
    " section summary table tbody td tfoot th thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
NEVER_TEXT = frozenset(
    "applet audio button canvas datalist dialog embed form frame frameset head iframe input link map math menu meta"
    " meter nav noembed noframes noscript object optgroup option output progress script search select style svg"
    " template textarea title video aside footer".split()
)
# Tags that may also wrap a whole page.
WRAPPERS = frozenset("aside dialog footer form menu nav search".split())
NOISE_ROLES = frozenset(
    "alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search status toolbar"
    " tablist".split()
)
NOISE_NAMES = frozenset(
    "ad ads adbox adsense adslot advert advertisement advertisements adverts alert banner banners breadcrumb"
    " breadcrumbs comment comments commentlist consent cookie cookies disqus footer gdpr login masthead menu menus"
    " modal nav navbar navigation newsletter notice notices notification outbrain overlay pager pagination paywall"
    " popup promo promos promotion recommendations recommended related respond search share sharing sidebar sidebars"
    " signup skip social sponsor sponsored sponsors subscribe subscription taboola toolbar topbar widget"
    " widgets".split()
)
CLOSES = {
    "li": {"li"},
    "dt": {"dt", "dd"},
    "dd": {"dt", "dd"},
    "tr": {"tr", "td", "th"},
    "td": {"td", "th"},
    "th": {"td", "th"},
    "option": {"option"},
}
SCOPES = frozenset("article aside body dl div main nav ol section table td th ul".split())

_NAMES = re.compile(r"[a-z]+")
_HOST = re.compile(r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", re.IGNORECASE)


class _Element:
    __slots__ = ("tag", "above", "path", "area", "block", "noise", "named", "words", "children")

    def __init__(self, tag: str, above: _Element | None, path: str, area: str, block: bool, noise: int, named: int) -> None:
        self.tag, self.above, self.path, self.area, self.block = tag, above, path, area, block
        # 3: never text, 2: not text unless it holds the page's article, 1: by its name.
        self.noise, self.named = noise, named
        self.words = xxhash.xxh64()
        self.children: list[str] = []

    def line(self) -> Iterator[_Element]:
        element: _Element | None = self
        while element is not None:
            yield element
            element = element.above


class _Page(HTMLParser):
    """Blocks ``(area, path, named, text)`` and, per path, hashes of content and presentation."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = _Element("", None, "", "", True, 0, 0)
        self.stack = [self.root]
        self.elements: list[_Element] = []
        self.found: list[tuple[_Element, list[tuple[_Element, str]]]] = []
        self.text: list[tuple[_Element, str]] = []
        self.blocks: list[tuple[str, str, bool, str]] = []
        self.branches: dict[str, list] = {}

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in BLOCK:
            self._end_block()
            # A block closes an open paragraph.
            self._close({"p"}, SCOPES)
        if tag in CLOSES:
            self._close(CLOSES[tag], SCOPES - CLOSES[tag])
        above = self.stack[-1]
        above.children.append(tag)
        if tag in VOID:
            return
        given = dict(attrs)
        role = (given.get("role") or "").lower()
        whole = f"{given.get('class') or ''} {given.get('id') or ''}".lower().split()
        names = [_NAMES.findall(name) for name in whole]
        area = above.area
        if tag == "article" and not area.endswith("article"):
            area += " article" if area else "article"
        elif (tag == "main" or role == "main") and not area:
            area = "main"
        named = 0
        if tag not in ("html", "body", "article", "main"):
            if any(parts and NOISE_NAMES.issuperset(parts) for parts in names):
                named = 2
            elif any(not NOISE_NAMES.isdisjoint(parts) for parts in names):
                named = 1
        if tag in NEVER_TEXT and tag not in WRAPPERS or "hidden" in given:
            noise = 3
        elif tag in WRAPPERS and tag != "form" or tag == "header" and not area.endswith("article") or role in NOISE_ROLES - {"form"}:
            noise = 2
        else:
            noise = 1 if named == 2 or tag == "form" or role == "form" else 0
        if above.noise == 3:
            noise = 3
        block = tag in BLOCK
        path = above.path
        if block:
            kinds = sorted({part for parts in names for part in parts})
            path += ">" + tag + "".join("." + n for n in kinds[:4])
            if len(kinds) > 4:
                path += "." + xxhash.xxh64_hexdigest(" ".join(kinds))
        element = _Element(tag, above, path, area, block, noise, named)
        self.stack.append(element)
        if noise < 3:
            self.elements.append(element)

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        # HTML knows no self-closing: only void elements have no content.
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag: str) -> None:
        if tag in BLOCK:
            self._end_block()
        for place in range(len(self.stack) - 1, 0, -1):
            if self.stack[place].tag == tag:
                self._pop(place)
                break

    def handle_data(self, data: str) -> None:
        if self.stack[-1].noise < 3:
            self.text.append((self.stack[-1], data))

    def finish(self) -> None:
        self.close()
        self._end_block()
        self._pop(1)
        self._free_articles()
        noise: dict[_Element, int] = {self.root: 0}
        for element in self.elements:
            noise[element] = max(element.noise, noise[element.above])
        found = []
        for where, parts in self.found:
            for level in (0, 1):
                text = " ".join("".join(data for e, data in parts if noise[e] == level).split())
                if text:
                    found.append((where, level, text))
        around = {"": xxhash.xxh64(), "main": xxhash.xxh64(), "article": xxhash.xxh64()}
        plain = any(level == 0 for _, level, _ in found)
        for where, level, text in found:
            self.blocks.append((where.area, where.path, level == 1, text))
            raw = text.encode("utf-8", "surrogatepass")
            for element in where.line():
                # Named branches tell nothing about what lies around them.
                if level == 0 or noise[element]:
                    element.words.update(raw)
            if level == 0 or not plain:
                for area in {"", *where.area.split()}:
                    around[area].update(raw)
        ends = {area: _signed(words) for area, words in around.items()}
        for element in self.elements:
            if element.block and noise[element] < 2:
                area = element.area.split(" ")[-1]
                branch = self.branches.setdefault(
                    element.path, [xxhash.xxh64(), xxhash.xxh64(), 0, area, element.named, ends[area], noise[element] == 1]
                )
                branch[0].update(element.words.digest())
                branch[1].update(" ".join(element.children).encode())
                branch[2] = max(branch[2], len(set(element.children)))
                branch[6] = branch[6] and noise[element] == 1

    def _free_articles(self) -> None:
        """Nothing above the page's articles or main element is noise."""
        sizes = {e: 0 for e in self.elements if e.area and not e.above.area}
        free = [e for e in sizes if not any(a.noise for a in e.line())]
        if len(free) == len(sizes):
            return
        for _, parts in self.found:
            for where, data in parts:
                for element in where.line():
                    if element in sizes:
                        sizes[element] += len(data)
                    # Noise inside an article says nothing about its size.
                    if element.noise:
                        break
        if sum(sizes[e] for e in free) < LEAST_SHARE * sum(sizes.values()):
            for above in max(sizes, key=sizes.get).line():
                above.noise = 0

    def _close(self, tags: set[str], scopes: frozenset[str]) -> None:
        for place in range(len(self.stack) - 1, 0, -1):
            if self.stack[place].tag in tags:
                self._pop(place)
                return
            if self.stack[place].tag in scopes:
                return

    def _pop(self, place: int) -> None:
        while len(self.stack) > place:
            if self.stack[-1].block:
                self._end_block()
            self.stack.pop()

    def _end_block(self) -> None:
        parts, self.text = self.text, []
        if any(not data.isspace() for _, data in parts):
            self.found.append((next(e for e in reversed(self.stack) if e.block), parts))


def host_of(url: str | None) -> str:
    found = _HOST.match(url or "")
    return found[1].lower() if found else ""


def _signed(digest: xxhash.xxh64) -> int:
    return int.from_bytes(digest.digest()[:8], "big", signed=True)


def _parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for start in range(0, len(batch), CHUNK_PAGES):
            out = []
            for row in batch.iloc[start : start + CHUNK_PAGES].itertuples(index=False):
                page = _Page()
                page.feed(row.html)
                page.finish()
                out.append(
                    {
                        "page_id": row.page_id,
                        "url": row.url,
                        "host": host_of(row.url),
                        "blocks": [{"area": a, "path": p, "named": n, "text": t} for a, p, n, t in page.blocks],
                        "branches": [
                            {
                                "path": p,
                                "content": _signed(c),
                                "shape": _signed(s),
                                "children": n,
                                "area": a,
                                "named": m,
                                "around": r,
                                "taken": t,
                            }
                            for p, (c, s, n, a, m, r, t) in page.branches.items()
                        ],
                    }
                )
            yield pd.DataFrame(out)


_PARSED = (
    "page_id long, url string, host string, blocks array<struct<area:string,path:string,named:boolean,text:string>>,"
    " branches array<struct<path:string,content:long,shape:long,children:int,area:string,named:int,around:long,taken:boolean>>"
)


def _entropy(branches: DataFrame, value: str) -> DataFrame:
    """Entropy of ``value`` over the pages of a host's path, between 0 and 1."""
    facts = [F.max(c).alias(c) for c in ("children", "area", "named")] + [F.min("taken").alias("taken")]
    counts = branches.groupBy("host", "path", value).agg(F.count("*").alias("n"), *facts)
    pages = F.sum("n")
    spread = F.log(pages) - F.sum(F.col("n") * F.log("n")) / pages
    return counts.groupBy("host", "path").agg(
        pages.alias("pages"), F.when(pages > 1, spread / F.log(pages)).otherwise(1.0).alias(value), *facts
    )


def style_tree(parsed: DataFrame) -> DataFrame:
    """Importance of every path of every host: ``host, path, area, pages, importance, around, taken``."""
    branches = parsed.select("host", F.explode("branches").alias("b")).select("host", "b.*")
    content = _entropy(branches, "content")
    shape = _entropy(branches, "shape").select("host", "path", "shape")
    around = _entropy(branches, "around").select("host", "path", "around")
    weight = F.pow(F.lit(DAMPING), F.col("children"))
    importance = weight * F.col("content") + (1 - weight) * F.greatest("shape", "content")
    importance = importance * F.pow(F.lit(NAMED), F.col("named"))
    tree = content.join(shape, ["host", "path"]).join(around, ["host", "path"])
    return tree.select("host", "path", "area", "pages", importance.alias("importance"), "around", "taken")


def _removed(parsed: DataFrame) -> DataFrame:
    """Paths of low importance: ``host, path, taken``. What lies around them must differ from page to page."""
    is_article = F.col("path").rlike(r">(article|main)[^>]*$")
    outside = (F.col("area") == "") & (F.col("importance") < LOW) & ~F.col("path").rlike(r"^(>html)?(>body)?$")
    inside = (F.col("area") != "") & ~is_article & (F.col("importance") < LOW_INSIDE)
    judged = style_tree(parsed).where((F.col("pages") >= MIN_PAGES) & (F.col("around") >= VARIED))
    return judged.where(outside | inside).select("host", "path", "taken")


def _size(blocks: Column) -> Column:
    return F.aggregate(blocks, F.lit(0).cast("long"), lambda n, b: n + F.char_length(b["text"]))


def _unnamed(blocks: str) -> tuple[Column, Column]:
    """The blocks no name takes, and whether they are enough for the page."""
    unnamed = F.filter(blocks, lambda b: ~b["named"])
    return unnamed, _size(unnamed) >= LEAST_SHARE * _size(F.col(blocks))


def _chosen(blocks: str) -> tuple[Column, Column, Column, Column]:
    """Text of the blocks that are left: of the articles, the main element or the whole page."""
    unnamed, enough = _unnamed(blocks)
    rows = F.when(enough, unnamed).otherwise(F.col(blocks))
    article = F.filter("_rows", lambda b: F.endswith(b["area"], F.lit("article")))
    area = F.filter("_rows", lambda b: b["area"] != "")
    in_area = (F.size("_area") > 0) & (_size(F.col("_area")) >= LEAST_SHARE * _size(F.col("_rows")))
    in_article = _size(F.col("_article")) >= HALF * _size(F.col("_area"))
    main = F.filter("_area", lambda b: F.startswith(b["area"], F.lit("main")))
    chosen = F.when(in_area & in_article, F.col("_article")).when(in_area, main).otherwise(F.col("_rows"))
    return rows, article, area, chosen


def main_text(pages: DataFrame) -> DataFrame:
    """One row per page: ``page_id, url, text, n_chars``."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", text_of("html").alias("html"))
    numbered = rows.mapInPandas(_parse, _PARSED).withColumn("row", F.monotonically_increasing_id())
    parsed = written(numbered, "pages")
    removed = written(_removed(parsed), "removed")
    mark = F.pmod(F.xxhash64("host"), F.lit(HOST_MARKS)).alias("mark")
    marks = F.broadcast(removed.select(mark, "taken").groupBy("mark").agg(F.min("taken").alias("only_taken")))
    rows = parsed.select("*", mark).join(marks, "mark", "left")
    # Where names take a host's removed paths anyway, pages with enough other text stay as they are.
    meets = F.coalesce(~F.col("only_taken") | ~_unnamed("blocks")[1], F.lit(False))
    untouched = rows.where(~meets).select("page_id", "url", "blocks")

    salts = F.explode(F.array(*[F.lit(i) for i in range(SALT)])).alias("salt")
    salt = F.pmod(F.hash("row"), F.lit(SALT)).alias("salt")
    touched = rows.where(meets)
    paths = touched.select("row", "host", salt, F.explode("branches.path").alias("path"))
    found = paths.join(removed.select("host", "path", salts), ["host", "path", "salt"])
    # At most the paths of the page itself.
    gone = found.groupBy("row").agg(F.collect_set("path").alias("removed"))
    marked = touched.select("row", "page_id", "url", "blocks").join(gone, "row", "left")

    def kept(block):
        below = F.exists("removed", lambda r: F.startswith(F.concat(block["path"], F.lit(">")), F.concat(r, F.lit(">"))))
        return F.coalesce(~below, F.lit(True))

    left = marked.withColumn("blocks", F.filter("blocks", kept)).select("page_id", "url", "blocks")
    rows, article, area, chosen = _chosen("blocks")
    areas = untouched.unionByName(left).select("page_id", "url", rows.alias("_rows"))
    areas = areas.withColumn("_article", article).withColumn("_area", area)
    text = F.array_join(F.transform(chosen, lambda b: b["text"]), " ")
    texts = areas.select("page_id", "url", text.alias("text"))
    return texts.withColumn("n_chars", F.char_length("text").cast("long"))
