"""Main text of web pages: parts that name themselves as furniture go, and so do subtrees that a site repeats.

A page's markup is read with one pattern into open and closed elements. Every subtree of the region that could hold the article
is hashed; Spark counts on how many different pages of a host each hash occurs, and subtrees on at least half of them
are its template and are deleted. Pages with the same text are one page there, so copies of an article are no template of it.
What remains is the text, block by block.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanery.session import materialize

#: A subtree is a template from this many different pages of a host on, if these are this share of the host's different pages.
LEAST_PAGES, LEAST_SHARE = 10, 0.5
MARKUP = re.compile(r"<!--.*?(?:-->|\Z)|<(script|style|noscript|template|textarea|title|svg|iframe)\b[^>]*>.*?(?:</\1\s*>|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?][^>]*>", re.S | re.I)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
FURNITURE = frozenset("nav footer aside form head button select dialog menu fieldset object applet audio video canvas map".split())
NAMES = re.compile(
    r"(?:^|[\s_-])(?:ad|ads|adv|advert|adverts|advertisement|advertising|sponsor|sponsored|promo|promoted|promotion|banner|menu|nav|navbar|navigation|breadcrumb|breadcrumbs"
    r"|sidebar|side-bar|footer|site-header|page-header|masthead|topbar|toolbar|cookie|cookies|consent|gdpr|notice|notification|alert|popup|modal|overlay|newsletter|subscribe|subscription|signup|login"
    r"|social|share|sharing|related|recommended|comment|comments|commentlist|disqus|replies|respond|widget|pagination|pager|skip-link|copyright|legal|disclaimer)(?:$|[\s_-])",
    re.I,
)
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
ATTRIBUTE = re.compile(r"([a-zA-Z-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))|\b(hidden)\b")
CLOSES = {"li": ("li",), "p": ("p",), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "option": ("option",)}
#: An element that one of these ends inside is not closed from outside it.
SCOPES = frozenset("article main section div body td table ul ol blockquote".split())


def _attributes(raw: str) -> dict[str, str]:
    return {(m[1] or m[5]).lower(): m[2] or m[3] or m[4] or "" for m in ATTRIBUTE.finditer(raw)} if raw else {}


def _furniture(tag: str, raw: str, in_article: bool) -> bool:
    if tag in FURNITURE or (tag == "header" and not in_article):
        return True
    if "=" not in raw and "hidden" not in raw:
        return False
    found = _attributes(raw)
    if "hidden" in found or found.get("aria-hidden") == "true" or found.get("role", "").lower() in ROLES:
        return True
    return tag not in ("body", "html", "main") and bool(NAMES.search(found.get("class", "")) or NAMES.search(found.get("id", "")))


class Page:
    """Elements as [tag, start, end, dropped, is main, depth] and text runs as (start, end), in page order."""

    def __init__(self, source: str):
        self.source = source
        self.elements: list[list] = []
        self.runs: list[tuple[int, int]] = []
        self.breaks: set[int] = set()
        opened: list[int] = []
        at = article = 0
        for m in MARKUP.finditer(source):
            if m.start() > at:
                self.runs.append((at, m.start()))
            at = m.end()
            if m[3] is None:
                continue
            tag = m[3].lower()
            if tag not in INLINE:
                self.breaks.add(m.start())
            if m[2]:
                article -= self._close(opened, tag, m.start(), m.end())
                continue
            for other in CLOSES.get(tag, ()):
                if opened and self.elements[opened[-1]][0] == other:
                    article -= self._close(opened, other, m.start(), m.start())
            if tag in VOID:
                continue
            main = tag in ("article", "main") or 'role="main"' in m[4]
            drop = _furniture(tag, m[4], article > 0)
            if m[4].endswith("/") and tag not in INLINE:
                continue
            self.elements.append([tag, m.start(), len(source), drop, main and not drop, len(opened)])
            opened.append(len(self.elements) - 1)
            article += main and not drop
        if at < len(source):
            self.runs.append((at, len(source)))

    def _close(self, opened: list[int], tag: str, start: int, end: int) -> int:
        """Close the nearest open element of a tag and all in it; how many main elements that were."""
        for depth in range(len(opened) - 1, -1, -1):
            name = self.elements[opened[depth]][0]
            if name == tag:
                closed = opened[depth:]
                for i in closed:
                    self.elements[i][2] = end if i == opened[depth] else start
                del opened[depth:]
                return sum(self.elements[i][4] for i in closed)
            if name in SCOPES and tag in ("p", "li", "b", "i", "a", "span"):
                break
        return 0

    def _dropped(self) -> list[tuple[int, int]]:
        return [(e[1], e[2]) for e in self.elements if e[3]]

    def region(self) -> list[tuple[int, int]]:
        """Where the article lies: the outermost main elements outside furniture, or the whole page."""
        spans, inside = [], -1
        dropped = self._dropped()
        for e in self.elements:
            if e[4] and e[1] >= inside and not any(a <= e[1] < b for a, b in dropped):
                spans.append((e[1], e[2]))
                inside = e[2]
        return spans or [(0, len(self.source))]

    def subtrees(self) -> dict[int, tuple[int, int]]:
        """hash -> place of the subtrees inside the region; the region itself is none of them."""
        out, at, dropped_to = {}, iter(self.region()), -1
        region = list(at)
        for tag, start, end, drop, _, _ in self.elements:
            if start < dropped_to or tag in ("html", "body"):
                continue
            if drop:
                dropped_to = end
            elif any(a <= start and end <= b and (a, b) != (start, end) for a, b in region):
                out.setdefault(xxhash.xxh64_intdigest(self.source[start:end].encode("utf-8", "surrogatepass")) - 2**63, []).append((start, end))
        return out

    def text(self, template: frozenset[int] = frozenset()) -> str:
        gone = self._dropped()
        if template:
            gone += [span for key, spans in self.subtrees().items() if key in template for span in spans]
        gone.sort()
        out, g, gone_to, last = [], 0, -1, 0
        breaks = sorted(self.breaks)
        b = 0
        region = self.region()
        for start, end in self.runs:
            split = False
            while b < len(breaks) and breaks[b] < start:
                split, b = True, b + 1
            if split:
                out.append(" ")
            while g < len(gone) and gone[g][0] <= start:
                gone_to, g = max(gone_to, gone[g][1]), g + 1
            if start >= gone_to and any(a <= start < z for a, z in region):
                out.append(html.unescape(self.source[start:end]))
        return " ".join("".join(out).split())


def host(url: F.Column) -> F.Column:
    """What lies between ``://`` and the next ``/``, ``?`` or ``#``, lower-cased; empty for a null or where it is missing."""
    return F.lower(F.coalesce(F.regexp_extract(url, r"://([^/?#]*)", 1), F.lit("")))


def _hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of every text that the task meets on a host: its hash and those of its page's subtrees, behind a null for the page itself."""
    seen: set[tuple[str, int]] = set()
    for batch in batches:
        hosts, texts, hashes = [], [], []
        for name, source in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist(), strict=True):
            page = Page(source or "")
            text = xxhash.xxh64_intdigest(page.text().encode("utf-8", "surrogatepass")) - 2**63
            if (name, text) not in seen:
                seen.add((name, text))
                hosts.append(name)
                texts.append(text)
                hashes.append([None, *page.subtrees()])
        columns = [pa.array(hosts, pa.string()), pa.array(texts, pa.int64()), pa.array(hashes, pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays(columns, names=["host", "text", "hashes"])


def templates(pages: DataFrame, least_pages: int = LEAST_PAGES, least_share: float = LEAST_SHARE) -> DataFrame:
    """host, hashes: the subtrees that recur on at least ``least_pages`` and ``least_share`` of a host's different pages.

    Pages of a host whose texts are equal before templates go are one page. As a subtree must lie on a share of all pages, a
    host has few of them, however many pages it has. Copies leave and counts are made in the tasks before they are shuffled,
    so a host with a third of all pages is no single task's, nor is a page with as many copies.
    """
    found = pages.where("host != ''").mapInArrow(_hashes, "host string, text long, hashes array<long>")
    # Copies that differ outside their text may differ in subtrees: any of them stands for all.
    once = found.groupBy("host", "text").agg(F.min("hashes").alias("hashes"))
    counts = once.select("host", F.explode("hashes").alias("hash")).groupBy("host", "hash").agg(F.count("*").alias("n"))
    counts = materialize(counts.where((F.col("n") >= least_pages) | F.col("hash").isNull()), "page-subtrees")
    total = counts.where("hash is null").select("host", F.col("n").alias("pages"))
    often = counts.where("hash is not null").join(total, "host").where(F.col("n") >= F.col("pages") * least_share)
    return often.groupBy("host").agg(F.collect_list("hash").alias("hashes"))


def _texts(kind: pa.DataType | None = None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sources, hashes = batch.column("html").to_pylist(), batch.column("hashes").to_pylist()
            texts = [Page(s).text(frozenset(h or ())) if s else "" for s, h in zip(sources, hashes, strict=True)]
            columns = [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names[:2], "text", "n_chars"])

    return run


def extract(pages: DataFrame, key: str = "page_id", url: str = "url", source: str = "html") -> DataFrame:
    """key, url, text, n_chars (code points) of every page; the text is empty where nothing remains.

    A null page is empty. Pages without a host in their url are read without a template. Repeated rows stay; pages of a
    host with the same text count once there; other columns are ignored; an empty table stays empty. Pages are read whole.
    """
    rows = pages.select(F.col(key), F.col(url).alias("url"), F.col(source).alias("html"), host(F.col(url)).alias("host"))
    found = materialize(templates(rows), "page-templates")
    kind = rows.schema[0].dataType.simpleString()
    joined = rows.join(found, "host", "left").select(key, "url", "html", "hashes")
    return joined.mapInArrow(_texts(), f"{key} {kind}, url string, text string, n_chars long")
