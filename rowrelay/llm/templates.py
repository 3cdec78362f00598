"""Main text of web pages, by removal of what a site repeats.

Every element's subtree is hashed. Subtrees that many different pages of one host have
are its template and are deleted, besides the elements that are no article by their
name or class.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowrelay.llm.common import column, saved, text_digest

#: A subtree of so many different pages of a host is its template.
PAGES = 5
#: And of such a share of the host's different pages.
SHARE = 0.2
#: A text block of so many words inside an article is prose, whatever element it is in.
WORDS = 10

# Element names and class words of web pages.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead title tr ul".split()
)
PROSE = frozenset("p h1 h2 h3 h4 h5 h6 li ul ol dl dt dd blockquote pre table thead tbody tr td th figure figcaption".split())
IN_HEAD = frozenset("base link meta noscript script style template title".split())
NEVER = frozenset("aside button dialog footer form head iframe input menu nav noscript object script select style svg template textarea title".split())
ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split())
CLASSES = frozenset(
    "ad ads adsense advert adverts advertisement advertising aside banner breadcrumb breadcrumbs comment comments commentlist consent cookie cookies disclaimer "
    "discussion disqus footer gdpr masthead menu modal nav navbar navigation newsletter notice notification pagination paywall popup promo promoted promotion "
    "related respond share sharing sidebar signup social sponsor sponsored subscribe subscription toolbar widget".split()
)
HEADER_OF = frozenset("article content entry post story".split())

_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:"[^"]*"|'[^']*'|[^>"'])*+)(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)|<[!?/][^>]*(?:>|\Z)""", re.DOTALL)
_RAW_END = {name: re.compile(rf"</{name}(?=[\s/>])[^>]*(?:>|\Z)", re.IGNORECASE) for name in RAW}
_ATTRIBUTE = re.compile(r"""(?<![^\s"'/])(class|id|role|style|hidden|aria-hidden)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?(?=[\s/>]|\Z)""", re.IGNORECASE)
_CLOSED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}

_KEEPS_OPEN = frozenset("button div table td".split())


class Element:
    __slots__ = ("above", "code", "dropped", "holds", "kind", "marks", "paragraph", "parts", "prose", "tag")

    def __init__(self, tag: str, above: "Element | None", marks: str, dropped: bool):
        self.tag, self.above, self.marks, self.dropped = tag, above, marks, dropped
        self.kind = above.kind if above else ""  # "article" or "main" inside one
        self.prose = False  # inside an article, and in an element of prose
        self.holds = False  # the subtree has prose of an article
        self.parts: list[bytes] = []  # of the subtree: texts and the hashes of elements
        self.code = 0
        # The open paragraph that a block in here would end.
        self.paragraph = self if tag == "p" else None if above is None or tag in _KEEPS_OPEN else above.paragraph


def _attributes(text: str) -> dict[str, str]:
    return {m[1].lower(): entities.unescape((m[2] or "").strip("\"'")).lower() for m in _ATTRIBUTE.finditer(text)} if text and not text.isspace() else {}


def _unwanted(tag: str, attributes: dict[str, str], inside: str) -> bool:
    """Whether an element is no part of an article by its name, role, class or style."""
    if tag in NEVER or tag == "header" and inside != "article":
        return True
    if not attributes:
        return False
    if "hidden" in attributes or attributes.get("aria-hidden") == "true" or attributes.get("role") in ROLES:
        return True
    if re.search(r"display\s*:\s*none", attributes.get("style", "")):
        return True
    if tag in ("html", "body", "article", "main") and "comment" not in attributes.get("class", ""):
        return False
    words = set(re.findall(r"[a-z]+", f"{attributes.get('class', '')} {attributes.get('id', '')}"))
    return bool(words & CLASSES) or "header" in words and not words & HEADER_OF and inside != "article"


def parse(page: str) -> tuple[list[tuple[str, Element]], list[Element]]:
    """The text blocks of a page, each with its innermost element, and all its elements."""
    root = Element("", None, "", False)
    here, every, blocks, pieces = root, [], [], []
    standing: dict[str, int] = {}  # open elements by name, so that a lost end tag looks for none

    def flush() -> None:
        text = " ".join("".join(pieces).split())
        pieces.clear()
        if text:
            blocks.append((text, here))
            if here.prose or here.kind and text.count(" ") >= WORDS - 1:
                up = here
                while up and not up.holds:
                    up.holds, up = True, up.above

    def close() -> None:
        nonlocal here
        if here.tag in BLOCK:
            flush()
        here.code = xxhash.xxh3_64_intdigest(b"\x00".join((here.tag.encode(), here.marks.encode("utf-8", "replace"), *here.parts)))
        here.above.parts.append(here.code.to_bytes(8, "big"))
        standing[here.tag] -= 1
        here = here.above

    def text(raw: str) -> None:
        if raw:
            plain = entities.unescape(raw)
            if not here.dropped:  # also inline elements, such as a button in a paragraph
                pieces.append(plain)
            here.parts.append(" ".join(plain.split()).encode("utf-8", "replace"))

    at = 0
    while m := _TAG.search(page, at):
        text(page[at : m.start()])
        at = m.end()
        tag = (m[2] or m[5] or "").lower()
        if not tag:
            continue
        if m[1] or m[4]:
            if standing.get(tag):
                while here.tag != tag:
                    close()
                close()
            continue
        if tag in BLOCK and here.paragraph:  # a block ends a paragraph
            up = here.paragraph
            while here is not up:
                close()
            close()
        if tag in _CLOSED_BY and here.tag in _CLOSED_BY[tag]:
            close()
        if here.tag == "head" and tag not in IN_HEAD:
            close()
        if tag in BLOCK:
            flush()
        if tag in VOID:
            if tag in ("br", "hr"):
                pieces.append(" ")
            here.parts.append(tag.encode())
            continue
        attributes = _attributes(m[3] or m[6] or "")
        new = Element(tag, here, f"{attributes.get('class', '')} {attributes.get('id', '')}", here.dropped or _unwanted(tag, attributes, here.kind))
        if not new.dropped and (tag in ("article", "main") or attributes.get("role") == "main"):
            new.kind = "article" if tag == "article" or here.kind == "article" else "main"
        new.prose = bool(new.kind) and (tag in PROSE or here.prose)
        here = new
        every.append(new)
        standing[tag] = standing.get(tag, 0) + 1
        if tag in RAW:
            end = _RAW_END[tag].search(page, at)
            here.parts.append(page[at : end.start() if end else len(page)].encode("utf-8", "replace"))
            at = end.end() if end else len(page)
            close()
    text(page[at:])
    while here.above:
        close()
    flush()
    return blocks, every


def _template_of(element: Element) -> bool:
    """Whether an element may be a template: a block with content that is no article, none of its prose and holds none."""
    return not element.holds and element.tag in BLOCK and element.tag not in ("html", "body", "head", "title", "article", "main", "hr") and bool(element.parts) and not (element.kind and element.tag in PROSE)


def _on_site(code: int, site: str) -> int:
    """One number for a subtree of a site."""
    return xxhash.xxh3_64_intdigest(code.to_bytes(8, "big") + site.encode("utf-8", "replace"))


def subtrees(page: str, site: str = "") -> tuple[int, list[int]]:
    """A hash of the page's own text, and those of the site's subtrees that may be a template."""
    blocks, every = parse(page)
    own = xxhash.xxh3_64_intdigest("\n".join(_chosen(blocks, every, "", frozenset())).encode("utf-8", "replace"))
    return own, sorted({_on_site(e.code, site) for e in every if _template_of(e)})


def _site(site: str) -> int:
    """The number that stands for a site itself; every page of the site has it."""
    return _on_site(0, site)


def _chosen(blocks: list[tuple[str, Element]], every: list[Element], site: str, templates: frozenset[int]) -> list[str]:
    if templates:
        for element in every:  # outer elements come before inner ones
            element.dropped |= element.above.dropped or _template_of(element) and _on_site(element.code, site) in templates
    left = [(text, element.kind) for text, element in blocks if not element.dropped]
    for kind in ("article", "main"):
        if any(k == kind for _, k in left):
            return [t for t, k in left if k == kind]
    return [t for t, _ in left]


def main_text(page: str, site: str = "", templates: frozenset[int] = frozenset()) -> str:
    """The blocks of a page's article, else of its main element, else of all, without what is dropped."""
    return "\n".join(_chosen(*parse(page), site, templates))


def _signed(number: int) -> int:
    return number - (1 << 64) if number >> 63 else number


def extracted(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", min_pages: int = PAGES, share: float = SHARE) -> DataFrame:
    """(page_id, url, text, n_chars) of every row.

    A subtree is a template of a host if at least ``min_pages`` pages of the host whose
    texts differ have it, and at least ``share`` of the host's pages whose texts differ;
    copies of one page count once, so an article that is copied often is no template.
    Paragraphs, lists and tables inside an article or main element are never templates,
    nor is the element itself, nor anything that holds such prose or a text block of
    ``WORDS`` words of an article. Pages without a host in
    their url take part in no count. Text blocks are joined by one line break, white
    space inside a block is one space, character references are decoded.

    Null html is empty, and an empty page has an empty text. Repeated rows each get a
    row; an empty table gives none. Markup that is cut off or unbalanced is read as far
    as it goes. Other columns are not read.
    """
    html, url = column(pages, html_col).cast("string"), column(pages, url_col)
    narrow = pages.select(column(pages, id_col).alias("page_id"), url.alias("url"), text_digest(html).alias("digest"), html.alias("html"))
    kind, link_kind = (narrow.schema[c].dataType.simpleString() for c in ("page_id", "url"))
    host = F.lower(F.regexp_extract(F.coalesce(F.col("url").cast("string"), F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))

    def hash_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own, codes = [], []
            for value, site in zip(batch.column(3), batch.column(2).to_pylist(), strict=True):
                page, found = subtrees(value.as_py() or "", site)
                own.append(_signed(page))
                codes.append([_signed(c) for c in (_site(site), *found)] if site else [])
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(own, pa.int64()), pa.array(codes, pa.list_(pa.int64()))], names=["page_id", "digest", "own", "codes"])

    hashed = narrow.select("page_id", "digest", host.alias("host"), "html").mapInArrow(hash_all, f"page_id {kind}, digest long, own long, codes array<long>")
    hashed = saved(hashed, "subtrees")
    each = hashed.select("page_id", "digest", "own", F.explode("codes").alias("code"))  # a code is a subtree of a host, or the host
    often = each.groupBy("code", "own").agg(F.lit(1).alias("one")).groupBy("code").agg(F.count("*").alias("texts"))
    often = often.where(F.col("texts") >= min_pages)
    gone = each.select("page_id", "digest", "code").join(often, "code").groupBy("page_id", "digest").agg(F.collect_set(F.struct("code", "texts")).alias("gone"))
    gone = gone.select(F.col("page_id").alias("__id"), F.col("digest").alias("__of"), F.col("gone.code").alias("gone"), F.col("gone.texts").alias("texts"))
    same = F.col("page_id").eqNullSafe(F.col("__id")) & (F.col("digest") == F.col("__of"))
    joined = narrow.join(gone.hint("merge"), same, "left").select("page_id", "url", "html", host.alias("host"), "gone", "texts")

    def templates_of(site: str, codes: list[int] | None, texts: list[int] | None) -> frozenset[int]:
        times = {c & (1 << 64) - 1: n for c, n in zip(codes or (), texts or (), strict=True)}
        least = share * times.pop(_site(site), 0)
        return frozenset(c for c, n in times.items() if n >= least)

    def extract_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(batch.column(2), batch.column(3).to_pylist(), batch.column(4).to_pylist(), batch.column(5).to_pylist(), strict=True)
            texts = [main_text(page.as_py() or "", site, templates_of(site, codes, often)) for page, site, codes, often in rows]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(texts, pa.string())], names=["page_id", "url", "text"])

    out = joined.mapInArrow(extract_all, f"page_id {kind}, url {link_kind}, text string")
    return out.withColumn("n_chars", F.length("text").cast("long"))
