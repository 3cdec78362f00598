"""WARC derivatives: metadata and plain-text conversion records of response records.

All in DataFrame functions. A derived record names the response that it refers to,
carries that one's headers and digests, and has an id made from them, so building it
again gives the same record.
"""

from __future__ import annotations

from html.entities import html5

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowrelay.llm.common import column

VERSION = "WARC/1.1"
DATE = "2024-01-01T00:00:00Z"
# Elements whose content is no text of the page, and those that stand on lines of their own.
HIDDEN = ("script", "style", "title")
BLOCKS = (
    "address article aside blockquote body br caption center col colgroup dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search section "
    "select summary table tbody td tfoot th thead tr ul"
).split()
# An unclosed comment or hidden element ends with the page. Tags end at the first > outside quotes, if their quotes
# are closed before another tag; loops are possessive, so that long markup takes neither stack nor quadratic time.
_INSIDE = r"""(?:[^<>"']++|"[^"]*+"|'[^']*+')*+>"""
SKIPPED = "(?is)<(?:" + "|".join([r"!--.*?(?:-->|\z)", *(rf"{e}(?:[\s/][^<>]*+)?>.*?(?:</{e}\s*>|\z)" for e in HIDDEN)]) + ")"
BREAKS = rf"""(?i)</?(?:{"|".join(sorted(BLOCKS, key=len, reverse=True))})(?=[\s/>]){_INSIDE}"""
TAGS = rf"<[A-Za-z/!?](?:{_INSIDE}|[^<>]*+>)"
TITLE = r"(?is)<title(?:[\s/][^<>]*+)?>(.*?)(?:</title|\z)"
LINK = rf"(?i)<a(?=[\s/]){_INSIDE}"
# A quoted value ends before its quote, so that the next name may follow at once.
ATTRIBUTE = r"""(?s)[\s/"'][^\s"'<>/=]++\s*+=\s*+(?:"[^"]*+|'[^']*+|[^\s"'>][^\s>]*+)"""
HREF = r"(?is)^.href\s*=\s*[\"']?(.*)$"


def references() -> tuple[dict[str, str], dict[str, str]]:
    """Names of character references that end with a semicolon, and those that may lack it, with their texts."""
    return {n[:-1]: t for n, t in html5.items() if n.endswith(";")}, {n: t for n, t in html5.items() if not n.endswith(";")}


def windows_signs() -> dict[int, str]:
    """What numbers of the range of controls stand for: the code page that pages mean by them."""
    return {n: bytes([n]).decode("cp1252", "ignore") or chr(n) for n in range(128, 160)}


def _map(signs: dict) -> Column:
    return F.str_to_map(F.lit("\u0002".join(f"{k}\u0001{v}" for k, v in signs.items())), F.lit("\u0002"), F.lit("\u0001"))


def _numbered(code: Column) -> Column:
    """The text of a numeric reference such as #39 or #x27."""
    digits = F.regexp_replace(code, "^#[xX]?0*", "")
    value = F.when(F.lower(F.substring(code, 2, 1)) == "x", F.conv(digits, 16, 10)).otherwise(digits)
    number = F.when(F.length(digits) <= 15, F.coalesce(value.try_cast("bigint"), F.lit(0))).otherwise(-1)

    def sign(n: Column) -> Column:
        bytes_of = F.unhex(F.lpad(F.hex(n), 8, "0"))
        bad = (n <= 0) | n.between(0xD800, 0xDFFF) | (n > 0x10FFFF)
        nothing = n.between(1, 8) | (n == 11) | n.between(14, 31) | (n == 127) | n.between(0xFDD0, 0xFDEF) | (n % 65536 >= 65534)
        return F.when(bad, "�").when(n.between(128, 159), F.element_at(_map(windows_signs()), n.cast("string"))).when(nothing, "").otherwise(F.decode(bytes_of, "UTF-32"))

    return F.element_at(F.transform(F.array(number), sign), 1)


def decoded(text: Column, attribute: bool = False) -> Column:
    """The text with its character references decoded: all names, decimal and hexadecimal numbers.

    Some names may lack the semicolon, but in an attribute only before what is neither a
    letter, a digit nor ``=``, as links hold such names. Numbers that are no character
    give U+FFFD, those of controls and noncharacters nothing. Other ampersands stay.
    """
    closed, open_ = references()
    names, short = _map(closed), _map(open_)
    legacy = "^(?:" + "|".join(sorted(open_, key=lambda n: (-len(n), n))) + ")" + ("(?![=A-Za-z0-9])" if attribute else "")
    rest = lambda part, used: F.substr(part, F.length(used) + 1)

    def one(part: Column) -> Column:
        code = F.regexp_extract(part, "^(?:#[0-9]+|#[xX][0-9a-fA-F]+|[A-Za-z][A-Za-z0-9]*)", 0)
        return F.struct(part.alias("part"), code.alias("code"))

    def text_of(x: Column) -> Column:
        part, code = x["part"], x["code"]
        tail = rest(part, code)
        ended = F.startswith(tail, F.lit(";"))
        after = F.when(ended, F.substring(tail, 2, 1 << 30)).otherwise(tail)
        open_part = lambda prefix: F.when(prefix != "", F.concat(F.element_at(short, prefix), rest(part, prefix))).otherwise(F.concat(F.lit("&"), part))
        without = F.transform(F.array(F.regexp_extract(part, legacy, 0)), open_part)[0]
        named = F.when(code == "amp", "&").otherwise(F.element_at(names, code))
        return (
            F.when(code == "", F.concat(F.lit("&"), part))
            .when(F.startswith(code, F.lit("#")), F.concat(_numbered(code), after))
            .when(ended, F.coalesce(F.concat(named, after), without))
            .otherwise(without)
        )

    def joined(parts: Column) -> Column:
        later = F.transform(F.transform(F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))), one), text_of)
        return F.when(F.size(parts) > 1, F.concat(parts[0], F.array_join(later, ""))).otherwise(parts[0])

    # Split once: what an expression names several times is computed as often.
    return F.transform(F.array(F.split(text, "&")), joined)[0]


def outlinks(html: Column) -> Column:
    """The targets of a page's links in their order: the first href of each, quoted either way or not at all."""
    first = lambda tag: F.get(F.filter(F.regexp_extract_all(tag, F.lit(ATTRIBUTE), 0), lambda a: F.rlike(a, F.lit(HREF))), 0)
    found = F.filter(F.transform(F.regexp_extract_all(html, F.lit(LINK), 0), first), lambda a: a.isNotNull())
    return F.transform(found, lambda a: decoded(F.regexp_extract(a, HREF, 1), attribute=True))


def plain_text(html: Column) -> Column:
    """The text of a page: no scripts, styles, title or tags; blocks on lines of their own.

    White space inside a line is one space, no-break spaces included.
    """
    text = F.regexp_replace(html, SKIPPED, "")
    for sign in "\t\r\n\f":
        text = F.replace(text, F.lit(sign), F.lit(" "))
    text = F.regexp_replace(F.regexp_replace(text, BREAKS, "\n"), TAGS, "")
    text = F.replace(decoded(text), F.lit("\u00a0"), F.lit(" "))
    text = F.replace(F.regexp_replace(text, " {2,}+", " "), F.lit(" \n"), F.lit("\n"))
    return F.btrim(F.regexp_replace(text, "\n[ \n]++", "\n"), F.lit(" \n"))


def record_id(*parts: Column) -> Column:
    """A UUID made from the parts."""
    code = F.md5(F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]))
    groups = [F.substring(code, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *groups), F.lit(">"))


def digest(text: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(text, 256))


def responses(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", date: str = DATE) -> DataFrame:
    """(page_id, record_id, target_uri, date, http_headers, payload, payload_digest) of fetched pages.

    http_headers are lines of the response's header, without the status line. A null
    page is an empty payload. Other columns are not read.
    """
    html = F.coalesce(column(pages, html_col).cast("string"), F.lit(""))
    page_id, url = column(pages, id_col), column(pages, url_col).cast("string")
    rows = pages.select(page_id.alias("page_id"), url.alias("target_uri"), F.lit(date).alias("date"), html.alias("payload"))
    rows = rows.withColumn("payload_digest", digest(F.col("payload")))
    headers = F.array(F.lit("Content-Type: text/html; charset=utf-8"), F.concat(F.lit("Content-Length: "), F.octet_length("payload").cast("string")))
    return rows.select("page_id", record_id(F.lit("response"), F.col("page_id"), F.col("target_uri"), F.col("payload_digest")).alias("record_id"), "target_uri", "date", headers.alias("http_headers"), "payload", "payload_digest")


def derivatives(found: DataFrame) -> DataFrame:
    """(page_id, warc_type, record_id, refers_to, target_uri, block_digest, source_digest, content_length, header, block).

    Every response gives a metadata record (warc-fields: title, links, source headers
    and digest) and a conversion record (its text). ``header`` is the record's header,
    ``block`` its content; the digest and the length are those of the block's UTF-8
    bytes. A response without a target uri gives records without that line. Repeated
    responses give repeated records, an empty table none. No shuffle.
    """
    lines = lambda name, values: F.transform(values, lambda v: F.concat(F.lit(f"{name}: "), v))
    one_line = lambda text: F.trim(F.regexp_replace(text, r"[ \t\r\n\f]+", " "))
    title = one_line(decoded(F.regexp_extract("payload", TITLE, 1)))
    links = F.transform(outlinks(F.col("payload")), one_line)
    fields = F.concat(
        F.array(F.concat(F.lit("title: "), title), F.concat(F.lit("source-payload-digest: "), F.col("payload_digest"))),
        lines("source-header", F.coalesce("http_headers", F.array().cast("array<string>"))),
        lines("outlink", links),
    )
    both = found.select("page_id", "record_id", "target_uri", "date", "payload_digest", F.concat(F.array_join(fields, "\r\n"), F.lit("\r\n")).alias("about"), plain_text(F.col("payload")).alias("text"))
    each = both.select("*", F.explode(F.array(F.lit("metadata"), F.lit("conversion"))).alias("warc_type"))
    is_text = F.col("warc_type") == "conversion"
    each = each.withColumn("block", F.when(is_text, F.col("text")).otherwise(F.col("about"))).drop("about", "text")
    own = each.select("page_id", "warc_type", record_id(F.col("warc_type"), F.col("record_id")).alias("record_id"), F.col("record_id").alias("refers_to"), "target_uri", "date", F.col("payload_digest").alias("source_digest"), digest(F.col("block")).alias("block_digest"), F.octet_length("block").cast("long").alias("content_length"), "block")
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value)
    header = F.concat_ws(
        "\r\n",
        F.lit(VERSION),
        line("WARC-Type", F.col("warc_type")),
        line("WARC-Record-ID", F.col("record_id")),
        line("WARC-Refers-To", F.col("refers_to")),
        line("WARC-Refers-To-Target-URI", F.col("target_uri")),
        line("WARC-Target-URI", F.col("target_uri")),
        line("WARC-Date", F.col("date")),
        line("WARC-Block-Digest", F.col("block_digest")),
        line("WARC-Source-Payload-Digest", F.col("source_digest")),
        line("Content-Type", F.when(F.col("warc_type") == "conversion", "text/plain; charset=utf-8").otherwise("application/warc-fields")),
        line("Content-Length", F.col("content_length").cast("string")),
    )
    return own.withColumn("header", header).drop("date")


def write_warc(records: DataFrame, path: str) -> None:
    """Write derived records as gzip-compressed WARC files, one for each task."""
    end = "\r\n\r\n"
    records.select(F.concat("header", F.lit(end), "block").alias("value")).write.option("lineSep", end).option("compression", "gzip").text(path)
