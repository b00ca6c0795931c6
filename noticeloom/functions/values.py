"""Dates, addresses, codes, cells of several values, and JSON."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from noticeloom.functions import vocabulary as V
from noticeloom.functions.text import first_of, inline, is_missing, nonempty, strip, text

_DATE = r"(?s)^.*?(\d{4})[-/.年]0?(\d{1,2})[-/.月]0?(\d{1,2}).*$"


def publish_date(c: Column) -> Column:
    """``2026-06-09 17:25``, ``2026/06/09``, ``2026年06月09日`` as ``2026.6.9``; other text as it is."""
    return F.regexp_replace(inline(c), _DATE, "$1.$2.$3")


def publish_part(label: Column, date: Column) -> Column:
    """``label-date``; empty if either is."""
    return F.coalesce(F.concat(nonempty(inline(label)), F.lit("-"), nonempty(publish_date(date))), F.lit(""))


def publish_cell(c: Column) -> Column:
    """Only parts of the form kind-YYYY.M.D with a known kind, each once, in order."""
    parts = F.transform(F.split(inline(c), "[；;]"), inline)
    known = "|".join(V.PUBLISHED_KINDS)
    kept = F.array_distinct(F.filter(parts, lambda p: p.rlike(rf"^(?:{known})-\d{{4}}\.\d{{1,2}}\.\d{{1,2}}$")))
    return F.coalesce(nonempty(F.array_join(kept, "；")), F.lit(V.DEFAULT))


def list_date(c: Column) -> Column:
    """The first YYYY-MM-DD or YYYY/MM/DD as a date; null if there is none or it is no day."""
    return F.try_to_date(F.translate(F.regexp_extract(text(c), r"\d{4}[/-]\d{2}[/-]\d{2}", 0), "/", "-"), "yyyy-MM-dd")


def date_range(a: Column, b: Column) -> Column:
    """``a 至 b``, or the one that is there."""
    return F.concat_ws(" 至 ", nonempty(strip(text(a))), nonempty(strip(text(b))))


def resolve(href: Column, base: str = V.BASE_URL) -> Column:
    """An address against the site's root."""
    return (
        F.when(href.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*:"), href)
        .when(F.startswith(href, F.lit("//")), F.concat(F.lit(base.split(":", 1)[0] + ":"), href))
        .when(F.startswith(href, F.lit("/")), F.concat(F.lit(base), href))
        .otherwise(F.concat(F.lit(base + "/"), href))
    )


def secure_url(c: Column, host: str = "prec.sxzwfw.gov.cn") -> Column:
    """The site's own addresses with https and without the port."""
    return F.regexp_replace(c, rf"^http://{host.replace('.', chr(92) + '.')}(?::80)?", f"https://{host}")


def normal_url(c: Column) -> Column:
    """Without fragment, default port and trailing slash; scheme and host in lower case."""
    t = F.regexp_replace(strip(text(c)), r"#.*$", "")
    origin = F.lower(F.regexp_extract(t, r"^([A-Za-z][A-Za-z0-9+.\-]*://[^/?]*)", 1))
    rest = F.substring(t, F.length(origin) + 1, F.length(t))
    origin = F.regexp_replace(F.regexp_replace(origin, r"^(http://.*):80$", "$1"), r"^(https://.*):443$", "$1")
    return F.concat(origin, F.regexp_replace(rest, r"/+$", ""))


def url_kind(c: Column, kinds: dict[str, str] | None = None, other: str = V.OTHER_KIND) -> Column:
    """The kind of an address by the first of ``kinds`` that it contains."""
    return F.coalesce(*(F.when(F.contains(c, F.lit(k)), F.lit(v)) for k, v in (V.URL_KINDS if kinds is None else kinds).items()), F.lit(other))


def detail_url(section: Column, detail_id: Column) -> Column:
    prefix = lookup(section, {k: p for k, (_, p) in V.SECTIONS.items()})
    return F.concat(F.lit(V.BASE_URL + "/"), prefix, F.lit("/"), detail_id.cast("string"), F.lit(".jhtml"))


def cache_key(url: Column, suffix: str = "") -> Column:
    return F.concat(F.md5(url.cast("binary")), F.lit(suffix))


def data_url(content: Column, mime: str = "image/png") -> Column:
    return F.concat(F.lit(f"data:{mime};base64,"), F.base64(content))


def lookup(code: Column, table: dict, default: Column | None = None) -> Column:
    """The label of a code, from a table that is part of the plan."""
    got = F.try_element_at(F.create_map(*(F.lit(str(x)) for pair in table.items() for x in pair)), strip(text(code)))
    return F.coalesce(got, F.lit("") if default is None else default)


def code_list(c: Column, table: dict[str, str]) -> Column:
    """``1;3;9`` as the labels, joined by ``、``; codes without a label stay."""
    codes = F.filter(F.transform(F.split(text(c), ";"), lambda x: strip(x)), lambda x: x != "")
    return F.array_join(F.transform(codes, lambda x: lookup(x, table, x)), "、")


def amount(c: Column, unit: str = "万元") -> Column:
    t = strip(text(c))
    return F.coalesce(F.concat(nonempty(t), F.lit(unit)), F.lit(""))


def price(c: Column, unit_code: Column) -> Column:
    t = strip(text(c))
    return F.coalesce(F.concat(nonempty(t), lookup(unit_code, V.PRICE_UNITS)), F.lit(""))


def joined(c: Column, sep: str = "、") -> Column:
    """An array as a text, nulls and empties left out."""
    return F.coalesce(F.array_join(F.filter(F.transform(c, lambda x: strip(text(x))), lambda x: x != ""), sep), F.lit(""))


def append_unique(cell: Column, part: Column, sep: str = "；", default: str = V.DEFAULT) -> Column:
    """A cell of several values with one more, unless it is there already."""
    new = inline(part)
    old = F.filter(F.transform(F.split(text(cell), sep), lambda x: strip(x)), lambda x: x != "")
    kept = F.when(is_missing(cell), F.lit(default)).otherwise(text(cell))
    return F.when(new == "", kept).when(is_missing(cell), new).otherwise(F.array_join(F.array_union(F.array_distinct(old), F.array(new)), sep))


def ordered_set(values: Column, sep: str = "；", default: str = V.DEFAULT) -> Column:
    """An array as a cell: missing ones left out, each value once, first-seen order."""
    kept = F.array_distinct(F.filter(F.transform(values, inline), lambda x: ~x.isin(V.MISSING)))
    return F.coalesce(nonempty(F.array_join(kept, sep)), F.lit(default))


def safe_int(c: Column, default: int = 0) -> Column:
    return F.coalesce(strip(text(c)).try_cast("long"), F.lit(default).cast("long"))


def percent(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, F.round(part * 100.0 / whole, 0)).otherwise(F.lit(0.0))


def thousands(c: Column) -> Column:
    """A count with its digits in groups of three."""
    return F.format_number(c.cast("long"), 0)


def tolerant_json(c: Column, schema: str) -> Column:
    """A model's answer as a struct: inside a code fence, or the outermost braces of the text around it; null if neither is JSON."""
    t = F.regexp_replace(F.regexp_replace(strip(text(c)), r"(?U)^```(?:json)?\s*", ""), r"(?U)\s*```$", "")
    whole = F.when(F.startswith(t, F.lit("{")) & F.endswith(t, F.lit("}")), t)
    return F.from_json(F.coalesce(whole, F.nullif(F.regexp_extract(t, r"(?s)\{.*\}", 0), F.lit(""))), schema)


def charset(header: Column, body: Column) -> Column:
    """The character set that a header, or else a page's first 8,000 bytes, names; else the one that its bytes look like."""
    own = r"(?i)charset\s*=\s*[\"']?([A-Za-z0-9_\-]+)"
    head = F.decode(F.substring(body, 1, 8000), "ISO-8859-1")
    return F.lower(first_of(F.regexp_extract(text(header), own, 1), F.regexp_extract(head, own, 1), charset_guess(body)))


def charset_guess(body: Column, looked_at: int = 65_536) -> Column:
    """utf-8, gb18030, big5 or iso-8859-1, by the bytes above ASCII of a page's first ``looked_at``: those that are whole UTF-8 characters are UTF-8;
    those that mostly stand alone are Latin; of pairs it decides whether more lie where GB 18030 has its frequent characters, or Big5. utf-8
    where there is nothing to tell by, or neither has a third of the pairs; a character that the end cuts through does not count."""
    s = F.decode(F.substring(F.coalesce(body, F.lit(b"")), 1, looked_at), "ISO-8859-1")
    s = F.regexp_replace(s, r"[\x80-\xff]{1,3}\z", "")
    n = lambda c, p: F.regexp_count(c, F.lit(p))
    broken = n(F.regexp_replace(s, r"[\xc2-\xdf][\x80-\xbf]|[\xe0-\xef][\x80-\xbf]{2}|[\xf0-\xf4][\x80-\xbf]{3}", " "), r"[\x80-\xff]")
    high, alone = n(s, r"[\x80-\xff]"), n(s, r"(?<![\x80-\xff])[\x80-\xff](?![\x80-\xff])")
    # every pair is ended by a mark, so that no pair is told by the halves of two
    pairs = F.regexp_replace(F.replace(s, F.lit("\x00"), F.lit(" ")), r"([\x81-\xfe][\x40-\x7e\x80-\xfe])", "$1\x00")
    gb, big5, every = n(pairs, "[\\xb0-\\xd7][\\xa1-\\xfe]\\x00"), n(pairs, "[\\xa4-\\xc6][\\x40-\\x7e\\xa1-\\xfe]\\x00"), n(pairs, "\\x00")
    found = F.when(gb >= big5, F.when((gb > 0) & (gb * 3 >= every), "gb18030")).when(big5 * 3 >= every, "big5")
    return F.when(broken == 0, "utf-8").when(alone * 2 > high, "iso-8859-1").otherwise(F.coalesce(found, F.lit("utf-8")))


def is_pdf(content: Column) -> Column:
    return F.coalesce(F.substring(content, 1, 4) == F.lit(b"%PDF"), F.lit(False))


def is_pdf_notice(content: Column, pdf_file: Column) -> Column:
    """Whether a notice is a PDF: it has a file and no text, or a short text that only embeds one."""
    t = strip(text(content))
    embeds = F.contains(F.lower(t), F.lit("pdf")) | F.contains(F.lower(t), F.lit("iframe"))
    return ((t == "") & (text(pdf_file) != "")) | ((t != "") & (F.length(t) < 200) & embeds)


# What a failed fetch is called, by its error and by words of its message.
ERRORS = {"ConnectTimeout": "连接超时", "ReadTimeout": "读取超时", "SSLError": "TLS/SSL失败"}
CONNECTION_ERRORS = {"connection reset": "连接被重置", "reset by peer": "连接被重置", "remote end closed connection": "远端关闭连接", "name resolution": "DNS解析失败"}


def error_label(kind: Column, message: Column) -> Column:
    """What a landed error (its class and its message) is called."""
    said = F.coalesce(*(F.when(F.contains(F.lower(text(message)), F.lit(w)), F.lit(v)) for w, v in CONNECTION_ERRORS.items()), F.lit("连接失败"))
    return F.when(kind == "ConnectionError", said).otherwise(lookup(kind, ERRORS, kind))
