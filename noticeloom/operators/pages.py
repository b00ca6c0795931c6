"""Landed pages into rows: list pages to items, detail pages to fields and text.

Pages are parsed once, in Arrow batches, by functions that return structs; everything after the parse is DataFrame work.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from urllib.parse import urljoin

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import DataType

from noticeloom.functions import vocabulary as V
from noticeloom.functions.markup import Node, parse
from noticeloom.functions.text import squeeze, strip, text, unescape
from noticeloom.functions.titles import canonical_title
from noticeloom.functions.values import detail_url, list_date, resolve, secure_url, url_kind

ITEMS = "array<struct<raw_title:string,link:string,date:string,place:string>>"


def _squeezed(s: str | None) -> str:
    return " ".join((s or "").split())


def _lines(s: str) -> str:
    s = s.replace("\xa0", " ").replace("&nbsp;", " ").replace("　", " ")
    return "\n".join(x for x in (re.sub(r"[ \t\r\f\v]+", " ", line).strip() for line in s.splitlines()) if x)


def over(schema: str, f: Callable) -> Callable[..., Column]:
    """A function of one or two texts as an Arrow function of columns, whatever it returns; nulls come as None."""

    def made(*cols) -> Column:
        # made when first asked for: a type can only be parsed in a session
        kind = to_arrow_type(DataType.fromDDL(schema))
        plain = (lambda x: list(x.items()) if isinstance(x, dict) else x) if pa.types.is_map(kind) else (lambda x: x)

        def one(a: pa.Array) -> pa.Array:
            return pa.array([plain(f(x.as_py())) for x in a], kind)

        def two(a: pa.Array, b: pa.Array) -> pa.Array:
            return pa.array([plain(f(x.as_py(), y.as_py())) for x, y in zip(a, b, strict=True)], kind)

        return F.arrow_udf(one if f.__code__.co_argcount == 1 else two, schema)(*(F.col(c) if isinstance(c, str) else c for c in cols))

    return made


def _items(html: str | None) -> list[dict]:
    out = []
    for a in parse(html).select("a.cs_two_c_2"):
        title, date = a.first("p.cs_bz_cont", ".cs_bz_cont"), a.first(".cs_bz_cont_1_time")
        place = next((s.text().replace("交易场所：", "").strip() for p in a.select("p.cs_bz_cont_1") for s in p.select("span") if "交易场所" in s.text()), "")
        out.append({"raw_title": _squeezed(title.text()) if title else "", "link": a.attrs.get("href", ""), "date": _squeezed(date.text()) if date else "", "place": place})
    return out


def _frame_items(html: str | None) -> list[dict]:
    out = []
    for a in parse(html).select("a.clearfix"):
        if a.attrs.get("href") and a.attrs.get("title"):
            meta = {k: "" for k in ("招标编号", "招标方式", "报名截止时间")}
            for dd in a.select("dd"):
                span = dd.first("span")
                for k in meta:
                    if span and not meta[k] and k in dd.text():
                        meta[k] = span.text().strip()
            date = a.first("div.newsDate div")
            out.append({"title": a.attrs["title"], "detail_url": a.attrs["href"], "bid_no": meta["招标编号"], "tender_method": meta["招标方式"], "deadline": meta["报名截止时间"], "publish_date": date.text().strip() if date else ""})
    return out


def _label(cell: Node) -> str:
    return re.sub(r"[（(][^）)]*[）)]", "", _squeezed(cell.text()).rstrip("：: ")).strip()


def _pairs(html: str | None) -> dict[str, str]:
    """Bold cells of the message table and the plain cell that follows each in its row."""
    table, out = parse(html).first("table.bid_msgTable"), {}
    for row in table.select("tr") if table else ():
        cells = list(row.select("td"))
        bold = [c.first("b") is not None for c in cells]
        for i, c in enumerate(cells):
            if bold[i]:
                out[_label(c)] = next((_squeezed(cells[j].text()) for j in range(i + 1, len(cells)) if not bold[j]), "")
    return out


def _content(html: str | None) -> str:
    root = parse(html)
    return _lines((root.first("table.gycq-table td", ".cs_xq_content") or root).text("\n"))


def _body(html: str | None) -> str:
    root = parse(html)
    article = root.first(".div-article2")
    node = article or root.first(".cs_xq_content")
    if node is None:
        return ""
    t = re.sub(r" {2,}", " ", node.text("\n", skip=frozenset(("script", "style"))))
    return (re.sub(r"\n{3,}", "\n\n", t) if article else t).strip()


def _readable(node: Node) -> str:
    return "\n".join(x for x in (re.sub(r"[ \t\xa0]+", " ", p).strip() for piece in node.pieces() for p in piece.splitlines()) if x)


def _main(html: str | None) -> dict:
    """The longest text of the usual containers; the whole body if that is short."""
    root = parse(html)
    root.drop(V.REMOVED_SELECTORS)
    best, source = "", "body兜底"
    for s in V.CONTENT_SELECTORS:
        node = root.first(s)
        if node is not None and len(t := _readable(node)) > len(best):
            best, source = t, s
    whole = _readable(root.first("body") or root) if len(best) < 200 else ""
    return {"text": whole, "source": "body兜底"} if len(whole) > len(best) else {"text": best, "source": source}


def _title(html: str | None) -> str:
    """The crumb, the heading, a centred paragraph, or the article's first line: the first with four characters."""
    root = parse(html)

    def tries():
        for s in ("a.cs_dyk", "h1"):
            if node := root.first(s):
                yield node.text("", True), None
        for style, most in (("text-align:center", 200), ("text-align: center", None)):
            for p in root.select("p"):
                if style in p.attrs.get("style", ""):
                    yield p.text("", True), most
        if article := root.first(".div-article2"):
            yield article.text("\n", True).split("\n")[0].strip(), None

    return next((t for t, most in tries() if len(t) >= 4 and (most is None or len(t) <= most)), "")


def _file_url(html: str | None, base: str | None) -> str | None:
    """The first address of a PDF in a frame, an embedded object or a link, in this order."""
    root = parse(html)
    for tag, attr in (("iframe", "src"), ("embed", "src"), ("object", "data"), ("a", "href")):
        for node in root.select(tag):
            u = node.attrs.get(attr, "").strip()
            if ".pdf" in u.lower():
                return "https:" + u if u.startswith("//") else u if u.startswith("http") else urljoin(base or "", u)
    return None


_ANY_PDF = re.compile(r"""(?i)(https?://[^'"\s<>]+?\.pdf|/[^'"\s<>]+?\.pdf|[^'"\s<>]+?\.pdf)""")


def _file_links(html: str | None, base: str | None) -> list[str]:
    """Links that look like attachments, then bare addresses of PDFs: the first ten, each once."""
    hints = [k.lower() for k in V.PROBE_FILE]
    found = [urljoin(base or "", a.attrs["href"]) for a in parse(html).select("a") if a.attrs.get("href") and any(h in (a.attrs["href"] + " " + a.text(" ", True)).lower() for h in hints)]
    found = [u for u in found if not u.lower().startswith(("javascript:", "#"))] + [urljoin(base or "", m) for m in _ANY_PDF.findall(html or "")]
    return list(dict.fromkeys(found))[:10]


def _candidates(html: str | None) -> list[str]:
    """The names under the candidates' heading of the first table that has one."""
    heads = ("中标候选人名称", "中标候选人")
    for table in parse(html).select("table"):
        rows = list(table.select("tr"))
        if "gycq-table" in table.attrs.get("class", "") or len(rows) < 2:
            continue
        head = [c.text("", True) for c in (list(rows[0].select("th")) or list(rows[0].select("td")))]
        col = next((i for i, h in enumerate(head) if h in heads), None)
        if len(list(rows[0].select("td"))) + len(list(rows[0].select("th"))) <= 1 or col is None:
            continue
        cells = [list(r.select("td")) for r in rows[1:]]
        names = [c[col].text("", True) for c in cells if len(c) > col]
        names = list(dict.fromkeys(n for n in names if len(n) >= 2 and n not in (*heads, "名称", "排序", "序号")))
        if names:
            return names
    return []


def _region(html: str | None) -> str:
    """The region of a plan page's head line."""
    p = parse(html).first("p.cs_title_P3")
    m = re.search(r"信息来源[：:](.+?)(?:公共资源交易平台|交易中心)", p.text()) if p else None
    return m[1].strip() if m else ""


def _underlined_region(html: str | None) -> str:
    """The region that a notice underlines behind its label."""
    for node in parse(html).walk():
        if node.tag in ("u", "span", "p") and "招标项目所在地区" in node.text() and (u := node.first("u")):
            return _squeezed(u.text())
    return ""


def _probe_title(html: str | None) -> str:
    root = parse(html)
    return next((t for s in ("h1", "h2", ".title", ".article-title", "title") if (n := root.first(s)) and (t := _squeezed(n.text()))), "")


list_items = over(ITEMS, _items)
frame_items = over("array<struct<title:string,detail_url:string,bid_no:string,tender_method:string,deadline:string,publish_date:string>>", _frame_items)
table_pairs = over("map<string,string>", _pairs)
content_text = over("string", _content)
body_text = over("string", _body)
page_title = over("string", _title)
probe_title = over("string", _probe_title)
file_url = over("string", _file_url)
file_links = over("array<string>", _file_links)
candidate_names = over("array<string>", _candidates)
head_region = over("string", _region)
underlined_region = over("string", _underlined_region)
#: struct(text, source): a page's main text and the container it was found in.
main_content = over("struct<text:string,source:string>", _main)


def _decoded(body: bytes | None, charset: str | None) -> str:
    try:
        return (body or b"").decode("gb18030" if charset in ("gbk", "gb2312") else charset or "utf-8", "replace")
    except LookupError:
        return (body or b"").decode("utf-8", "replace")


#: The text of a page's bytes in a character set; what cannot be read in it is U+FFFD, and an unknown set counts as utf-8.
decoded = over("string", _decoded)


def file_ids(html: Column) -> Column:
    """(type, id) of the PDF behind a detail page, in either encoding of its address."""
    forms = [r"openFileById\?fileType%3D(\d+)%26id%3D([a-f0-9]+)", r"openFileById\?fileType=(\d+)&id=([a-f0-9]+)"]
    pick = lambda i: F.coalesce(*(F.nullif(F.regexp_extract(text(html), p, i), F.lit("")) for p in forms))
    return F.when(pick(2).isNotNull(), F.struct(pick(1).alias("type"), pick(2).alias("id")))


def total_pages(html: Column) -> Column:
    return F.coalesce(F.regexp_extract(text(html), r"(?U)共\s*<label>\s*(\d+)\s*</label>\s*页", 1).try_cast("int"), F.lit(1))


def publish_info(html: Column) -> Column:
    """Date and source that a page's head names."""
    date = F.regexp_extract(text(html), r"(?U)(?:发布|公告|公示)\s*(?:日期|时间)\s*[：:]\s*(\d{4}[-/]\d{2}[-/]\d{2}\s+\d{2}:\d{2}(?::\d{2})?)", 1)
    source = strip(F.regexp_extract(text(html), r"(?U)信息来源[：:]\s*([^\n<;]+)", 1))
    return F.struct(F.replace(date, F.lit("/"), F.lit("-")).alias("date"), source.alias("source"))


#: A shorter answer is a failure; items of a page.
LEAST_PAGE, PAGE_ITEMS = 100, 10


def list_rows(pages: DataFrame, counted: bool = False, since: Column | None = None, title: str = "") -> DataFrame:
    """Items of landed list pages (url, channel, page, html): title, canonical title, absolute link, date, place, kind by address.

    Rows without title or link are left out, as is a channel's rest behind its first page without an item; a failed page is one. With
    ``counted`` a page under ``LEAST_PAGE`` characters is a failure too, and a channel ends with the page that names no count, or by whose
    end the count is reached. ``since`` and ``title`` are the site's own filters: the day from which on, and what titles contain.
    """
    pages = pages.withColumn("items", list_items("html"))
    empty = F.size("items") == 0
    if counted:
        count = F.regexp_extract(text(F.col("html")), r",count:\s*(\d+)", 1).try_cast("int")
        done = F.coalesce(F.col("page") * PAGE_ITEMS >= count, F.lit(True))
        end = F.when(empty | (F.length(text(F.col("html"))) < LEAST_PAGE), F.col("page")).when(done, F.col("page") + 1)
    else:
        end = F.when(empty, F.col("page"))
    ends = pages.groupBy("channel").agg(F.min(end).alias("end"))
    rows = pages.join(ends, "channel", "left").where(F.col("end").isNull() | (F.col("page") < F.col("end")))
    # outer: Spark puts a test for items ahead of a plain explode, and with it the parsing, once more and on this side of any exchange
    rows = rows.select("channel", "page", F.posexplode_outer("items").alias("pos", "i")).select("channel", "page", "pos", "i.*")
    rows = rows.where("raw_title <> '' AND link <> ''").withColumn("link", secure_url(resolve(F.col("link"))))
    if since is not None:
        rows = rows.where(F.coalesce(list_date(F.col("date")) >= since, F.lit(True)))
    if title:
        rows = rows.where(F.contains("raw_title", F.lit(title)))
    return rows.withColumn("title", canonical_title(F.col("raw_title"))).withColumn("ann_type", url_kind(F.col("link")))


def api_rows(pages: DataFrame, item: str, page_size: int = 50, limit: int = 200) -> DataFrame:
    """Records of landed answers of a listing API (section, page, json), each ``annId`` once a section, at most ``limit`` of each.

    An answer is ``{"data": {"records": [item, ...], "total": n, "pages": n}}``. A section ends with the page that reaches its total or
    its number of pages, or that holds fewer than ``page_size`` records; what was landed behind it is left out."""
    a = pages.withColumn("d", F.from_json("json", f"data struct<records:array<{item}>,total:long,pages:long>")).select("section", "page", "d.data.*")
    n, total, of = F.size(F.coalesce("records", F.array())), F.coalesce("total", F.lit(0)), F.coalesce("pages", F.lit(0))
    last = (n < page_size) | ((total > 0) & (F.col("page") * page_size >= total)) | ((of > 0) & (F.col("page") >= of))
    ends = a.groupBy("section").agg(F.min(F.when(last, F.col("page"))).alias("end"))
    rows = a.join(ends, "section").where("end IS NULL OR page <= end").select("section", "page", F.posexplode("records").alias("pos", "r")).select("section", "page", "pos", "r.*")
    from noticeloom.operators.relations import first_k

    once = first_k(rows.where("annId IS NOT NULL"), ["section", "annId"], ["page", "pos"], 1)
    return first_k(once, ["section"], ["page", "pos"], limit)


def chosen_sections(keys: str = "") -> dict[str, tuple[str, str]]:
    """The sections named by a comma-separated list of keys, in the sections' own order; all of them without one."""
    wanted = {k.strip() for k in keys.split(",") if k.strip()}
    return {k: v for k, v in V.SECTIONS.items() if not wanted or k in wanted}


def section_links(html: Column, prefix: str) -> Column:
    """(detail_id, title, date text, place) of each link of a section's list page, without leaving the JVM."""
    anchor = rf"(?is)<a\s+[^>]*href=\"[^\"]*?/{prefix}/\d+\.jhtml\"[^>]*>.*?</a>"
    inner = lambda a: F.regexp_extract(a, r"(?is)^<a\s[^>]*>(.*)</a>$", 1)
    one = lambda a: F.struct(
        F.regexp_extract(a, rf"/{prefix}/(\d+)\.jhtml", 1).alias("detail_id"),
        strip(F.regexp_replace(inner(a), r"<[^>]+>", "")).alias("title"),
        F.regexp_extract(inner(a), r"\d{4}[/-]\d{2}[/-]\d{2}", 0).alias("date"),
        strip(F.regexp_extract(inner(a), r"\[(.*?)\]", 1)).alias("place"),
    )
    return F.filter(F.transform(F.regexp_extract_all(text(html), F.lit(anchor), F.lit(0)), one), lambda x: x["title"] != "")


def section_rows(pages: DataFrame, section: str, cutoff: Column) -> DataFrame:
    """Items of a section's list pages from ``cutoff`` on. A section is read up to and including its first page with an older item;
    undated items stay."""
    prefix = V.SECTIONS[section][1]
    rows = pages.select("page", F.posexplode(section_links(F.col("html"), prefix)).alias("pos", "i")).select("page", "pos", "i.*")
    rows = rows.withColumn("item_date", list_date(F.col("date"))).withColumn("old", F.coalesce(F.col("item_date") < cutoff, F.lit(False)))
    last = rows.where("old").agg(F.min("page").alias("last"))
    rows = rows.where("NOT old").crossJoin(F.broadcast(last)).where("last IS NULL OR page <= last")
    return rows.select("page", "pos", "detail_id", unescape(F.col("title")).alias("title"), "place", F.translate("date", "/", "-").alias("date"), detail_url(F.lit(section), F.col("detail_id")).alias("detail_url"))


def frame_rows(pages: DataFrame, per_group: int | None = None) -> DataFrame:
    """Items of framed list pages (section, category, page, html); at most ``per_group`` of each section and category, in page order."""
    # outer, as in list_rows: else pages are parsed twice
    rows = pages.select("section", "category", "page", F.posexplode_outer(frame_items("html")).alias("pos", "i")).where("pos IS NOT NULL").select("section", "category", "page", "pos", "i.*")
    if per_group is None:
        return rows
    from noticeloom.operators.relations import first_k

    return first_k(rows, ["section", "category"], ["page", "pos"], per_group)


def links(html: Column) -> Column:
    """All link targets, in order."""
    return F.regexp_extract_all(text(html), F.lit('<a href="([^"]*)"[^>]*>'), F.lit(1))


def visible_text(html: Column) -> Column:
    """Without scripts, styles, comments and tags, on one line."""
    t = F.regexp_replace(text(html), r"(?is)<script[^>]*>.*?</script>", " ")
    t = F.regexp_replace(F.regexp_replace(t, r"(?is)<style[^>]*>.*?</style>", " "), r"(?s)<!--.*?-->", " ")
    return squeeze(F.regexp_replace(t, r"<[^>]+>", " "))
