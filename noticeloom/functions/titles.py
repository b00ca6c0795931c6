"""Kinds of notices, by ordered rules, and canonical titles."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from noticeloom.functions import vocabulary as V
from noticeloom.functions.text import has_any, hits, inline, strip, text


def title_kind(title: Column, old: bool = False) -> Column:
    """skip, terminate, amendment, result, candidate, notice or unknown: the first kind with a word in the title."""
    words = lambda ws: [w for w in ws if not old or w not in V.NEW_KEYWORDS]
    return F.coalesce(*(F.when(has_any(title, words(ws)), F.lit(k)) for k, ws in V.TITLE_KINDS), F.lit("unknown"))


def kind_label(title: Column, kind: Column | None = None) -> Column:
    """What a notice is called in a project's history."""
    kind = title_kind(title) if kind is None else F.when(text(kind) == "", title_kind(title)).otherwise(kind)
    own = lambda words, last: F.coalesce(*(F.when(F.contains(text(title), F.lit(w)), F.lit(x)) for w, x in words), F.lit(last))
    return F.coalesce(*(F.when(kind == k, own(words, last)) for k, (words, last) in V.KIND_LABELS.items()), F.lit(V.UNKNOWN_LABEL))


def routed_kind(title: Column, channel: Column) -> Column:
    """A notice's kind as its channel routes it: in the amendment channel an unknown title is an amendment, in the channels of
    candidates and results the title only decides on skipping, in the plan channel not even that."""
    kind = title_kind(title)
    return (
        F.when(channel == "招标计划", "plan")
        .when(kind == "skip", "skip")
        .when(channel == "中标候选人", "candidate")
        .when(channel == "中标结果", "result")
        .when((channel == "变更公告") & (kind == "unknown"), "amendment")
        .otherwise(kind)
    )


def _cut(c: Column, suffixes: list[str]) -> Column:
    """Without the first of ``suffixes``, in their order, that ends the text."""
    return F.coalesce(*(F.when(F.endswith(c, F.lit(s)), strip(F.substring(c, F.lit(1), F.length(c) - len(s)))) for s in suffixes), c)


def canonical_title(title: Column) -> Column:
    """A project's name: the title without the suffixes of notices, as many as end it, and without the lot's number."""
    start = inline(title)
    # of suffixes that end a text, a longer one that ends in a listed shorter one never gets its turn
    first = [s for i, s in enumerate(V.TITLE_SUFFIXES) if not any(s.endswith(t) for t in V.TITLE_SUFFIXES[:i])]
    t = strip(F.regexp_replace(start, rf"(?U)(?:\s*(?:{'|'.join(first)}))+$", ""))
    for lot in (r"（?\(?第?\d+(?U:\s)*标段\)?）?$", r"\(?\d+(?U:\s)*标段\)?$", r"其它第一标段$"):
        t = strip(F.regexp_replace(t, lot, ""))
    return F.when(t == "", start).otherwise(t)


def canonical_title_old(title: Column) -> Column:
    """The older form: one suffix, the first listed one that ends the title."""
    return _cut(strip(text(title)), V.OLD_TITLE_SUFFIXES)


def page_kind(html: Column) -> Column:
    """The kind of a page by its first 8,000 characters without tags."""
    t = F.substring(F.regexp_replace(text(html), r"<[^>]+>", ""), 1, 8000)
    return F.coalesce(*(F.when(F.contains(t, F.lit(w)), F.lit(k)) for w, k in V.PAGE_KINDS), F.lit(""))


def subtype(section: Column, title: Column, ann_class: Column, ann_type: Column, nature: Column) -> Column:
    """The record type of a JSON detail: by its codes, by its title where codes are lacking."""
    code = lambda c: strip(text(c))
    result = (section == "gs") | (code(ann_class) == "3")
    return (
        F.when(section == "zbgg_zys", F.when((code(ann_type) == "3") | ((code(ann_type) == "") & F.contains(text(title), F.lit("资格预审"))), "zbys").otherwise("zbgg"))
        .when((section == "hxr") | (code(ann_class) == "2"), "hxr")
        .when(result & has_any(title, V.CORRECTIONS), "gzjg")
        .when(result & has_any(title, ["中标结果", "中标人"]), "zbjg")
        .when(result & code(nature).isin("4", "5"), "gzjg")
        .when(result, "zbjg")
        .otherwise("")
    )


def needs_login(body: Column, url: Column) -> Column:
    n, m = hits(body, V.PROBE_LOGIN, True), hits(body, V.PROBE_NOTICE, True)
    return has_any(F.lower(text(url)), ["login", "signin", "sso", "oauth"]) | ((n >= 2) & (m == 0)) | (n >= 3)


def is_risky(body: Column) -> Column:
    return has_any(F.lower(text(body)), [w.lower() for w in V.PROBE_RISK])


def verdict(status: Column, body: Column, url: Column, html: Column, length: Column, has_access: bool = False) -> Column:
    """Whether and how a page's fields can be read: the first rule that holds."""
    notice, fields = hits(body, V.PROBE_NOTICE), hits(body, V.PROBE_FIELD)
    return (
        F.when(is_risky(body), "不可爬/暂不可爬")
        .when(F.lit(not has_access) & needs_login(body, url), "可爬-需Cookie/登录态")
        .when(status.isin(401, 403), "可爬-需Cookie/登录态")
        .when(status >= 400, "未测试-详情页状态异常")
        .when((length >= 300) & (notice >= 1) & (fields >= 2), "可爬-详情HTML可直接提取")
        .when((length >= 500) & (fields >= 3), "可爬-详情HTML可直接提取")
        .when((hits(html, V.PROBE_FILE, True) > 0) & (length < 300), "可爬-PDF/附件型")
        .when((hits(html, V.PROBE_API, True) > 0) & (length < 300), "条件可爬-需接口分析或浏览器渲染")
        .otherwise("不确定-详情正文不足")
    )


def file_verdict(url: Column, status: Column, content_type: Column, head: Column) -> Column:
    """What came of a page's first attachment."""
    s = status.cast("string")
    return (
        F.when(url.isNull(), "无PDF链接")
        .when(status.isNull(), "PDF请求失败")
        .when((status == 200) & (F.contains(text(F.decode(head, "ISO-8859-1")), F.lit("%PDF")) | F.contains(F.lower(text(content_type)), F.lit("pdf"))), F.concat(F.lit("PDF可下载："), url))
        .when(status.isin(401, 403), F.concat(F.lit("PDF需要登录/无权限：HTTP "), s))
        .otherwise(F.concat(F.lit("PDF疑似不可直接下载：HTTP "), s, F.lit(", Content-Type="), text(content_type)))
    )
