"""What is empty, what is complete, and what a run has done."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from noticeloom.functions import vocabulary as V
from noticeloom.functions.text import first_of, has_any, is_missing, text


def issues(projects: DataFrame, distinct: bool = False) -> DataFrame:
    """(项目名称, pos, issue): fields that a project's notices should have given and did not. A project with both a notice and an award can
    lack a field twice; ``distinct`` names it once."""
    lacks = lambda kinds, fields: [F.when(has_any(F.col("公告类型"), kinds) & is_missing(F.col(f)), F.lit(f"{f}未提取")) for f in fields]
    every = F.filter(F.array(*lacks(["招标公告", "资格预审公告"], V.NOTICE_REQUIRED), *lacks(["中标候选人公示", "中标结果公示"], V.AWARD_REQUIRED)), lambda x: x.isNotNull())
    return projects.select("项目名称", F.posexplode(F.array_distinct(every) if distinct else every).alias("pos", "issue"))


def issues_old(projects: DataFrame) -> DataFrame:
    """The older rule: a page is linked and its field is missing."""
    # Link columns and what their pages give.
    rules = [("招标公告链接", "投标人资格要求"), ("招标公告链接", "招标文件获取时间"), ("中标候选人公示链接", "中标候选人名称"), ("中标结果公示链接", "中标人")]
    every = F.filter(F.array(*(F.when(~is_missing(F.col(a)) & is_missing(F.col(b)), F.lit(f"{b}未提取")) for a, b in rules)), lambda x: x.isNotNull())
    return projects.select("项目名称", F.posexplode(every).alias("pos", "issue"))


def unknown_titles(items: DataFrame) -> DataFrame:
    """Notices whose title names no kind, in the channels where that matters."""
    return items.where((F.col("kind") == "unknown") & (F.col("channel") == "招标公告")).select("raw_title", "link")


def _counted(rows: DataFrame, value: Column, column: str, order: str | None, ranked: str | None) -> DataFrame:
    """Most frequent first; equal counts in the order in which they are first seen (by ``order``), else by name. ``ranked``: a column that says which."""
    first = F.min(order) if order else F.min(value)
    got = rows.groupBy(value.alias(column)).agg(F.count("*").alias("n"), first.alias("_first"))
    if ranked:
        # all that the one window sees is a row for each value
        return got.select(column, "n", F.row_number().over(Window.orderBy(F.desc("n"), "_first")).cast("long").alias(ranked))
    return got.orderBy(F.desc("n"), "_first").drop("_first")


def kind_counts(rows: DataFrame, column: str = "公共类型", default: str = "未识别", order: str | None = None, ranked: str | None = None) -> DataFrame:
    return _counted(rows, first_of(text(F.col(column)), F.lit(default)), column, order, ranked)


def place_counts(rows: DataFrame, column: str = "交易场所", order: str | None = None, ranked: str | None = None) -> DataFrame:
    """An absent place has a name; an empty one stays empty."""
    return _counted(rows, F.coalesce(F.col(column), F.lit("未知")), column, order, ranked)


def _long(rows: DataFrame, fields: list[str], measure) -> DataFrame:
    """One aggregation over all fields at once, then a row for each."""
    sums = rows.agg(F.count("*").alias("total"), *(F.coalesce(F.sum(measure(F.col(f"`{f}`")).cast("long")), F.lit(0)).alias(f"_{i}") for i, f in enumerate(fields)))
    return sums.select("total", F.explode(F.array(*(F.struct(F.lit(i).alias("ordinal"), F.lit(f).alias("field"), F.col(f"_{i}").alias("n")) for i, f in enumerate(fields)))).alias("x")).select("x.*", "total")


def fill_rates(rows: DataFrame, fields: list[str] | None = None) -> DataFrame:
    """Incomplete fields with their non-empty count and percentage, fewest first."""
    got = _long(rows, fields or V.SECTION_FIELDS, lambda c: text(c) != "").where("n < total")
    return got.select("field", "n", "total", F.round(F.col("n") * 100.0 / F.col("total"), 0).alias("percent"), "ordinal").orderBy("n", "ordinal").drop("ordinal")


def blanks(rows: DataFrame, fields: list[str]) -> DataFrame:
    return _long(rows, fields, lambda c: F.trim(text(c)) == "").select("field", F.col("n").alias("empty"), "total")


def before_after(original: DataFrame, repaired: DataFrame, skip: tuple[str, ...] = ("全文文本",)) -> DataFrame:
    """Empty fields before and after a repair, for fields that were blank somewhere, sorted by name."""
    fields = [c for c, t in original.dtypes if t == "string" and c not in skip]
    old = blanks(original, fields).where("empty > 0")
    new = blanks(repaired, [c for c in fields if c in repaired.columns]).select("field", F.col("empty").alias("after"))
    return old.join(new, "field", "left").select("field", F.col("empty").alias("before"), F.coalesce("after", "empty").alias("after"), "total", (F.col("empty") - F.coalesce("after", "empty")).alias("fixed")).orderBy("field")


def status_counts(rows: DataFrame, column: str = "status", mode: str = "source_mode") -> DataFrame:
    """Successes, part successes, failures and skips, of this run and of history."""
    s = F.col(column)
    n = lambda test: F.count_if(F.coalesce(test, F.lit(False)))
    aggs = [F.count("*").alias("total"), n(s == "成功").alias("success"), n(s == "部分成功").alias("part"), n(F.startswith(s, F.lit("失败"))).alias("failed"), n(F.startswith(s, F.lit("跳过"))).alias("skipped")]
    return rows.groupBy(mode).agg(*aggs) if mode in rows.columns else rows.agg(*aggs)


def token_totals(calls: DataFrame) -> DataFrame:
    """Calls and tokens (phase, prompt_tokens, completion_tokens) of each phase."""
    z = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    return calls.groupBy("phase").agg(F.count("*").alias("calls"), z("prompt_tokens").alias("prompt_tokens"), z("completion_tokens").alias("completion_tokens"), (z("prompt_tokens") + z("completion_tokens")).alias("total_tokens"))


def run_counters(items: DataFrame) -> DataFrame:
    """Listed, parsed, inserted and too old items of each section and page."""
    n = lambda c: F.coalesce(F.sum(F.col(c).cast("long")), F.lit(0))
    return items.groupBy("section", "page").agg(F.count("*").alias("listed"), n("parsed").alias("parsed"), n("inserted").alias("inserted"), n("old").alias("old"))


def text_choice(said: Column, given: Column) -> Column:
    """Which of two lists of prices to keep: the text's if the source gives none or the text's are longer by more than five characters in all."""
    size = lambda a: F.aggregate(F.coalesce(a, F.array()), F.lit(0), lambda n, x: n + F.length(x))
    return F.when((size(given) == 0) | (size(said) > size(given) + 5), said).otherwise(given)


def index_lines(projects: DataFrame, ordinal: Column) -> DataFrame:
    """One block of text for each project."""
    # The lines of a block.
    rows = [["公告类型"], ["发布日期"], ["所属行业", "组织形式"], ["开标时间", "标书发售时间"], ["招标人", ("联系人", "招标人联系人"), ("电话", "招标人联系方式")], ["监督部门", ("电话", "监督部门联系方式")], ["公告历史"]]
    pair = lambda x: x if isinstance(x, tuple) else (x, x)
    each = [F.concat(F.lit("  "), F.concat_ws(" | ", *(F.concat(F.lit(f"{a}: "), F.col(b)) for a, b in map(pair, r)))) for r in rows]
    return projects.select(F.concat_ws("\n", F.concat(F.lit("["), ordinal.cast("string"), F.lit("] "), F.col("项目名称")), *each, F.lit("")).alias("value"))


def report_lines(records: DataFrame) -> DataFrame:
    """One block of text for each record of a model's run (project, link, fields, status, values as a map)."""
    cut = lambda v: F.when(F.length(v) > 100, F.concat(F.substring(v, 1, 100), F.lit("..."))).otherwise(v)
    values = F.transform(F.map_entries("values"), lambda e: F.concat(F.lit("  - "), e["key"], F.lit(": "), cut(e["value"])))
    return records.select(F.concat_ws("\n", F.concat(F.lit("项目: "), F.col("project")), F.concat(F.lit("  链接: "), F.col("link")), F.concat(F.lit("  目标字段: "), F.array_join("fields", ", ")), F.concat(F.lit("  结果: "), F.col("status")), values, F.lit("")).alias("value"))


def union_all(frames: list[DataFrame]) -> DataFrame:
    """Rows of sections or pages one after another; columns that one lacks are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
