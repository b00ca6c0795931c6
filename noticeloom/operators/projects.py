"""Notices into projects: matching by name, history by stages, merging by per-column rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from noticeloom.functions import vocabulary as V
from noticeloom.functions.text import first_of, inline, is_missing, present, strip, text
from noticeloom.functions.titles import kind_label, routed_kind, title_kind
from noticeloom.functions.values import ordered_set, publish_cell, publish_part

#: Stages of a project's life in the order in which their values are merged.
STAGES = {"招标计划": 1, "招标公告": 2, "变更公告": 3, "中标候选人": 4, "中标结果": 5}
MIN_NAME = 5


def _windows(c: Column, n: int) -> Column:
    """The distinct windows of ``n`` characters; none of shorter texts."""
    return F.when(F.length(c) >= n, F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(c) - (n - 1)), lambda i: F.substring(c, i, F.lit(n)))))


def _dealt(rows: DataFrame) -> DataFrame:
    """``rows`` as the side of a join that both sides are shuffled for: Spark takes texts put together, and windows, for a tenth of their size and less,
    and would send them to the driver and to every executor."""
    return rows.hint("merge")


def containing(inner: DataFrame, outer: DataFrame, i: str, o: str, n: int) -> DataFrame:
    """Pairs of distinct texts (columns ``i`` of ``inner`` and ``o`` of ``outer``) where the outer one contains the inner one of ``n`` characters
    or more.

    A containing text has every window of the contained one. Each inner text is looked up by that of its windows which the fewest outer
    texts have, so a beginning that all names share finds nobody; one with a window that no outer text has is out at once.
    """
    own = inner.select(i).distinct().withColumn("w", F.explode(_windows(F.col(i), n)))
    other = outer.select(o).distinct().withColumn("w", F.explode(_windows(F.col(o), n)))
    counts = other.groupBy("w").agg(F.count("*").alias("c"))
    rarest = own.join(_dealt(counts), "w", "left").groupBy(i).agg(F.min(F.struct(F.coalesce("c", F.lit(0)).alias("c"), "w")).alias("r")).where("r.c > 0").select(i, F.col("r.w").alias("w"))
    return rarest.join(_dealt(other), "w").where(F.contains(F.col(o), F.col(i))).select(i, o)


def blocked_matches(probes: DataFrame, names: DataFrame, probe: str, name: str, ordinal: str) -> DataFrame:
    """``probe`` -> ordinal of the matching name: the equal one, else the first in order of which one contains the other (both of
    five characters or more)."""
    p = probes.select(inline(F.col(probe)).alias("p")).distinct()
    n = names.select(F.col(name).alias("n"), F.col(ordinal).alias("o")).groupBy("n").agg(F.min("o").alias("o"))
    exact = p.join(_dealt(n), p["p"] == n["n"]).select("p", "o")
    rest = p.join(_dealt(exact.select("p")), "p", "left_anti")
    pairs = containing(rest, n, "p", "n", MIN_NAME).unionByName(containing(n, rest, "n", "p", MIN_NAME))
    near = pairs.join(_dealt(n), "n").groupBy("p").agg(F.min("o").alias("o"))
    return exact.unionByName(near).select(F.col("p").alias(probe), F.col("o").alias(ordinal))


def merged_value(c: str, order: Column, keep_first: bool) -> Column:
    """The first or the last value that is not missing, in ``order``."""
    pick = F.min_by if keep_first else F.max_by
    return pick(present(F.col(c)), F.when(~is_missing(F.col(c)), order)).alias(c)


def in_order(c: Column, order: Column) -> Column:
    """A group's values as an array in ``order``."""
    return F.transform(F.array_sort(F.collect_list(F.struct(order.alias("o"), c.alias("v")))), lambda x: x["v"])


def project_rows(history: DataFrame, fields: list[str] | None = None) -> DataFrame:
    """Project rows from notices (project, channel, pos, raw_title, link, date, kind, and the parsed fields).

    Of plan, notice, candidates and result only the first item of a project is merged into its fields, amendments into none;
    labels, dates and links of all items but further plans and notices are collected, each once. ``kind`` is the triggering notice's,
    or null for history.
    """
    fields = [c for c in (fields or V.PROJECT_COLUMNS) if c in history.columns and c not in V.AGGREGATED]
    stage = F.coalesce(*(F.when(F.col("channel") == k, F.lit(v)) for k, v in STAGES.items()), F.lit(9))
    own = {1: "plan", 2: "notice", 3: "amendment", 4: "candidate", 5: "result"}
    rows = history.withColumn("_stage", F.when(F.col("kind").isNotNull(), F.lit(6)).otherwise(stage))
    rows = rows.where((F.col("_stage") != 2) | (title_kind(F.col("raw_title")) == "notice"))
    first = F.row_number().over(Window.partitionBy("project", "_stage").orderBy("pos")) == 1
    rows = rows.withColumn("_first", first | (F.col("_stage") >= 6)).where(F.col("_first") | ~F.col("_stage").isin(1, 2))
    kind = F.coalesce(F.col("kind"), *(F.when(F.col("_stage") == k, F.lit(v)) for k, v in own.items()))
    rows = rows.withColumn("_label", kind_label(F.col("raw_title"), kind)).withColumn("_order", F.struct("_stage", "pos"))
    used = F.col("_first") & (F.col("_stage") != 3)
    rows = rows.withColumns({c: F.when(used, F.col(c)) for c in fields})
    o = F.col("_order")
    cells = {
        "公告类型": ordered_set(in_order(F.col("_label"), o)),
        "发布日期": ordered_set(in_order(publish_part(F.col("_label"), F.col("date")), o)),
        "公告历史": ordered_set(in_order(F.concat(text(F.col("raw_title")), F.lit("|"), text(F.col("link"))), o)),
    }
    got = rows.groupBy("project").agg(*(merged_value(c, o, c in V.KEEP_FIRST) for c in fields if c != "项目名称"), *(c.alias(k) for k, c in cells.items()))
    return as_projects(got.withColumnRenamed("project", "项目名称"))


def as_projects(rows: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """The table's columns in order, missing ones with the default, the cell of dates cleaned."""
    columns = columns or V.PROJECT_COLUMNS
    fixed = {"发布网站": F.lit(V.SITE_NAME), "依据文件": F.lit(V.DEFAULT), "依据文号": F.lit(V.DEFAULT)}
    default = F.lit(V.DEFAULT if "公告类型" in columns else V.OLD_DEFAULT)
    cell = lambda c: publish_cell(F.col(c)) if c == "发布日期" else F.coalesce(present(F.col(c)), fixed.get(c, default))
    return rows.select(*((cell(c) if c in rows.columns else fixed.get(c, default)).alias(c) for c in columns))


def upsert(snapshot: DataFrame, new: DataFrame, mode: str = "replace", key: str = "项目名称") -> DataFrame:
    """The next snapshot. ``replace``: a project's new row takes the old one's place; ``fill``: only blanks of the old row are filled, and
    the collected cells grow; ``merge``: new values win except in columns that keep their first."""
    columns = snapshot.columns
    both = snapshot.select(F.col(key).alias("_k"), *(F.col(c).alias(f"o_{i}") for i, c in enumerate(columns))).join(new.select(F.col(key).alias("_k"), *(F.col(c).alias(f"n_{i}") for i, c in enumerate(columns)), F.lit(True).alias("_new")), "_k", "full_outer")

    def cell(i: int, c: str) -> Column:
        old, now = F.col(f"o_{i}"), F.col(f"n_{i}")
        if mode == "replace":
            got = F.when(F.col("_new"), now).otherwise(old)
        elif c in V.AGGREGATED or c in V.OLD_APPENDED:
            got = ordered_set(F.concat(F.split(text(old), "；"), F.split(text(now), "；")))
        elif mode == "fill" or c in V.KEEP_FIRST:
            got = F.coalesce(present(old), present(now), F.lit(V.DEFAULT))
        else:
            got = F.coalesce(present(now), present(old), F.lit(V.DEFAULT))
        return F.col("_k").alias(c) if c == key else got.alias(c)

    return both.select(*(cell(i, c) for i, c in enumerate(columns)))


def aligned(new: DataFrame, snapshot: DataFrame, ordinal: str, key: str = "项目名称") -> DataFrame:
    """New rows under the name that the snapshot knows them by. Rows are matched with the previous snapshot only, not with each other: containment is
    not transitive, so an order-dependent chain of matches has no counterpart in a set of rows."""
    named = snapshot.select(F.col(ordinal), F.col(key).alias("_known"))
    hit = blocked_matches(new, snapshot, key, key, ordinal).join(_dealt(named), ordinal).select(F.col(key).alias("_probe"), "_known")
    got = new.join(_dealt(hit), inline(new[key]) == hit["_probe"], "left")
    return got.select(*(F.coalesce("_known", new[key]).alias(c) if c == key else new[c] for c in new.columns))


#: Fixed value: how many days back a project's history is searched.
HISTORY_DAYS = 4000


def history_of(projects: DataFrame, notices: DataFrame, from_step: int = 1, today: Column | None = None, days: int = HISTORY_DAYS, date: str = "date") -> DataFrame:
    """Notices of every project: those whose title contains its name of four characters or more (the site's search), of the stages from
    ``from_step`` on; a notice of a channel without a stage comes with every step. With ``today``, those of the last ``days`` days; a notice whose
    ``date`` is missing or cannot be read stays."""
    if today is not None:
        day = F.col(date).try_cast("date")
        notices = notices.where(day.isNull() | (day >= F.date_sub(today, days)))
    stage = F.coalesce(*(F.when(F.col("channel") == k, F.lit(v)) for k, v in STAGES.items()), F.lit(9)) if from_step > 1 else None
    own = notices if stage is None else notices.where(stage >= from_step)
    pairs = containing(projects.select(F.col("项目名称").alias("project")), own.select(F.col("raw_title").alias("_title")), "project", "_title", 4)
    return own.join(_dealt(pairs), own["raw_title"] == pairs["_title"]).select("project", *own.columns)


def triggers(items: DataFrame) -> DataFrame:
    """Listed notices with their routed kind; control prices are left out."""
    return items.withColumn("kind", routed_kind(F.col("raw_title"), F.col("channel"))).where("kind <> 'skip'")


def best_link(history: Column, fields: Column) -> Column:
    """The page on which missing fields are looked for: the first notice if a notice's field is missing, else the first candidates' or
    result page, else the first page."""
    parts = F.filter(F.transform(F.split(text(history), "；"), lambda x: strip(x)), lambda x: F.contains(x, F.lit("|")))
    items = F.transform(parts, lambda x: F.struct(title_kind(strip(F.substring_index(x, "|", 1))).alias("kind"), strip(F.substring(x, F.instr(x, "|") + 1, F.length(x))).alias("link")))
    pages = F.filter(items, lambda x: F.startswith(x["link"], F.lit("http")))
    one = lambda keep: F.get(F.filter(pages, keep), F.lit(0))["link"]
    notice = F.when(F.arrays_overlap(fields, F.array(*map(F.lit, V.NOTICE_REQUIRED))), one(lambda x: x["kind"] == "notice"))
    return F.when(is_missing(history), F.lit("")).otherwise(F.coalesce(notice, one(lambda x: x["kind"].isin("candidate", "result")), one(lambda x: F.lit(True)), F.lit("")))


def fields_by_page(issues: DataFrame) -> DataFrame:
    """Issues (project, link, field) by page, so that each page is parsed once."""
    return issues.groupBy("project", "link").agg(F.array_sort(F.collect_set("field")).alias("fields"))


def applied(rows: DataFrame, wanted: Column, extracted: Column, title: str = "title") -> DataFrame:
    """Success and missing fields of an extraction (a map), and its status."""
    name = first_of(text(extracted["项目名称"]), text(F.col(title)))
    has = lambda f: F.when(f == "项目名称", name != "").otherwise(strip(text(F.get(F.transform(F.array(f), lambda k: extracted[k]), F.lit(0)))) != "")
    good, bad = F.filter(wanted, has), F.filter(wanted, lambda f: ~has(f))
    status = F.when((F.size(good) > 0) & (F.size(bad) == 0), "成功").when(F.size(good) > 0, "部分成功").otherwise("失败")
    return rows.select("*", good.alias("success_fields"), bad.alias("missing_fields"), F.when(F.col("kind") == "skip", "跳过").when(F.col("kind") == "unknown", "失败").otherwise(status).alias("status"))
