"""Model-based classification and extraction as a seam: any callable, injected; offline the rules stand in for it.

A model sees rows in batches inside ``mapInPandas``. Answers are taken leniently (code fences, text around the braces) and only non-empty values of
declared fields are used.
"""

from __future__ import annotations

import json
import re
import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, MapType, StringType, StructField, StructType

from noticeloom.functions.text import first_of, is_missing, text
from noticeloom.functions.titles import title_kind
from noticeloom.sources.writers import landed


Model = Callable[[str], str]
KINDS = ["skip", "terminate", "amendment", "result", "candidate", "notice", "plan", "unknown"]


def lenient_json(answer: str | None) -> dict:
    """The object in a model's answer; empty if there is none."""
    t = re.sub(r"\s*```$", "", re.sub(r"^```(?:json)?\s*", "", (answer or "").strip()))
    for part in (t, *re.findall(r"\{.*\}", t, re.S)):
        try:
            got = json.loads(part)
        except ValueError:
            continue
        if isinstance(got, dict):
            return got
    return {}


def _ask(model: Model, prompt: str, retries: int, pace: float) -> tuple[dict, int]:
    for n in range(1, retries + 2):
        try:
            if pace:
                time.sleep(pace)
            if got := lenient_json(model(prompt)):
                return got, n
        except Exception as e:  # noqa: BLE001  a model's failure is an outcome to report, not an end of the job
            if n > retries:
                return {"_error": type(e).__name__}, n
    return {}, retries + 1


def model_kinds(items: DataFrame, model: Model | None = None, retries: int = 2, pace: float = 0.0) -> DataFrame:
    """Items (link, raw_title) with kind, confidence and calls. Labels outside the closed set are unknown; without a model the title's rules decide."""
    if model is None:
        return items.withColumns({"kind": title_kind(F.col("raw_title")), "confidence": F.lit(1.0), "calls": F.lit(0).cast("long")})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            got = [_ask(model, f"{json.dumps(KINDS)}\n{t}", retries, pace) for t in b["raw_title"]]
            yield b.assign(kind=[a.get("type") if a.get("type") in KINDS else "unknown" for a, _ in got], confidence=[float(a.get("confidence") or 0) for a, _ in got], calls=[n for _, n in got])

    return items.mapInPandas(run, StructType([*items.schema.fields, StructField("kind", StringType()), StructField("confidence", DoubleType()), StructField("calls", LongType())]))


def rerouted(items: DataFrame, model: Model | None = None, retries: int = 2, pace: float = 0.0) -> DataFrame:
    """Listed items (raw_title, link, kind, ...) to merge: those whose title names a kind, and of the others those for which a model does.
    What is to be skipped, or unknown to both, is left out."""
    unknown = items.where("kind = 'unknown'").drop("kind")
    answered = model_kinds(unknown, model, retries, pace).select(*items.columns)
    return items.where("kind <> 'unknown'").unionByName(answered).where("kind NOT IN ('skip', 'unknown')")


def model_fields(pages: DataFrame, model: Model, retries: int = 2, pace: float = 0.0) -> DataFrame:
    """Pages (project, link, text, fields) with ``values``, the non-empty answers among the fields asked for; lists are joined."""

    def clean(v) -> str:
        return "、".join(str(x).strip() for x in v if x) if isinstance(v, list) else "" if v is None else str(v).strip()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            got = [_ask(model, json.dumps({"fields": list(f), "text": t or ""}, ensure_ascii=False), retries, pace)[0] if t and len(f) else {} for t, f in zip(b["text"], b["fields"], strict=True)]
            yield b.assign(values=[{k: c for k in f if (c := clean(a.get(k)))} for a, f in zip(got, b["fields"], strict=True)])

    return pages.mapInPandas(run, StructType([*pages.schema.fields, StructField("values", MapType(StringType(), StringType()))]))


def answered(asked: DataFrame, model: Callable, store: str, version: str, rate: float = 0.0, tasks: int = 8, round_size: int = 200, retries: int = 2) -> DataFrame:
    """``asked`` (phase, prompt) with key, answer, error, calls, prompt_tokens and completion_tokens: each distinct prompt of a version is asked once.

    Answers are kept in the table ``store`` under the SHA-256 of version and prompt; what it holds is not asked again, in this run or a
    later one. New prompts are asked in rounds of ``round_size``, each written down before the next begins: what a lost task or a broken run
    has to ask again is at most its own part of one round. ``rate`` is calls a second of the whole run: each of ``tasks`` tasks keeps to its share.
    ``model`` returns its answer, or that and its token usage as a dict; an answer that failed after all tries has an error and is asked again next time.
    """
    spark = asked.sparkSession
    keyed = asked.withColumn("key", F.sha2(F.concat_ws("\x00", F.lit(version), F.col("prompt")), 256))
    out = "key string, answer string, error string, calls long, prompt_tokens long, completion_tokens long"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for key, prompt in zip(b["key"], b["prompt"], strict=True):
                answer, error, usage, n = None, None, {}, 0
                while answer is None and n <= retries:
                    n += 1
                    if rate:
                        time.sleep(tasks / rate)
                    try:
                        got = model(prompt or "")
                        answer, usage = got if isinstance(got, tuple) else (got, {})
                    except Exception as e:  # noqa: BLE001  a model's failure is an outcome to report
                        error = type(e).__name__
                rows.append((key, answer, error if answer is None else None, n, int(usage.get("prompt_tokens", 0)), int(usage.get("completion_tokens", 0))))
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in out.split(", ")])

    known = landed_rows(spark, store, out)
    todo = landed(keyed.where("prompt IS NOT NULL").select("key", "prompt").distinct().join(known.select("key"), "key", "left_anti"), "asked")
    # rounds are ranges of keys, which are hashes: about equal, whatever the prompts
    n_rounds = max(1, -(-todo.count() // round_size))
    part = F.floor(F.conv(F.substring("key", 1, 8), 16, 10).cast("long") * n_rounds / F.lit(1 << 32))
    for i in range(n_rounds):
        got = todo.where(part == i).repartition(tasks, "key").mapInPandas(run, out)
        got = landed(got, "answers")
        got.where("error IS NULL").write.mode("append").parquet(store)
        failed = got.where("error IS NOT NULL") if i == 0 else failed.unionByName(got.where("error IS NOT NULL"))
    every = landed_rows(spark, store, out).dropDuplicates(["key"]).unionByName(failed)
    return keyed.join(every, "key", "left")


def landed_rows(spark, path: str, ddl: str) -> DataFrame:
    """The rows of an append-only table; none where it has not been written yet."""
    try:
        return spark.read.schema(ddl).parquet(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], ddl)


def usage(answers: DataFrame) -> DataFrame:
    """What ``answered`` cost by phase, as ``audit.token_totals`` takes it: a prompt asked in several phases is a cost of the first by name."""
    one = answers.where("calls IS NOT NULL").groupBy("key").agg(F.min("phase").alias("phase"), F.first("prompt_tokens").alias("prompt_tokens"), F.first("completion_tokens").alias("completion_tokens"))
    return one.select("phase", "prompt_tokens", "completion_tokens")


def supplemented(projects: DataFrame, answers: DataFrame, key: str = "项目名称") -> DataFrame:
    """Missing fields filled from the answers (project, values); what is there stays."""
    one = answers.withColumn("_o", F.to_json("values"))
    got = one.groupBy("project").agg(F.min_by("values", "_o").alias("_values"))
    both = projects.join(got, projects[key] == got["project"], "left")
    pick = lambda c: F.when(is_missing(F.col(c)) & (text(F.col("_values")[c]) != ""), F.col("_values")[c]).otherwise(F.col(c))
    return both.select(*(F.col(c) if c == key else pick(c).alias(c) for c in projects.columns))


def chosen_text(pages: DataFrame, pdf_text: str = "pdf_text", ocr_text: str = "ocr_text", html_text: str = "html_text", enough: int = 500) -> DataFrame:
    """The text to extract from: a PDF's own if it has one and enough of it, else what was read off its pages, else the page's."""
    pdf, ocr = text(F.col(pdf_text)), text(F.col(ocr_text))
    return pages.withColumn("text", first_of(F.when(F.length(pdf) >= enough, pdf).otherwise(first_of(ocr, pdf)), text(F.col(html_text))))


def with_history(seed: DataFrame, history: DataFrame) -> DataFrame:
    """The items to process: those of this run and, one level deep, their projects' others; each link once, this run's first."""
    both = seed.withColumn("source_mode", F.lit("current")).unionByName(history.withColumn("source_mode", F.lit("history")), allowMissingColumns=True)
    one = both.groupBy("link").agg(F.min_by(F.struct(*both.columns), F.when(F.col("source_mode") == "current", 0).otherwise(1)).alias("r"))
    return one.select("r.*")
