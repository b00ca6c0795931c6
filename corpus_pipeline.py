"""The corpus pipeline: five stages over ``documents``, each by one operator of ``noticeloom.llm``.

A stage takes ``(spark, docs, sf_dir)`` and works on all rows its predecessor kept. All but the last return the columns of
``documents``; between stages the rows are written as Parquet and read again, so a lost executor costs one stage's work at most.
Nulls, empty texts and repeated rows are treated as each operator states; repeated rows (equal id and text) leave the second
stage once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from noticeloom.llm import decontam, exactdup, mixing, neardup, toxicity
from noticeloom.llm._common import discard, map_rows, materialise, quoted, table, unused, without


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: documents with a score of 0.7 or more go. Null and empty texts are scored as empty ones and repeated rows each for itself;
    rows without an id are scored, and not learned from; an empty table stays empty, as the model then calls nothing toxic."""
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), ~toxicity.is_held_out())
    verdict = unused(docs, "is_toxic")
    scored = map_rows(docs, f"{verdict} int", lambda raw, state: (toxicity.score_text(raw, model, state)[1],), keep=tuple(docs.columns), setup=model.start)
    return scored.where(F.col(verdict) == 0).select(*(quoted(c) for c in docs.columns))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6 on shingles of five words, similarity 0.8 or more: of each group the document with the smallest id stays.

    Rows are told apart by id and text: of two texts under one id each has its own verdict, and equal rows leave once."""
    judged = neardup.near_duplicates(docs, k=5).where("doc_id IS NOT NULL")
    left = without(docs, judged.where("NOT kept"))
    again = judged.where("kept").groupBy("doc_id", "text_key").count().where("count > 1")
    if again.isEmpty():
        return left
    return without(left, again).unionByName(left.where("doc_id IS NOT NULL").join(F.broadcast(again.select("doc_id").distinct()) if again.count() <= 1_000_000 else again.select("doc_id").distinct(), "doc_id", "left_semi").select(*(quoted(c) for c in docs.columns)).dropDuplicates(["doc_id", "text"]))


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: bytes of repeated strings of 200 bytes are cut, whole characters at a time; n_chars follows. Null texts stay null, shorter texts
    as they are; of repeated rows every one is cut; an empty table stays empty."""

    def row(raw, runs):
        if raw is None:
            return None, None
        text = exactdup.cut(raw, exactdup.whole_characters(raw, runs)).decode("utf-8", "replace")
        return text, len(text)

    rest = tuple(c for c in docs.columns if c not in ("text", "n_chars"))
    text, chars = unused(docs, "cut_text"), unused(docs, "cut_chars")
    cut = exactdup.apply_runs(docs, exactdup.repeated_intervals(docs), f"{text} string, {chars} long", row, keep=rest)
    new = {"text": F.col(text).alias("text"), "n_chars": F.col(chars).cast(docs.schema["n_chars"].dataType).alias("n_chars") if "n_chars" in docs.columns else None}
    return cut.select(*(new[c] if c in new else quoted(c) for c in docs.columns))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: documents that hold a benchmark item, or one with other names and numbers, go, whatever their id; null and empty texts stay;
    repeated rows go or stay together; items of fewer than five words are not looked for."""
    return decontam.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: how often, and in which block, each document is in the mix; null and empty texts have no tokens and follow their block;
    repeated rows share one decision; an empty table gives no row."""
    return mixing.mix(docs)


STAGES = [
    ("toxicity", reject_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("exact_passages", cut_repeated_passages),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
]
#: Classification by compression, MinHash and suffix sorting have no SQL form; the tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
        # written: what it was made from is not read again
        if before is not None:
            discard(before)
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)
