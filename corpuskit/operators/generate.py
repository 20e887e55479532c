"""Steps in which a model writes text: rewriting, translating, judged preference pairs.

A model is a slot, a function from a prompt column to a reply column (functions/models.py). Each step
asks it only for the rows that need it, once a row, and goes on where an interrupted run ended.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuskit.functions.models import Generate
from corpuskit.functions.text import clean, draw, low_quality, strip_think

from .shape import META_KEYS, REPORT_TASK, filled, first_turn, judge_verdict, not_done, translated_report, verdict_reason

# What the model is asked.
POLISH = ("问题：", "\n\n原始答案：", "\n\n请输出润色后的答案：")
TRANSLATE = ("以下英文为胸部 X 线/CT 报告中的「", "」段落。请译为简体中文报告正文：仅输出译文本身，不要任何前缀或解释。\n\n")
SECTIONS = {"findings": "影像所见（Findings）", "impression": "印象（Impression）"}
PATIENT = ("用户问题（文字）：\n", "\n\n参考答案：\n", "\n\n请按要求输出患者向正文。")
CONTRAST = ("参考答案：\n", "\n\n请按要求输出对照稿正文。")
JUDGE = ("用户问题：\n", "\n\n回答甲：\n", "\n\n回答乙：\n", "\n\n请输出一行 JSON。")


def rewrite_low_quality(df: DataFrame, generate: Generate | None = None, question: str = "question", answer: str = "answer") -> DataFrame:
    """Rows with question and answer, low-quality answers flagged and, with a model, rewritten by it."""
    df = filled(df, question, answer).withColumn("_low_quality_flag", low_quality(F.col(answer)))
    if generate is None:
        return df.withColumn("_rewritten", F.lit(False))
    asked = F.concat(F.lit(POLISH[0]), F.col(question), F.lit(POLISH[1]), F.col(answer), F.lit(POLISH[2]))
    # the prompt is null where nothing is asked, so that a model need not answer there
    reply = strip_think(generate(F.when(F.col("_low_quality_flag"), asked)))
    return df.withColumn("_rewritten", F.col("_low_quality_flag")).withColumn(answer, F.when(F.col("_rewritten"), reply).otherwise(F.col(answer)))


def translate_reports(df: DataFrame, generate: Generate, done: DataFrame | None = None, key: str = "row_idx", source: str = "translated_en_report") -> DataFrame:
    """Reports with findings or impression, translated section by section.

    Rows whose key stands in ``done(_resume_key)`` are left out. Columns of the translated record, its
    ``meta`` and ``_resume_key``.
    """
    either = lambda s: F.coalesce(*[F.nullif(clean(c), F.lit("")) for c in (f"{s}_en", s) if c in df.columns], F.lit(""))
    rows = df.withColumns({"_f": either("findings"), "_i": either("impression"), "_resume_key": F.col(key).cast("string")}).filter("_f <> '' or _i <> ''")
    if done is not None:
        rows = not_done(rows, done, "_resume_key")
    for name, text in (("findings", "_f"), ("impression", "_i")):
        asked = F.concat(F.lit(TRANSLATE[0] + SECTIONS[name] + TRANSLATE[1]), F.col(text))
        rows = rows.withColumn(f"{text}_zh", F.coalesce(strip_think(generate(F.when(F.col(text) != "", asked))), F.lit("")))
    null = lambda c: F.nullif(F.col(c), F.lit(""))
    meta = F.create_map(*[x for c in META_KEYS if c in df.columns and c != "_resume_key" for x in (F.lit(c), F.col(c).cast("string"))], F.lit("_resume_key"), F.col("_resume_key"))
    return rows.select(
        F.lit(REPORT_TASK).alias("instruction"), null("_f").alias("findings_en"), null("_i").alias("impression_en"), null("_f_zh").alias("findings_zh"),
        null("_i_zh").alias("impression_zh"), F.nullif(translated_report(F.col("_f_zh"), F.col("_i_zh")), F.lit("")).alias("full_report_zh"),
        F.lit(source).alias("source"), meta.alias("meta"), "_resume_key",
    )


def judged_pairs(df: DataFrame, write: Generate, contrast: Generate, judge: Generate, key: str, seed: int = 42) -> DataFrame:
    """``conversations`` -> ``key, prompt, chosen, rejected, reason``.

    One model writes for the patient, another a contrasting text, a third judges both in an order that a
    seeded draw decides. ``reason`` is ok, or why a pair is left out: empty, same, or the judge's.
    """
    prompt, reference = first_turn(F.col("conversations"), "human"), first_turn(F.col("conversations"), "gpt")
    rows = df.select(key, prompt.alias("prompt"), reference.alias("reference")).filter("prompt is not null and reference is not null")
    plain = clean(F.regexp_replace("prompt", r"^<image>\s*", ""))
    rows = rows.withColumn("chosen", write(F.concat(F.lit(PATIENT[0]), plain, F.lit(PATIENT[1]), "reference", F.lit(PATIENT[2]))))
    rows = rows.withColumn("rejected", contrast(F.concat(F.lit(CONTRAST[0]), "reference", F.lit(CONTRAST[1]))))
    first = draw(F.col(key), seed) < 500
    a, b = F.when(first, F.col("chosen")).otherwise(F.col("rejected")), F.when(first, F.col("rejected")).otherwise(F.col("chosen"))
    empty, same = (clean("chosen") == "") | (clean("rejected") == ""), clean("chosen") == clean("rejected")
    asked = F.concat(F.lit(JUDGE[0]), plain, F.lit(JUDGE[1]), a, F.lit(JUDGE[2]), b, F.lit(JUDGE[3]))
    verdict = judge_verdict(judge(F.when(~empty & ~same, asked)))
    reason = F.when(empty, "empty").when(same, "same").otherwise(verdict_reason(verdict, F.when(first, "甲").otherwise("乙")))
    return rows.select(key, "prompt", "chosen", "rejected", reason.alias("reason"))


def accepted(pairs: DataFrame) -> DataFrame:
    return pairs.filter("reason = 'ok'").drop("reason")


def outcome_counts(pairs: DataFrame) -> DataFrame:
    """How many pairs were taken, or left out for which reason."""
    return pairs.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


def model_name(path: Column) -> Column:
    """Last part of a model's path; of a saved state also its parent."""
    parts = F.split(F.regexp_replace(path, "^/+|/+$", ""), "/")
    last = F.element_at(parts, -1)
    return F.when(last.startswith("checkpoint-") & (F.size(parts) > 1), F.concat(F.element_at(parts, -2), F.lit("_"), last)).otherwise(last)


def base_model(card: Column) -> Column:
    """The base model that a model card names in its header."""
    return F.nullif(F.regexp_extract(card, r"(?m)^\s*base_model:[ \t]*(\S.*?)\s*$", 1), F.lit(""))


def check_settings(fps: float | None = None, nframes: int | None = None, lora: bool = False, freeze_llm: bool = False, vision_lora: bool = False, freeze_vision: bool = False) -> None:
    """Raise on settings that exclude each other."""
    if fps is not None and nframes is not None:
        raise ValueError("set fps or nframes, not both")
    if lora and not freeze_llm:
        raise ValueError("adapters need a frozen language model")
    if vision_lora and not (lora and freeze_vision):
        raise ValueError("vision adapters need adapters and a frozen vision tower")
