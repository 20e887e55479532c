"""Reshaping of records into training formats. Rows that lack a required text are dropped."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpuskit.functions.text import clean, draw, pystrip

# Image and frame tokens, default instructions, kept meta keys, the placeholder picture.
IMAGE = "<image>\n"
VISION = "<|vision_start|><|image_pad|><|vision_end|>"
REPORT_TASK = "根据给定影像报告要点，生成规范中文报告（含 Findings 与 Impression 两段）。"
REPORT_VL_TASK = "请根据影像生成中文报告。"
META_KEYS = ("source", "_resume_key", "study_id", "subject_id")
PLACEHOLDER = "qa_placeholder.jpg"
PICTURES = ("image", "path", "image_path")
TURN = "<|im_start|>{}\n{}<|im_end|>\n"


def turn(who: str, value: Column, reasoning: Column | None = None) -> Column:
    return F.struct(
        F.lit(who).alias("from"), value.alias("value"), (F.lit(None).cast("string") if reasoning is None else reasoning).alias("reasoning")
    )


def filled(df: DataFrame, *columns: str) -> DataFrame:
    """Columns stripped; rows in which one is empty are dropped."""
    df = df.withColumns({c: clean(c) for c in columns})
    for c in columns:
        df = df.filter(F.col(c) != "")
    return df


def sharegpt(df: DataFrame, question: str = "question", answer: str = "answer", image: str | None = None) -> DataFrame:
    """Question and answer as a conversation; with ``image`` a placeholder picture is put before the question."""
    df = filled(df, question, answer)
    q = F.concat(F.lit(IMAGE), F.col(question)) if image else F.col(question)
    df = df.withColumn("conversations", F.array(turn("human", q), turn("gpt", F.col(answer))))
    return df.withColumn("image", F.array(F.lit(image))) if image else df


def report_output() -> Column:
    """Both Chinese sections with headings, else the whole report."""
    f, i = clean("findings_zh"), clean("impression_zh")
    return F.when((f != "") & (i != ""), F.concat(F.lit("Findings:\n"), f, F.lit("\n\nImpression:\n"), i)).otherwise(clean("full_report_zh"))


def has_text(*columns: str) -> Column:
    """Whether one of the columns has text."""
    return F.concat(*[clean(c) for c in columns]) != ""


def kept_meta(df: DataFrame, keys: tuple[str, ...] = META_KEYS) -> Column:
    """A map of the listed columns that the table has and that aren't null."""
    pairs = [F.create_map(F.lit(k), F.col(k).cast("string")) for k in keys if k in df.columns]
    whole = F.map_concat(*pairs) if pairs else F.create_map().cast("map<string,string>")
    return F.map_filter(whole, lambda k, v: v.isNotNull())


def alpaca(df: DataFrame) -> DataFrame:
    """Reports as instruction records; dropped when the three Chinese texts are empty."""
    task = F.when(clean("instruction") == "", F.lit(REPORT_TASK)).otherwise(clean("instruction"))
    whole = df.filter(has_text("findings_zh", "impression_zh", "full_report_zh"))
    return whole.withColumns({"instruction": task, "input": F.lit(""), "output": report_output(), "meta": kept_meta(df)})


def report_conversation(df: DataFrame) -> DataFrame:
    """Instruction records as one question and answer each."""
    df = filled(df, "instruction", "output")
    return df.withColumn("conversations", F.array(turn("human", F.col("instruction")), turn("gpt", F.col("output"))))


def report_vl(df: DataFrame, task: str = REPORT_VL_TASK) -> DataFrame:
    """Reports with a picture: the picture and a short task asked, the report answered."""
    image = resolve_image("meta", picture_columns(df))
    df = df.withColumn("found", image).filter(F.col("found").isNotNull())
    df = filled(alpaca(df), "output")
    conversation = F.array(turn("human", F.lit(IMAGE + task.strip())), turn("gpt", F.col("output")))
    source = F.create_map(F.lit("source"), F.lit("report_vl"))
    meta = F.map_concat(F.map_filter(source, lambda k, v: ~F.map_contains_key(F.col("meta"), "source")), F.col("meta"))
    return df.withColumns({"conversations": conversation, "image": F.array("found"), "meta": meta}).drop("found")


def picture_columns(df: DataFrame, names: tuple[str, ...] = PICTURES) -> tuple[str, ...]:
    """The picture columns that hold text; structs of decoded pictures are passed over."""
    return tuple(n for n in names if n in df.columns and df.schema[n].dataType == T.StringType())


def resolve_image(meta: str | None = "meta", columns: tuple[str, ...] = ()) -> Column:
    """First non-blank of the picture columns the table has, then of its map."""
    mine = [F.nullif(pystrip(F.col(n)), F.lit("")) for n in columns]
    return F.coalesce(*mine, *([F.nullif(pystrip(F.col(meta)[n]), F.lit("")) for n in PICTURES] if meta else []))


def dpo(df: DataFrame, mode: str = "synthetic", seed: int = 42, order: str = "ord", question: str = "question", chosen: str = "answer", rejected: str = "answer_rejected") -> DataFrame:
    """Preference rows: given rejected answers, or weak ones made by cutting the chosen answer."""
    df = filled(df, question, chosen)
    if mode == "explicit":
        df = filled(df, rejected)
        bad = F.col(rejected)
    else:
        c = F.col(chosen)
        cut = F.regexp_replace(F.substring(c, F.lit(1), F.greatest(F.lit(8), F.expr(f"int(length(`{chosen}`) div 3)"))), r"(?U)\s+$", "")
        coin = draw(F.col(order), seed) < 300
        bad = F.when(F.length(c) < 8, F.lit("信息不足，无法回答。")).otherwise(F.when(coin, F.concat(F.lit("根据上述内容，"), cut)).otherwise(cut))
    return df.select(
        order, F.lit("").alias("system"), F.array().cast("array<array<string>>").alias("history"),
        F.col(question).alias("question"), F.col(chosen).alias("response_chosen"), bad.alias("response_rejected"),
    )


def alpaca_prompt(instruction: Column, extra: Column) -> Column:
    ins, inp = clean(instruction), clean(extra)
    middle = F.when(inp != "", F.concat(F.lit("\n### Input:\n"), inp)).otherwise(F.lit(""))
    return F.concat(F.lit("### Instruction:\n"), ins, middle, F.lit("\n### Response:\n"))


def openai_turns(conversations: Column) -> Column:
    """human/gpt turns as user/assistant messages with vision tokens; reasoning kept where present."""
    text = lambda t: F.regexp_replace(t["value"], r"\n*<image>\n*", VISION)
    role = lambda t: F.when(t["from"] == "human", F.lit("user")).when(t["from"] == "gpt", F.lit("assistant")).otherwise(t["from"])
    return F.transform(conversations, lambda t: F.struct(role(t).alias("role"), text(t).alias("content"), t["reasoning"].alias("reasoning")))


def assistant_text(reasoning: Column, content: Column, enabled: bool = False, prefill: bool = False, closed: bool = False) -> Column:
    """(prefill, content) of an assistant turn.

    ``closed``: an empty thinking block is the prefill. Otherwise, where reasoning is enabled and there is
    some, it stands in a thinking block before the content; with ``prefill`` the block's opening goes first.
    """
    body = F.regexp_replace(content, r"^\n+", "")
    if closed:
        return F.struct(F.lit("<think>\n\n</think>\n\n").alias("prefill"), body.alias("content"))
    has = F.lit(enabled) & (clean(reasoning) != "")
    thought = F.concat(F.regexp_replace(reasoning, r"^\n+|\n+$", ""), F.lit("\n</think>\n\n"), body)
    whole = thought if prefill else F.concat(F.lit("<think>\n"), thought)
    return F.struct(F.when(has & F.lit(prefill), "<think>\n").otherwise("").alias("prefill"), F.when(has, whole).otherwise(content).alias("content"))


def turn_pairs(df: DataFrame, key: str) -> DataFrame:
    """Messages (0,1), (2,3), ... as prompt and answer, framed."""
    n = F.expr("int(size(messages) div 2)")
    pairs = F.transform(F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>")), lambda i: F.struct(
        i.alias("pair"),
        F.concat(F.lit("<|im_start|>user\n"), F.get(F.col("messages"), i * 2)["content"], F.lit("<|im_end|>\n<|im_start|>assistant\n")).alias("prompt"),
        F.concat(F.get(F.col("messages"), i * 2 + 1)["content"], F.lit("<|im_end|>\n")).alias("answer"),
    ))
    return df.select(key, F.inline(pairs))


def masked_labels(prompt_ids: Column, answer_ids: Column) -> Column:
    """Labels of a sample: -100 for the prompt, the answer's ids after it."""
    return F.concat(F.array_repeat(F.lit(-100), F.size(prompt_ids)), answer_ids)


def pad(ids: Column, size: int | Column, value: int, left: bool = False) -> Column:
    """Cut or fill to ``size``."""
    size = F.lit(size)
    fill = F.array_repeat(F.lit(value), F.greatest(F.lit(0), size - F.size(ids)))
    return F.concat(fill, F.slice(ids, F.lit(1), size)) if left else F.concat(F.slice(ids, F.lit(1), size), fill)


def pad_truncate_eos(ids: Column, size: int, eos: int) -> Column:
    """Longer sequences are cut and end with the end token."""
    return F.when(F.size(ids) > size, F.concat(F.slice(ids, 1, size - 1), F.array(F.lit(eos)))).otherwise(ids)


def collated(df: DataFrame, batch: str, ids: str, labels: str | None = None, padding: int = 0, left: bool = False) -> DataFrame:
    """Sequences of a batch filled up to its longest one, with an attention mask; labels are filled with -100."""
    size = F.max(F.size(ids)).over(Window.partitionBy(batch))
    out = df.withColumn("_size", size)
    columns = {ids: pad(F.col(ids), F.col("_size"), padding, left)}
    if labels:
        columns[labels] = pad(F.col(labels), F.col("_size"), -100, left)
    return out.withColumns(columns).withColumn("attention_mask", F.transform(ids, lambda x: (x != padding).cast("int"))).drop("_size")


def merge_images(reports: DataFrame, paths: DataFrame, order: str = "ord", key: str = "row_idx") -> DataFrame:
    """Reports with the picture of their row put into ``meta``; the last non-blank path of an id, by ``order``, wins.

    A report's id is looked for in its column ``key``, then in ``meta``, then as ``_resume_key`` in
    ``meta`` or the row; ids are compared as text. The build side is reduced first, with map-side
    combine; Spark broadcasts it by its size.
    """
    found = paths.withColumn("found", resolve_image(None, PICTURES)).filter(F.col("found").isNotNull() & F.col(key).isNotNull())
    last = found.groupBy(F.col(key).cast("string").alias("_picture_id")).agg(F.max_by("found", order).alias("found"))
    places = [F.col(c).cast("string") for c in (key,) if c in reports.columns] + [F.col("meta")[key], F.col("meta")["_resume_key"]]
    places += [F.col(c).cast("string") for c in ("_resume_key",) if c in reports.columns]
    meta = F.coalesce(F.col("meta"), F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>")))
    put = F.map_concat(F.map_filter(meta, lambda k, v: k != "image"), F.create_map(F.lit("image"), F.col("found")))
    merged = reports.withColumn("_picture_id", F.coalesce(*places)).join(last, "_picture_id", "left")
    return merged.withColumn("meta", F.when(F.col("found").isNull(), F.col("meta")).otherwise(put)).drop("found", "_picture_id")


def not_done(todo: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """What a resumed run still has to do."""
    return todo.join(done.select(key).distinct(), key, "left_anti")


def translated_report(findings: Column, impression: Column) -> Column:
    f, i = clean(findings), clean(impression)
    return F.when((f != "") & (i != ""), F.concat(F.lit("影像所见：\n"), f, F.lit("\n\n印象：\n"), i)).when(f != "", f).otherwise(i)


def image_slices(df: DataFrame, key: str) -> DataFrame:
    """Each human turn with the images its placeholders stand for (running offset)."""
    turns = F.transform("conversations", lambda t, i: F.struct(i.alias("pos"), F.regexp_count(t["value"], F.lit("<image>")).alias("n")))
    before = lambda i: F.aggregate(F.slice("turns", 1, i), F.lit(0), lambda acc, t: acc + t["n"])
    return df.select(key, "image", turns.alias("turns")).select(
        key, F.inline(F.transform("turns", lambda t: F.struct(t["pos"].alias("pos"), F.slice("image", before(t["pos"]) + 1, t["n"]).alias("images"))))
    )


def judge_verdict(raw: Column) -> DataFrame | Column:
    """Repair and read a judge's JSON object: struct of valid, preferred, reason; null when unreadable."""
    text = F.regexp_replace(raw, r"(?is)<think>.*?</think>", "")
    text = F.translate(text, "“”‘’：，", "\"\"'':,")
    flat = F.regexp_extract(text, r"(?s)(\{[^{}]*\})", 1)
    schema = "valid boolean, preferred string, reason string"
    read = F.from_json(flat, schema)
    again = F.from_json(F.replace(flat, F.lit("'"), F.lit('"')), schema)
    return F.when(flat == "", F.lit(None)).otherwise(F.when(F.coalesce(read["preferred"], read["reason"], read["valid"].cast("string")).isNotNull(), read).otherwise(again))


def verdict_reason(verdict: Column, expected: Column) -> Column:
    """ok, or why a judged pair is left out."""
    return (
        F.when(verdict.isNull(), "unreadable").when(~F.coalesce(verdict["valid"], F.lit(False)), "invalid")
        .when(~F.coalesce(verdict["preferred"].isin("甲", "乙"), F.lit(False)), "no_preference").when(verdict["preferred"] != expected, "other_side").otherwise("ok")
    )


def first_turn(conversations: Column, who: str) -> Column:
    """Value of the first turn of a side."""
    return F.get(F.filter(conversations, lambda t: t["from"] == who), F.lit(0))["value"]


def sft_fields(df: DataFrame) -> DataFrame:
    """``conversations, image, meta`` -> prompt, reference, first picture and an id; rows without both sides are dropped.

    The id is the dedup hash in ``meta``, else a hash of the texts.
    """
    prompt, reference = first_turn(F.col("conversations"), "human"), first_turn(F.col("conversations"), "gpt")
    made = F.sha2(F.concat_ws("\n", prompt, reference), 256)
    out = df.select(
        "*", prompt.alias("prompt"), reference.alias("reference"), F.coalesce(F.get("image", F.lit(0)), F.lit("")).alias("first_image"),
        F.coalesce(F.nullif(F.col("meta")["_dedup_sha256"], F.lit("")), made).alias("sample_id"),
    )
    return out.filter("prompt is not null and reference is not null")


def eval_pair(conversations: Column) -> Column:
    """(question, reference) for evaluation: picture tokens off."""
    bare = lambda c: pystrip(F.replace(c, F.lit("<image>"), F.lit("")))
    return F.struct(bare(first_turn(conversations, "human")).alias("question"), pystrip(first_turn(conversations, "gpt")).alias("reference"))


def prompt_and_answer_ids(ids: Column, labels: Column) -> Column:
    """The inverse of label masking: ids before the first label that counts, and the labels that count."""
    counts = lambda x: x != -100
    n = F.size(ids) - F.size(F.filter(labels, counts))
    at = F.array_position(F.transform(labels, counts), True).cast("int")
    start = F.when(at > 0, at - 1).otherwise(n)
    return F.struct(F.slice(ids, F.lit(1), start).alias("prompt_ids"), F.filter(labels, counts).alias("answer_ids"))


def framed(question: Column, prefill: Column | None = None) -> Column:
    """A user turn and the opening of the assistant's."""
    open_ = F.concat(F.lit("<|im_start|>user\n"), question, F.lit("<|im_end|>\n<|im_start|>assistant\n"))
    return open_ if prefill is None else F.concat(open_, prefill)


def grpo_record(df: DataFrame, **thinking: bool) -> DataFrame:
    """``messages`` -> ``prompt`` and ``assistant`` of the first pair; ``thinking`` as in ``assistant_text``."""
    user, reply = F.get("messages", F.lit(0)), F.get("messages", F.lit(1))
    parts = assistant_text(reply["reasoning"], reply["content"], **thinking)
    return df.select("*", framed(user["content"], parts["prefill"]).alias("prompt"), parts["content"].alias("assistant"))


def dpo_record(df: DataFrame, reasoning: bool = False) -> DataFrame:
    """``prompt, chosen, rejected`` framed as prompt and two responses.

    With ``reasoning`` a row must have both reasonings or neither; others fail the query.
    """
    text = F.replace(F.replace("prompt", F.lit("<image>\n"), F.lit(VISION)), F.lit("<image>"), F.lit(VISION))
    out = {"prompt": framed(text)}
    for side in ("chosen", "rejected"):
        out[side] = F.concat(F.col(side), F.lit("<|im_end|>\n"))
    if reasoning:
        has = [clean(f"{s}_reasoning") != "" for s in ("chosen", "rejected")]
        df = df.filter(F.when(has[0] == has[1], True).otherwise(F.raise_error(F.lit("reasoning on one side only")).cast("boolean")))
        for side in ("chosen", "rejected"):
            thought = F.regexp_replace(F.col(f"{side}_reasoning"), r"^\n+|\n+$", "")
            out[side] = F.when(has[0], F.concat(F.lit("<think>\n"), thought, F.lit("\n</think>\n\n"), out[side])).otherwise(out[side])
    return df.withColumns(out)


def class_of(label: Column) -> Column:
    """A and B as 0 and 1; others are null."""
    return F.when(label == "A", 0).when(label == "B", 1)


def is_placeholder(image: Column) -> Column:
    return F.lower(F.regexp_extract(image, r"([^/]*)$", 1)) == PLACEHOLDER


def truncated_completion(ids: Column, eos: int, padding: int) -> Column:
    """Whether a completion ends with neither the end nor the padding token."""
    return ~F.coalesce(F.element_at(ids, -1).isin(eos, padding), F.lit(False))


def qa_chunk(question: Column, extra: Column, answer: Column) -> Column:
    """Question, further information if there is some, and answer as one retrieval text."""
    more = F.when(clean(extra) != "", F.concat(F.lit("补充信息："), clean(extra)))
    return F.concat_ws("\n", F.concat(F.lit("问题："), clean(question)), more, F.concat(F.lit("答案："), clean(answer)))


def chat_message(images: Column, text: Column) -> Column:
    """One user message of pictures and text, as a list of parts."""
    part = lambda kind, image, value: F.struct(F.lit(kind).alias("type"), image.alias("image"), value.alias("text"))
    none = F.lit(None).cast("string")
    return F.concat(F.transform(images, lambda i: part("image", i, none)), F.array(part("text", none, text)))


def score_item(items: Column) -> Column:
    """Scores as (rank or index, id, score), whether they come as two or three fields."""
    two = F.size(items) == 2
    return F.struct(
        F.get(items, F.lit(0)).cast("int").alias("rank"), F.when(~two, F.get(items, F.lit(1))).alias("doc_id"),
        F.when(two, F.get(items, F.lit(1))).otherwise(F.get(items, F.lit(2))).cast("double").alias("score"),
    )
