"""The queries of the core operators over the test tables, each with SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuskit.functions import text as X
from corpuskit.functions.models import REWARDS, echo, hashed_embedding, overlap_rerank
from corpuskit.operators import cleanup, dedup, generate, grounding, metrics, retrieval, rewards, shape
from corpuskit.operators.graph import shared_folder
from corpuskit.sources import io
from corpuskit.streaming import streams

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    def register(f: Callable[[SparkSession, str], DataFrame]):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return register


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


# SQL counterparts of functions/text.py
SPACE = r"[\s\x{b}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def s_strip(c: str) -> str:
    return f"regexp_replace(regexp_replace({c}, '^{SPACE}+', ''), '{SPACE}+$', '')"


def s_clean(c: str) -> str:
    return f"coalesce({s_strip(c)}, '')"


def s_squeeze(c: str) -> str:
    return f"coalesce({s_strip(f"regexp_replace({c}, '{SPACE}+', ' ', 'g')")}, '')"


def s_key(*cs: str) -> str:
    return "sha256(" + " || chr(10) || ".join(s_squeeze(c) for c in cs) + ")"


def s_mixed(c: str) -> str:
    t = f"lower({s_clean(c)})"
    parts = rf"regexp_extract_all({t}, '[\x{{4e00}}-\x{{9fff}}]{{1,3}}|[a-z0-9]+')"
    both = f"list_concat({parts}, CASE WHEN len({parts}) < 3 THEN list_filter(string_split(replace({t}, ' ', ''), ''), lambda x: x <> '') ELSE [] END)"
    return f"CASE WHEN coalesce({c}, '') = '' THEN []::VARCHAR[] WHEN len({both}) = 0 THEN ['_'] ELSE {both} END"


BM25 = r"[a-zA-Z0-9]+|[\x{4e00}-\x{9fff}]"


def s_tokens(c: str) -> str:
    return f"list_transform(regexp_extract_all(coalesce({c}, ''), '{BM25}'), lambda x: lower(x))"


def s_top_share(t: str) -> str:
    return f"list_max(list_transform(list_filter(list_distinct(string_split({t}, '')), lambda c: c <> ''), lambda c: length({t}) - length(replace({t}, c, '')))) / length({t})"


def s_low(c: str) -> str:
    t = s_clean(c)
    return (
        f"(length({t}) < 12 OR (length({t}) < 40 AND NOT contains({t}, '。') AND NOT contains({t}, '.')) "
        f"OR regexp_matches({t}, '(?i)(测试|test|TODO|待补充|不知道){{3,}}') OR coalesce({s_top_share(t)} > 0.34, false))"
    )


EVAL_KEY = s_key("instruction", "input", "output")


@query(f"SELECT min(ord) AS ord, {EVAL_KEY} AS dedup_sha256 FROM eval_medical_qa_rag GROUP BY 2")
def exact_dedup(spark, d):
    return dedup.exact_dedup(table(spark, d, "eval_medical_qa_rag"), "ord", "instruction", "input", "output").select("ord", "dedup_sha256")


@query(f"SELECT k AS dedup_sha256, count(*) AS n FROM (SELECT {s_key('question', 'answer')} AS k FROM medical_qa) GROUP BY k HAVING count(*) > 1")
def exact_dup_counts(spark, d):
    keyed = table(spark, d, "medical_qa").select(X.dedup_key(F.col("question"), F.col("answer")).alias("dedup_sha256"))
    return keyed.groupBy("dedup_sha256").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


@query(f"""WITH head AS (SELECT * FROM eval_medical_qa_rag ORDER BY ord LIMIT 500),
    ok AS (SELECT ord, {EVAL_KEY} AS k FROM head WHERE {s_clean('instruction')} <> '' AND {s_clean('output')} <> '')
    SELECT min(ord) AS ord FROM ok GROUP BY k ORDER BY 1 LIMIT 200""")
def bounded_sample(spark, d):
    e = table(spark, d, "eval_medical_qa_rag")
    return dedup.bounded_unique(e, "ord", ["instruction", "input", "output"], ["instruction", "output"], 200, 500).select("ord")


@query(f"SELECT ord, {s_low('answer')} AS low_quality FROM medical_qa")
def low_quality_flags(spark, d):
    return table(spark, d, "medical_qa").select("ord", X.low_quality(F.col("answer")).alias("low_quality"))


@query(f"SELECT ord, round({s_top_share(s_clean('answer'))}, 6) AS share FROM medical_qa")
def top_char_share(spark, d):
    return table(spark, d, "medical_qa").select("ord", F.round(X.top_char_share(X.clean("answer")), 6).alias("share"))


@query(f"SELECT ord, len(t) AS n, array_to_string(t, '|') AS tokens FROM (SELECT ord, {s_mixed('question')} AS t FROM medical_qa)")
def tokens_mixed(spark, d):
    t = X.mixed_tokens(F.col("question"))
    return table(spark, d, "medical_qa").select("ord", F.size(t).cast("long").alias("n"), F.array_join(t, "|").alias("tokens"))


@query(f"SELECT ord, array_to_string({s_tokens('answer')}, '|') AS tokens FROM medical_qa")
def tokens_bm25(spark, d):
    return table(spark, d, "medical_qa").select("ord", F.array_join(X.bm25_tokens(F.col("answer")), "|").alias("tokens"))


@query(f"""SELECT row_idx, {s_strip("regexp_replace(regexp_replace(regexp_replace(findings, '\\r\\n?', chr(10), 'g'), '[ \\t\\x{3000}]+', ' ', 'g'), '\\n{3,}', chr(10) || chr(10), 'g')")} AS findings FROM mimic_report_en""")
def whitespace_collapsed(spark, d):
    return table(spark, d, "mimic_report_en").select("row_idx", X.collapse_whitespace(F.col("findings")).alias("findings"))


S_QA_SENTENCES = f"""list_filter(list_transform(regexp_split_to_array(regexp_replace(answer, '([。！？!?])\\s*', '\\1' || chr(1), 'g'), '\\x01|\\n+'),
    lambda x: {s_strip('x')}), lambda x: length(x) >= 4)"""


@query(f"""WITH s AS (SELECT ord, {s_strip('answer')} AS whole, {S_QA_SENTENCES} AS parts FROM medical_qa WHERE answer IS NOT NULL)
    SELECT ord, len(t) AS n, array_to_string(t, '|') AS sentences FROM (SELECT ord, CASE WHEN len(parts) > 0 THEN parts WHEN whole <> '' THEN [whole] ELSE [] END AS t FROM s)""")
def qa_sentences(spark, d):
    s = X.qa_sentences(F.col("answer"))
    parts = table(spark, d, "medical_qa").filter("answer is not null").select("ord", s.alias("s"))
    return parts.select("ord", F.size("s").cast("long").alias("n"), F.array_join("s", "|").alias("sentences"))


S_REPORT = """list_filter(list_transform(regexp_split_to_array(regexp_replace(regexp_replace(replace(regexp_replace(findings, '(?i)\\b(FINDINGS|IMPRESSION|CONCLUSION)\\s*:', ' ', 'g'), chr(13), chr(10)),
    '([.!?。！？；;])\\s+', '\\1' || chr(1), 'g'), '。', '。' || chr(1), 'g'), '\\x01|\\n+'), lambda s: regexp_replace(regexp_replace(regexp_replace(s, '\\s+', ' ', 'g'), '^[ \\-\\t]+', ''), '[ \\-\\t]+$', '')), lambda s: length(s) BETWEEN 8 AND 260)"""


@query(f"SELECT row_idx, len(s) AS n, array_to_string(s, '|') AS sentences FROM (SELECT row_idx, {S_REPORT} AS s FROM mimic_report_en WHERE findings IS NOT NULL)")
def report_sentences(spark, d):
    s = X.report_sentences(F.col("findings"))
    return table(spark, d, "mimic_report_en").filter("findings is not null").select("row_idx", F.size(s).cast("long").alias("n"), F.array_join(s, "|").alias("sentences"))


def _qa_text(spark: SparkSession, d: str) -> DataFrame:
    both = F.concat_ws("\n", F.coalesce("question", F.lit("")), F.coalesce("answer", F.lit("")))
    return table(spark, d, "medical_qa").select(F.col("ord").alias("id"), both.alias("text"))


S_SIMHASH = f"""tok AS (SELECT ord AS id, unnest({s_mixed("coalesce(question, '') || chr(10) || coalesce(answer, '')")}) AS t FROM medical_qa),
    cnt AS (SELECT id, t, count(*) AS c FROM tok GROUP BY ALL),
    h AS (SELECT t, ('0x' || substr(md5(t), 17, 16))::UBIGINT AS v FROM (SELECT DISTINCT t FROM cnt)),
    vote AS (SELECT id, i, sum(CASE WHEN (v >> i) & 1 = 1 THEN c ELSE -c END) AS s FROM cnt JOIN h USING (t), range(64) r(i) GROUP BY ALL),
    sig AS (SELECT id, sum(CASE WHEN s > 0 THEN (CASE WHEN i = 63 THEN -9223372036854775808 ELSE (1::BIGINT << i)::HUGEINT END) ELSE 0 END)::BIGINT AS simhash FROM vote GROUP BY id)"""


@query(f"WITH {S_SIMHASH} SELECT id, simhash FROM sig")
def simhash_signature(spark, d):
    return dedup.simhash(_qa_text(spark, d))


@query(f"""WITH {S_SIMHASH}, u AS (SELECT DISTINCT simhash FROM sig)
    SELECT x.simhash AS a, y.simhash AS b, bit_count(xor(x.simhash, y.simhash))::INT AS distance FROM u x JOIN u y ON x.simhash < y.simhash AND bit_count(xor(x.simhash, y.simhash)) <= 3""")
def near_dup_pairs(spark, d):
    return dedup.hamming_pairs(dedup.simhash(_qa_text(spark, d)))


def s_greedy(near: str) -> str:
    """The sequential rule as a recursive query: one row after the other meets the list of kept ones."""
    text = "coalesce(question, '') || chr(10) || coalesce(answer, '')"
    return f"""WITH RECURSIVE {S_SIMHASH}, s AS MATERIALIZED (SELECT row_number() OVER (ORDER BY id) AS rn, id, simhash AS h, length({text}) AS n FROM sig JOIN medical_qa ON ord = id WHERE {s_clean(text)} <> ''),
    g AS (SELECT 0::BIGINT AS i, []::STRUCT(id BIGINT, h BIGINT, n BIGINT)[] AS kept UNION ALL
    SELECT i + 1, CASE WHEN at_ IS NULL THEN list_append(kept, {{'id': id, 'h': h, 'n': n}}) ELSE {near} END FROM (SELECT i, kept, s.*, list_position(list_transform(kept, lambda k: bit_count(xor(k.h, s.h)) <= 3), true) AS at_ FROM g JOIN s ON rn = i + 1))
    SELECT unnest(kept).id AS id FROM g WHERE i = (SELECT count(*) FROM s)"""


@query(s_greedy("kept"))
def near_dedup_first(spark, d):
    return dedup.near_dedup(_qa_text(spark, d), 3, "first")


@query(s_greedy("list_transform(kept, lambda k, p: CASE WHEN p = at_ AND n > k.n THEN {'id': id, 'h': h, 'n': n} ELSE k END)"))
def near_dedup_longest(spark, d):
    return dedup.near_dedup(_qa_text(spark, d), 3, "longest")


@query()
def cleaned_questions(spark, d):
    return cleanup.clean_questions(table(spark, d, "medical_qa").select(F.col("ord").alias("id"), F.col("question").alias("text")))


@query(f"SELECT ord, {s_clean('question')} AS human, {s_clean('answer')} AS gpt FROM medical_qa WHERE {s_clean('question')} <> '' AND {s_clean('answer')} <> ''")
def sharegpt_pairs(spark, d):
    c = F.col("conversations")
    return shape.sharegpt(table(spark, d, "medical_qa")).select("ord", c[0]["value"].alias("human"), c[1]["value"].alias("gpt"))


@query(f"SELECT ord, '<image>' || chr(10) || {s_clean('question')} AS human, 'qa_placeholder.jpg' AS image FROM medical_qa WHERE {s_clean('question')} <> '' AND {s_clean('answer')} <> ''")
def vl_placeholder(spark, d):
    df = shape.sharegpt(table(spark, d, "medical_qa"), image="qa_placeholder.jpg")
    return df.select("ord", F.col("conversations")[0]["value"].alias("human"), F.col("image")[0].alias("image"))


S_IMAGE = "coalesce(" + ", ".join(f"nullif({s_strip(c)}, '')" for c in ("image", "path", "image_path")) + ")"
S_MERGED = f"""op AS (SELECT *, row_number() OVER () AS rn FROM image_paths), lp AS (SELECT row_idx::VARCHAR AS k, arg_max({S_IMAGE}, rn) AS found FROM op WHERE {S_IMAGE} IS NOT NULL AND row_idx IS NOT NULL GROUP BY 1),
    mr AS (SELECT r.*, coalesce(found, meta['image']) AS picture FROM medical_report_zh r LEFT JOIN lp ON k = coalesce(meta['row_idx'], meta['_resume_key'], _resume_key))"""


def _merged(spark: SparkSession, d: str) -> DataFrame:
    paths = table(spark, d, "image_paths").withColumn("ord", F.struct("_metadata.file_path", "_metadata.row_index"))
    return shape.merge_images(table(spark, d, "medical_report_zh"), paths)


S_ALPACA = f"""SELECT rec_id, CASE WHEN {s_clean('instruction')} = '' THEN '{shape.REPORT_TASK}' ELSE {s_clean('instruction')} END AS instruction,
    CASE WHEN {s_clean('findings_zh')} <> '' AND {s_clean('impression_zh')} <> '' THEN 'Findings:' || chr(10) || {s_clean('findings_zh')} || chr(10) || chr(10) || 'Impression:' || chr(10) || {s_clean('impression_zh')}
    ELSE {s_clean('full_report_zh')} END AS output FROM medical_report_zh
    WHERE {s_clean('findings_zh')} <> '' OR {s_clean('impression_zh')} <> '' OR {s_clean('full_report_zh')} <> ''"""


@query(S_ALPACA)
def alpaca_rows(spark, d):
    return shape.alpaca(table(spark, d, "medical_report_zh")).select("rec_id", "instruction", "output")


@query(f"SELECT rec_id, source AS meta_source, _resume_key AS meta_key FROM medical_report_zh WHERE {s_clean('findings_zh')} <> '' OR {s_clean('impression_zh')} <> '' OR {s_clean('full_report_zh')} <> ''")
def alpaca_meta(spark, d):
    m = F.col("meta")
    return shape.alpaca(table(spark, d, "medical_report_zh")).select("rec_id", m["source"].alias("meta_source"), m["_resume_key"].alias("meta_key"))


@query(f"SELECT rec_id, instruction AS human, output AS gpt FROM ({S_ALPACA}) WHERE instruction <> '' AND output <> ''")
def report_conversations(spark, d):
    c = F.col("conversations")
    return shape.report_conversation(shape.alpaca(table(spark, d, "medical_report_zh"))).select("rec_id", c[0]["value"].alias("human"), c[1]["value"].alias("gpt"))


@query(f"""WITH {S_MERGED}, al AS ({S_ALPACA}) SELECT rec_id, coalesce(nullif({s_strip('picture')}, ''), nullif({s_strip("meta['path']")}, ''), nullif({s_strip("meta['image_path']")}, '')) AS image, '<image>' || chr(10) || '{shape.REPORT_VL_TASK}' AS human, output AS gpt, source AS meta_source
    FROM mr JOIN al USING (rec_id) WHERE output <> '' AND coalesce(nullif({s_strip('picture')}, ''), nullif({s_strip("meta['path']")}, ''), nullif({s_strip("meta['image_path']")}, '')) IS NOT NULL""")
def report_vl(spark, d):
    c = F.col("conversations")
    return shape.report_vl(_merged(spark, d)).select("rec_id", F.col("image")[0].alias("image"), c[0]["value"].alias("human"), c[1]["value"].alias("gpt"), F.col("meta")["source"].alias("meta_source"))


@query(f"SELECT row_idx FROM mimic_report_en WHERE {s_clean('findings')} <> '' OR {s_clean('impression')} <> ''")
def reports_with_text(spark, d):
    return table(spark, d, "mimic_report_en").filter(shape.has_text("findings", "impression")).select("row_idx")


@query(f"""SELECT 'qa' AS kind, count(*) AS n FROM medical_qa WHERE {s_clean('question')} <> '' AND {s_clean('answer')} <> '' UNION ALL
    SELECT 'report', count(*) FROM ({S_ALPACA})""")
def union_training(spark, d):
    qa = shape.sharegpt(table(spark, d, "medical_qa")).select(F.lit("qa").alias("kind"))
    return qa.unionByName(shape.alpaca(table(spark, d, "medical_report_zh")).select(F.lit("report").alias("kind"))).groupBy("kind").agg(F.count(F.lit(1)).alias("n"))


@query(f"""SELECT ord, {s_clean('question')} AS question, {s_clean('answer')} AS response_chosen, {s_clean('answer_rejected')} AS response_rejected FROM medical_qa
    WHERE {s_clean('question')} <> '' AND {s_clean('answer')} <> '' AND {s_clean('answer_rejected')} <> ''""")
def dpo_explicit(spark, d):
    return shape.dpo(table(spark, d, "medical_qa"), "explicit").select("ord", "question", "response_chosen", "response_rejected")


S_DRAW = "(('0x' || substr(md5({}::VARCHAR || '|42'), 1, 8))::UBIGINT % 1000)"


@query(f"""SELECT ord, q AS question, a AS response_chosen, CASE WHEN length(a) < 8 THEN '信息不足，无法回答。' WHEN {S_DRAW.format('ord')} < 300 THEN '根据上述内容，' || cut ELSE cut END AS response_rejected
    FROM (SELECT ord, q, a, regexp_replace(left(a, greatest(8, length(a) // 3)), '{SPACE}+$', '') AS cut FROM (SELECT ord, {s_clean('question')} AS q, {s_clean('answer')} AS a FROM medical_qa) WHERE q <> '' AND a <> '')""")
def dpo_weak(spark, d):
    return shape.dpo(table(spark, d, "medical_qa")).select("ord", "question", "response_chosen", "response_rejected")


@query(f"""SELECT ord, '### Instruction:' || chr(10) || {s_clean('instruction')} || CASE WHEN {s_clean('input')} <> '' THEN chr(10) || '### Input:' || chr(10) || {s_clean('input')} ELSE '' END
    || chr(10) || '### Response:' || chr(10) AS prompt FROM eval_medical_qa_rag""")
def alpaca_prompts(spark, d):
    return table(spark, d, "eval_medical_qa_rag").select("ord", shape.alpaca_prompt(F.col("instruction"), F.col("input")).alias("prompt"))


@query(f"""SELECT ord, '<|im_start|>user' || chr(10) || {s_clean('question')} || '<|im_end|>' || chr(10) || '<|im_start|>assistant' || chr(10) AS prompt,
    {s_clean('answer')} || '<|im_end|>' || chr(10) AS answer FROM medical_qa WHERE {s_clean('question')} <> '' AND {s_clean('answer')} <> ''""")
def turn_pairs(spark, d):
    df = shape.sharegpt(table(spark, d, "medical_qa")).withColumn("messages", shape.openai_turns(F.col("conversations")))
    return shape.turn_pairs(df, "ord").drop("pair")


@query(f"WITH {S_MERGED} SELECT rec_id, picture AS image, meta['translator'] AS translator FROM mr")
def merged_images(spark, d):
    return _merged(spark, d).select("rec_id", F.col("meta")["image"].alias("image"), F.col("meta")["translator"].alias("translator"))


S_PAIR = f"SELECT ord, {s_clean('question')} AS q, {s_clean('answer')} AS a, {s_clean('answer_rejected')} AS r FROM medical_qa WHERE {s_clean('question')} <> '' AND {s_clean('answer')} <> ''"
S_ASK = "'<|im_start|>user' || chr(10) || {} || '<|im_end|>' || chr(10) || '<|im_start|>assistant' || chr(10)"


@query(f"SELECT ord, '<image>' || chr(10) || q AS prompt, a AS reference, 'qa_placeholder.jpg' AS first_image, sha256('<image>' || chr(10) || q || chr(10) || a) AS sample_id FROM ({S_PAIR})")
def sft_fields(spark, d):
    df = shape.sharegpt(table(spark, d, "medical_qa"), image=shape.PLACEHOLDER).withColumn("meta", F.create_map().cast("map<string,string>"))
    return shape.sft_fields(df).select("ord", "prompt", "reference", "first_image", "sample_id")


@query(f"SELECT ord, q AS question, a AS reference FROM ({S_PAIR})")
def eval_pairs(spark, d):
    df = shape.sharegpt(table(spark, d, "medical_qa"), image=shape.PLACEHOLDER)
    return df.select("ord", shape.eval_pair(F.col("conversations")).alias("p")).select("ord", "p.*")


@query(f"SELECT ord, {S_ASK.format('q')} AS prompt, a AS assistant FROM ({S_PAIR})")
def grpo_records(spark, d):
    df = shape.sharegpt(table(spark, d, "medical_qa")).withColumn("messages", shape.openai_turns(F.col("conversations")))
    return shape.grpo_record(df).select("ord", "prompt", "assistant")


@query(f"SELECT ord, {S_ASK.format('q')} AS prompt, a || '<|im_end|>' || chr(10) AS chosen, r || '<|im_end|>' || chr(10) AS rejected FROM ({S_PAIR}) WHERE r <> ''")
def dpo_records(spark, d):
    df = shape.dpo(table(spark, d, "medical_qa"), "explicit")
    return shape.dpo_record(df.select("ord", F.col("question").alias("prompt"), F.col("response_chosen").alias("chosen"), F.col("response_rejected").alias("rejected")))


@query(f"SELECT ord, len({s_tokens('q')}) AS n_prompt, len({s_tokens('a')}) AS n_answer FROM ({S_PAIR})")
def label_masks(spark, d):
    """Labels are masked and taken apart again; ids are the tokens' hashes."""
    ids = lambda c: F.transform(X.bm25_tokens(F.col(c)), lambda t: F.pmod(F.crc32(t), F.lit(1 << 31)).cast("int"))
    df = shape.filled(table(spark, d, "medical_qa"), "question", "answer").select("ord", ids("question").alias("q"), ids("answer").alias("a"))
    parts = shape.prompt_and_answer_ids(F.concat("q", "a"), shape.masked_labels(F.col("q"), F.col("a")))
    back = df.select("ord", "q", "a", parts.alias("p")).filter("p.prompt_ids = q and p.answer_ids = a")
    return back.select("ord", F.size("p.prompt_ids").cast("long").alias("n_prompt"), F.size("p.answer_ids").cast("long").alias("n_answer"))


@query(f"SELECT ord, len({s_tokens('q')}) AS n_ids, max(len({s_tokens('q')})) OVER (PARTITION BY ord % 50) AS n_filled, len({s_tokens('q')}) AS n_attended FROM ({S_PAIR})")
def collated_batches(spark, d):
    ids = F.transform(X.bm25_tokens(F.col("question")), lambda t: F.pmod(F.crc32(t), F.lit(1 << 30)).cast("int") + 1)
    df = shape.filled(table(spark, d, "medical_qa"), "question", "answer").select("ord", (F.col("ord") % 50).alias("batch"), ids.alias("ids"), ids.alias("labels"))
    out = shape.collated(df.withColumn("n_ids", F.size("ids").cast("long")), "batch", "ids", "labels")
    attended = F.aggregate("attention_mask", F.lit(0), lambda a, x: a + x).cast("long")
    return out.filter("size(ids) = size(labels)").select("ord", "n_ids", F.size("ids").cast("long").alias("n_filled"), attended.alias("n_attended"))


@query("SELECT vec_id, CASE WHEN label = 0 THEN 0 WHEN label = 1 THEN 1 END AS cls FROM embeddings")
def class_map(spark, d):
    letter = F.element_at(F.array(*[F.lit(c) for c in "ABCDEFGHIJ"]), F.col("label").cast("int") + 1)
    return table(spark, d, "embeddings").select("vec_id", shape.class_of(letter).alias("cls"))


@query("SELECT event_id, NOT (event_id % 5 IN (0, 1)) AS is_cut FROM events")
def truncated_completions(spark, d):
    ids = F.array(F.lit(9).cast("long"), F.col("event_id") % 5)
    return table(spark, d, "events").select("event_id", shape.truncated_completion(ids, 0, 1).alias("is_cut"))


S_CHUNK = f"concat_ws(chr(10), '问题：' || {s_clean('instruction')}, CASE WHEN {s_clean('input')} <> '' THEN '补充信息：' || {s_clean('input')} END, '答案：' || {s_clean('output')})"


@query(f"SELECT ord AS doc_id, {S_CHUNK} AS text, {s_clean('instruction')} AS question, {s_clean('output')} AS answer, {s_clean('input')} AS input, coalesce(_low_quality_flag, false) AS low_quality FROM eval_medical_qa_rag WHERE {s_clean('instruction')} <> '' AND {s_clean('output')} <> ''")
def retrieval_docs(spark, d):
    return retrieval.retrieval_docs(table(spark, d, "eval_medical_qa_rag"))


@query(f"SELECT count(*) AS n_input, count(DISTINCT {EVAL_KEY}) AS n_kept, count(*) - count(DISTINCT {EVAL_KEY}) AS n_removed FROM eval_medical_qa_rag")
def dedup_counters(spark, d):
    e = table(spark, d, "eval_medical_qa_rag")
    return dedup.dedup_summary(e, dedup.exact_dedup(e, "ord", "instruction", "input", "output"))


@query("SELECT ord FROM (SELECT ord FROM medical_qa ORDER BY md5(ord::VARCHAR || '|42'), ord LIMIT 100)")
def seeded_sample(spark, d):
    return dedup.seeded_sample(table(spark, d, "medical_qa").select("ord"), "ord", 100)


@query("SELECT row_idx, lower(regexp_extract(image, '([^/]*)$', 1)) = 'qa_placeholder.jpg' AS placeholder FROM mimic_report_en")
def placeholder_images(spark, d):
    return table(spark, d, "mimic_report_en").select("row_idx", shape.is_placeholder(F.col("image")).alias("placeholder"))


@query("SELECT row_idx FROM mimic_report_en WHERE image IS NOT NULL AND image NOT IN (SELECT image FROM image_paths WHERE image IS NOT NULL)")
def missing_images(spark, d):
    listing = table(spark, d, "image_paths").select("image").filter("image is not null")
    return shape.not_done(table(spark, d, "mimic_report_en").filter("image is not null"), listing, "image").select("row_idx")


@query("SELECT row_idx FROM mimic_report_en WHERE row_idx::VARCHAR NOT IN (SELECT _resume_key FROM medical_report_zh)")
def resume_todo(spark, d):
    todo = table(spark, d, "mimic_report_en").select("row_idx", F.col("row_idx").cast("string").alias("_resume_key"))
    return shape.not_done(todo, table(spark, d, "medical_report_zh"), "_resume_key").select("row_idx")


@query("SELECT q.ord, length(q.answer) AS a, length(e.output) AS b FROM medical_qa q JOIN eval_medical_qa_rag e ON q.ord = e.ord")
def positional_zip(spark, d):
    a = table(spark, d, "medical_qa").select("ord", F.length("answer").cast("long").alias("a"))
    return metrics.aligned(a, table(spark, d, "eval_medical_qa_rag").select("ord", F.length("output").cast("long").alias("b")), "ord")


def _docs(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "eval_medical_qa_rag").select(F.col("ord").alias("doc_id"), F.concat_ws("\n", "instruction", "output").alias("text"), "output")


def _asked(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "heldout_items").select(F.col("item_id").alias("qid"), F.col("text").alias("query"))


S_DOCS = "docs AS (SELECT ord AS doc_id, concat_ws(chr(10), instruction, output) AS text, output FROM eval_medical_qa_rag)"
S_POST = f"{S_DOCS}, tk AS (SELECT doc_id, unnest({s_tokens('text')}) AS token FROM docs), post AS (SELECT token, doc_id, count(*) AS tf FROM tk GROUP BY ALL)"
S_BM25 = f"""{S_POST}, dfs AS (SELECT token, count(*) AS df FROM post GROUP BY token), dl AS (SELECT doc_id, len({s_tokens('text')}) AS dl FROM docs),
    tot AS (SELECT count(*) AS n, avg(dl) AS avgdl FROM dl),
    asked AS (SELECT qid, token, count(*) AS times FROM (SELECT item_id AS qid, unnest({s_tokens('text')}) AS token FROM heldout_items) GROUP BY ALL),
    imp AS (SELECT token, doc_id, ln(1 + (n - df + 0.5::DOUBLE) / (df + 0.5::DOUBLE)) * tf * 2.5::DOUBLE / (tf + 1.5::DOUBLE * (0.25::DOUBLE + 0.75::DOUBLE * dl / avgdl)) AS impact FROM post JOIN dfs USING (token) JOIN dl USING (doc_id), tot),
    sc AS (SELECT qid, doc_id, round(sum(times * impact), 6) AS score FROM imp JOIN asked USING (token) GROUP BY ALL),
    bm AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score DESC, doc_id) AS rank FROM sc WHERE score > 0) WHERE rank <= 8)"""


@query(f"WITH {S_POST} SELECT token, count(*) AS df FROM post GROUP BY token")
def doc_freq(spark, d):
    return retrieval.postings(_docs(spark, d)).groupBy("token").agg(F.count(F.lit(1)).alias("df"))


@query(f"WITH {S_POST} SELECT token, round(ln(1 + ((SELECT count(*) FROM docs) - count(*) + 0.5::DOUBLE) / (count(*) + 0.5::DOUBLE)), 6) AS idf FROM post GROUP BY token")
def idf(spark, d):
    docs = _docs(spark, d)
    return retrieval.idf_table(retrieval.postings(docs), docs.agg(F.count(F.lit(1)).alias("n"))).select("token", F.round("idf", 6).alias("idf"))


@query(f"WITH {S_DOCS} SELECT count(*) AS n, round(avg(len({s_tokens('text')})), 6) AS avgdl FROM docs")
def avgdl(spark, d):
    return retrieval.doc_stats(_docs(spark, d)).agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("dl"), 6).alias("avgdl"))


@query(f"WITH {S_BM25} SELECT qid, doc_id, score, rank::INT AS rank FROM bm")
def bm25_topk(spark, d):
    return retrieval.bm25_topk(_asked(spark, d), _docs(spark, d))


S_MINMAX = """CASE WHEN abs(max(score) OVER w - min(score) OVER w) <= 1e-9 * greatest(abs(max(score) OVER w), abs(min(score) OVER w)) THEN 1.0
    ELSE (score - min(score) OVER w) / (max(score) OVER w - min(score) OVER w) END"""


@query(f"WITH {S_BM25} SELECT qid, doc_id, round({S_MINMAX}, 6)::DOUBLE AS norm FROM bm WINDOW w AS (PARTITION BY qid)")
def bm25_minmax(spark, d):
    return retrieval.minmax(retrieval.bm25_topk(_asked(spark, d), _docs(spark, d))).select("qid", "doc_id", F.round("norm", 6).alias("norm"))


def _vectors(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    v = table(spark, d, "embeddings").select(F.col("vec_id").alias("doc_id"), F.col("embedding").alias("vec"))
    return v.filter("doc_id % 50 = 0").withColumnRenamed("doc_id", "qid"), v


S_VEC = """vs AS (SELECT q.vec_id AS qid, v.vec_id AS doc_id, round(list_sum(list_transform(list_zip(q.embedding, v.embedding), lambda p: p[1]::DOUBLE * p[2]::DOUBLE)), 6) AS score
    FROM embeddings q, embeddings v WHERE q.vec_id % 50 = 0), vt AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score DESC, doc_id) AS rank FROM vs) WHERE rank <= 8)"""


@query(f"WITH {S_VEC} SELECT qid, doc_id, score, rank::INT AS rank FROM vt")
def vector_topk(spark, d):
    return retrieval.vector_topk(*_vectors(spark, d))


@query(f"""WITH {S_VEC}, g AS (SELECT DISTINCT qid FROM vs), r AS (SELECT g.qid, rank FROM g LEFT JOIN vt ON vt.qid = g.qid AND vt.doc_id = g.qid)
    SELECT count(*) AS n_queries, avg(CASE WHEN rank <= 1 THEN 1.0::DOUBLE ELSE 0 END) AS recall_at_1, avg(CASE WHEN rank <= 3 THEN 1.0::DOUBLE ELSE 0 END) AS recall_at_3,
    avg(CASE WHEN rank <= 5 THEN 1.0::DOUBLE ELSE 0 END) AS recall_at_5, avg(CASE WHEN rank <= 10 THEN 1.0::DOUBLE / rank ELSE 0 END) AS mrr_at_10 FROM r""")
def self_retrieval(spark, d):
    q, v = _vectors(spark, d)
    return metrics.ranking(retrieval.vector_topk(q, v), q.select("qid", F.col("qid").alias("doc_id")))


#: Vectors of the embeddings table stand for those of a model: a query has that of its id, a document
#: that of its id for its question and the next one for its whole text.
def _stored_vectors(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    v = table(spark, d, "embeddings").select("vec_id", F.col("embedding").alias("vec"))
    asked = _asked(spark, d).join(v, F.col("qid") == F.col("vec_id")).select("qid", "query", "vec")
    return asked, v.withColumnRenamed("vec_id", "doc_id"), v.select((F.col("vec_id") - 1).alias("doc_id"), "vec")


def _hybrid(spark: SparkSession, d: str, **options) -> DataFrame:
    docs = _docs(spark, d)
    asked, first, second = _stored_vectors(spark, d)
    known = lambda v: v.join(docs.select("doc_id"), "doc_id", "left_semi")
    low = docs.select("doc_id", X.low_quality(F.col("output")).alias("low_quality"))
    return retrieval.hybrid(retrieval.vector_topk(asked, known(first)), retrieval.vector_topk(asked, known(second)), retrieval.bm25_topk(asked, docs), low, **options)


def s_overlap(name: str, column: str) -> str:
    cs = lambda c: f"list_filter(list_distinct(string_split({c}, '')), lambda x: x <> '')"
    return f"""{name}s AS (SELECT qid, doc_id, len(list_intersect(qc, dc))::DOUBLE AS score FROM (SELECT item_id AS qid, {cs('text')} AS qc FROM heldout_items), (SELECT doc_id, {cs(column)} AS dc FROM docs)),
    {name} AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score DESC, doc_id) AS rank FROM {name}s) WHERE rank <= 8)"""


@query(f"WITH {S_DOCS}, {s_overlap('co', 'text')} SELECT qid, doc_id, score, rank::INT AS rank FROM co")
def char_overlap_topk(spark, d):
    return retrieval.char_overlap_topk(_asked(spark, d), _docs(spark, d))


def s_vectors(name: str, shift: int) -> str:
    dot = "round(list_sum(list_transform(list_zip(q.embedding, v.embedding), lambda p: p[1]::DOUBLE * p[2]::DOUBLE)), 6)"
    return f"""{name}s AS (SELECT item_id AS qid, v.vec_id - {shift} AS doc_id, {dot} AS score FROM heldout_items h JOIN embeddings q ON q.vec_id = h.item_id, embeddings v WHERE v.vec_id - {shift} IN (SELECT doc_id FROM docs)),
    {name} AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score DESC, doc_id) AS rank FROM {name}s) WHERE rank <= 8)"""


S_FUSED = f"""{S_BM25}, {s_vectors('cq', 0)}, {s_vectors('cd', 1)},
    bn AS (SELECT qid, doc_id, {S_MINMAX} AS norm FROM bm WHERE qid IN (SELECT vec_id FROM embeddings) WINDOW w AS (PARTITION BY qid)),
    al AS (SELECT qid, doc_id, score AS q, 0.0 AS o, 0.0 AS b FROM cq UNION ALL SELECT qid, doc_id, 0, score, 0 FROM cd UNION ALL SELECT qid, doc_id, 0, 0, norm FROM bn),
    fu AS (SELECT qid, doc_id, sum(q)::DOUBLE AS q, sum(o)::DOUBLE AS o, sum(b)::DOUBLE AS b FROM al GROUP BY ALL),
    lo AS (SELECT ord AS doc_id, {s_low('output')} AS low_quality FROM eval_medical_qa_rag)"""
S_RANKED = "hy AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score DESC, doc_id)::INT AS final_rank, max(score) OVER (PARTITION BY qid) AS best FROM hs) WHERE final_rank <= 3)"
S_HYBRID = f"""{S_FUSED}, hs AS (SELECT qid, doc_id, low_quality, round((0.7::DOUBLE * q + 0.3::DOUBLE * o + 0.25::DOUBLE * b) * CASE WHEN low_quality THEN 0.85::DOUBLE ELSE 1 END, 10) AS score FROM fu JOIN lo USING (doc_id)), {S_RANKED}"""
S_SHARED = "len(list_intersect(list_distinct(list_filter(string_split(h.text, ''), lambda c: c <> '')), list_distinct(list_filter(string_split(docs.text, ''), lambda c: c <> ''))))::DOUBLE / nullif(len(list_distinct(list_filter(string_split(h.text, ''), lambda c: c <> ''))), 0)"
S_RERANKED = f"""{S_FUSED}, hs AS (SELECT qid, doc_id, low_quality, round(coalesce({S_SHARED}, 0) * CASE WHEN low_quality THEN 0.85::DOUBLE ELSE 1 END, 10) AS score FROM fu JOIN lo USING (doc_id) JOIN docs USING (doc_id) JOIN heldout_items h ON h.item_id = qid), {S_RANKED}"""


@query(f"WITH {S_RERANKED} SELECT qid, doc_id, score, low_quality, final_rank FROM hy WHERE best >= 0.8")
def hybrid_rerank(spark, d):
    """The rerank slot, and no result for queries whose best candidate is under a threshold."""
    out = _hybrid(spark, d, rerank=overlap_rerank, texts=_docs(spark, d), queries=_asked(spark, d), threshold=0.8)
    return out.select("qid", "doc_id", "score", "low_quality", "final_rank")


def _scratch(spark: SparkSession, name: str) -> str:
    """A new folder below the shared one."""
    return f"{shared_folder(spark)}/{name}-{spark.sparkContext.applicationId}-{spark.sql('select uuid()').first()[0]}"


S_INDEX_DOCS = f"docs AS (SELECT ord AS doc_id, {S_CHUNK} AS text FROM eval_medical_qa_rag WHERE {s_clean('instruction')} <> '' AND {s_clean('output')} <> '')"


@query("WITH " + S_BM25.replace(S_DOCS, S_INDEX_DOCS) + " SELECT qid, doc_id, score, rank::INT AS rank FROM bm")
def index_bm25(spark, d):
    """BM25 over an index that is written and read again."""
    path = _scratch(spark, "index")
    retrieval.write_index(retrieval.retrieval_docs(table(spark, d, "eval_medical_qa_rag")), path, hashed_embedding)
    return retrieval.indexed_bm25(_asked(spark, d), retrieval.read_index(spark, path))


@query()
def index_search(spark, d):
    """Hybrid search with the embedding and rerank stand-ins over a stored index."""
    path = _scratch(spark, "index")
    retrieval.write_index(retrieval.retrieval_docs(table(spark, d, "eval_medical_qa_rag")), path, hashed_embedding)
    return retrieval.search_index(_asked(spark, d), retrieval.read_index(spark, path), hashed_embedding, rerank=overlap_rerank)


@query(f"WITH {S_HYBRID} SELECT qid, doc_id, score, low_quality, final_rank FROM hy")
def hybrid_search(spark, d):
    return _hybrid(spark, d).select("qid", "doc_id", "score", "low_quality", "final_rank")


@query(f"""WITH {S_HYBRID}, bl AS (SELECT qid, final_rank, text, sum(length(text)) OVER (PARTITION BY qid ORDER BY final_rank) AS upto FROM hy JOIN docs USING (doc_id))
    SELECT qid, string_agg(text, chr(10) || chr(10) || '---' || chr(10) || chr(10) ORDER BY final_rank) AS context FROM bl WHERE final_rank = 1 OR upto <= 900 GROUP BY qid""")
def context_pack(spark, d):
    hits = _hybrid(spark, d).join(_docs(spark, d).select("doc_id", "text"), "doc_id")
    return retrieval.pack_context(hits.select("qid", F.col("final_rank").alias("rank"), F.col("text").alias("block")), 900)


@query(f"""WITH {S_DOCS}, {s_overlap('co', 'text')}, bl AS (SELECT qid, rank, '[qa #' || doc_id || ']' || chr(10) || text AS block FROM co JOIN docs USING (doc_id) WHERE score > 0),
    up AS (SELECT *, sum(length(block)) OVER (PARTITION BY qid ORDER BY rank) AS upto FROM bl)
    SELECT item_id AS qid, coalesce(string_agg(block, chr(10) || chr(10) || '---' || chr(10) || chr(10) ORDER BY rank), '') AS context FROM heldout_items LEFT JOIN (FROM up WHERE upto <= 600) ON qid = item_id GROUP BY item_id""")
def kb_context(spark, d):
    docs = _docs(spark, d).select("doc_id", retrieval.chunk_block(F.lit("qa"), F.col("doc_id"), F.col("text")).alias("block"))
    hits = retrieval.char_overlap_topk(_asked(spark, d), _docs(spark, d)).join(docs, "doc_id")
    return retrieval.pack_context(hits, 600, first_always=False, empty="", score="score")


S_PROMPT = "'" + retrieval.PROMPT.replace("\n", "' || chr(10) || '") + "'"


@query(f"SELECT item_id AS qid, replace(replace({S_PROMPT}, '{{retrieved_context}}', lang), '{{question}}', text) AS prompt FROM heldout_items")
def rag_prompts(spark, d):
    return table(spark, d, "heldout_items").select(F.col("item_id").alias("qid"), retrieval.prompt(F.col("lang"), F.col("text")).alias("prompt"))


def s_grams(table_: str, key: str) -> str:
    words = f"SELECT {key}, ' ' || unnest(regexp_extract_all(lower(coalesce(text, '')), '[\\p{{L}}\\p{{N}}_]+')) || ' ' AS w FROM {table_}"
    cuts = " UNION ALL ".join(f"SELECT {key}, unnest(list_transform(range(1, length(w) - {n} + 2), lambda i: substr(w, i, {n}))) AS g FROM ({words})" for n in (2, 3, 4))
    return f"SELECT {key}, g, count(*) AS tf FROM ({cuts}) GROUP BY ALL"


@query(f"""WITH {S_DOCS}, dg AS ({s_grams('docs', 'doc_id')}), qs AS (SELECT item_id AS qid, text FROM heldout_items), qg AS ({s_grams('qs', 'qid')}),
    idf AS (SELECT g, ln((1 + (SELECT count(*) FROM docs))::DOUBLE / (1 + count(*))) + 1 AS idf FROM dg GROUP BY g),
    dw AS (SELECT doc_id, g, tf * idf / sqrt(sum((tf * idf) * (tf * idf)) OVER (PARTITION BY doc_id)) AS v FROM dg JOIN idf USING (g)),
    qw AS (SELECT qid, g, tf * idf / sqrt(sum((tf * idf) * (tf * idf)) OVER (PARTITION BY qid)) AS w FROM qg JOIN idf USING (g)),
    sc AS (SELECT qid, doc_id, round(sum(v * w), 6) AS score FROM dw JOIN qw USING (g) GROUP BY ALL)
    SELECT qid, doc_id, score, rank::INT AS rank FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score DESC, doc_id) AS rank FROM sc WHERE score > 0) WHERE rank <= 8""")
def tfidf_topk(spark, d):
    return retrieval.tfidf_topk(_asked(spark, d), _docs(spark, d))


S_LAST_LINE = "regexp_extract({}, '([^\\n]*)$', 1)"


@query(f"""SELECT ord, q AS question, CASE WHEN low THEN '请输出润色后的答案：' ELSE a END AS answer, low AS _low_quality_flag, low AS _rewritten FROM (SELECT ord, {s_clean('question')} AS q, {s_clean('answer')} AS a, {s_low('answer')} AS low FROM medical_qa) WHERE q <> '' AND a <> ''""")
def rewritten_answers(spark, d):
    """Low-quality answers go through the generator slot; its stand-in repeats the prompt's last line."""
    return generate.rewrite_low_quality(table(spark, d, "medical_qa"), echo).select("ord", "question", "answer", "_low_quality_flag", "_rewritten")


@query(f"""WITH r AS (SELECT row_idx::VARCHAR AS _resume_key, {s_clean('findings')} AS f, {s_clean('impression')} AS i FROM mimic_report_en), z AS (SELECT *, {s_strip(S_LAST_LINE.format('f'))} AS fz, {s_strip(S_LAST_LINE.format('i'))} AS iz FROM r WHERE f <> '' OR i <> '')
    SELECT _resume_key, nullif(f, '') AS findings_en, nullif(fz, '') AS findings_zh, nullif(iz, '') AS impression_zh, nullif(CASE WHEN fz <> '' AND iz <> '' THEN '影像所见：' || chr(10) || fz || chr(10) || chr(10) || '印象：' || chr(10) || iz WHEN fz <> '' THEN fz ELSE iz END, '') AS full_report_zh
    FROM z WHERE _resume_key NOT IN (SELECT _resume_key FROM medical_report_zh)""")
def translated_reports(spark, d):
    """Reports not translated yet go through the generator slot."""
    out = generate.translate_reports(table(spark, d, "mimic_report_en"), echo, table(spark, d, "medical_report_zh"))
    return out.select("_resume_key", "findings_en", "findings_zh", "impression_zh", "full_report_zh")


@query(f"""WITH p AS (SELECT ord, {s_clean('question')} AS q, {s_clean('answer')} AS a, {s_clean('answer_rejected')} AS r FROM medical_qa WHERE {s_clean('question')} <> '' AND {s_clean('answer')} <> ''),
    c AS (SELECT ord, '患者：' || left(a, 20) AS chosen, CASE WHEN ord % 5 = 0 THEN '' ELSE left(a, 20) END AS rejected, {S_DRAW.format('ord')} < 500 AS first, length('用户问题：' || chr(10) || q || chr(10) || chr(10)) AS n FROM p)
    SELECT reason, count(*) AS n FROM (SELECT CASE WHEN rejected = '' THEN 'empty' WHEN n % 3 = 0 THEN 'unreadable' WHEN n % 3 = 1 AND NOT first OR n % 3 = 2 AND first THEN 'other_side' ELSE 'ok' END AS reason FROM c) GROUP BY reason""")
def judged_outcomes(spark, d):
    """Pairs written and judged by stand-ins: the judge's verdict follows the length of the question's part of its prompt."""
    df = shape.sharegpt(table(spark, d, "medical_qa"))
    write = lambda p: F.concat(F.lit("患者："), F.substring(F.regexp_extract(p, r"(?s)\n\n参考答案：\n(.*)\n\n请按要求", 1), 1, 20))
    contrast = lambda p: F.when(F.col("ord") % 5 == 0, F.lit("")).otherwise(F.substring(F.regexp_extract(p, r"(?s)^参考答案：\n(.*)\n\n请按要求", 1), 1, 20))
    n = lambda p: F.length(F.regexp_extract(p, r"(?s)^(.*)回答甲：\n", 1)) % 3
    judge = lambda p: F.when(n(p) == 0, "?").when(n(p) == 1, '{"valid": true, "preferred": "甲"}').otherwise('{"valid": true, "preferred": "乙"}')
    return generate.outcome_counts(generate.judged_pairs(df, write, contrast, judge, "ord"))


S_FLUSHED = "CASE WHEN a.buf <> '' THEN list_append(a.done, a.buf) ELSE a.done END"
S_CHUNKS = f"""SELECT doc_id, list_reduce(list_prepend({{'done': []::VARCHAR[], 'buf': ''}}, list_transform(list_filter(list_transform(regexp_split_to_array(text, '\\n\\s*\\n'), lambda p: {s_strip('p')}), lambda p: p <> ''), lambda p: {{'done': []::VARCHAR[], 'buf': p}})),
    lambda a, x: CASE WHEN length(a.buf) + length(x.buf) + 1 <= 800 THEN {{'done': a.done, 'buf': CASE WHEN a.buf = '' THEN x.buf ELSE a.buf || chr(10) || chr(10) || x.buf END}}
    WHEN length(x.buf) <= 800 THEN {{'done': {S_FLUSHED}, 'buf': x.buf}} ELSE {{'done': list_concat({S_FLUSHED}, list_transform(range(0, length(x.buf), 700), lambda i: substr(x.buf, i + 1, 800))), 'buf': ''}} END) AS a FROM documents"""


@query(f"SELECT doc_id, unnest(range(len(c)))::INT AS chunk_id, unnest(c) AS chunk FROM (SELECT doc_id, {S_FLUSHED} AS c FROM ({S_CHUNKS}))")
def kb_chunks(spark, d):
    return table(spark, d, "documents").select("doc_id", F.posexplode(retrieval.chunk_text(F.col("text"))).alias("chunk_id", "chunk"))


S_AUDIT = f"""a AS (SELECT ord, question, answer, list_filter(string_split(answer, ''), lambda c: regexp_matches(c, '^[\\x{{4e00}}-\\x{{9fff}}]$')) AS han, list_distinct(string_split(coalesce(answer_rejected, ''), '')) AS have FROM medical_qa
    WHERE question IS NOT NULL AND answer IS NOT NULL),
    f AS (SELECT ord, CASE WHEN len(han) = 0 THEN false ELSE len(list_filter(han, lambda c: list_contains(have, c))) / len(han) < 0.45 END AS low_context_coverage,
    regexp_matches(answer, '{metrics.CERTAIN}') AS possible_over_certainty, regexp_matches(answer, '{metrics.DRUG}') AND NOT regexp_matches(answer, '{metrics.DOCTOR}') AS drug_advice_without_doctor,
    regexp_matches(question || chr(10) || answer, '{metrics.EMERGENCY}') AND NOT regexp_matches(answer, '{metrics.URGENT}') AS emergency_without_urgent_care FROM a),
    au AS (SELECT *, low_context_coverage OR possible_over_certainty AS possible_new_or_unsupported_fact, drug_advice_without_doctor OR emergency_without_urgent_care AS possible_dangerous_advice FROM f)"""


def _audited(spark: SparkSession, d: str) -> DataFrame:
    """Answers audited against the rejected answer as their context."""
    q, a = F.col("question"), F.col("answer")
    flags = metrics.audit(q, a, F.coalesce("answer_rejected", F.lit("")))
    return table(spark, d, "medical_qa").filter("question is not null and answer is not null").select("ord", *flags)


@query(f"WITH {S_AUDIT} SELECT * FROM au")
def answer_audit(spark, d):
    return _audited(spark, d)


@query(f"WITH {S_AUDIT}, n AS (" + " UNION ALL ".join(f"SELECT '{c}' AS flag, count(*) FILTER ({c}) AS n_flagged, count(*) AS n FROM au" for c in metrics.AUDIT) + ") SELECT flag, n_flagged, coalesce(round(n_flagged / n, 4), 0.0::DOUBLE) AS rate FROM n")
def audit_summary(spark, d):
    return metrics.audit_summary(_audited(spark, d))


@query(f"WITH {S_AUDIT} SELECT ord FROM au WHERE possible_new_or_unsupported_fact OR possible_dangerous_advice ORDER BY ord LIMIT 50")
def flagged_answers(spark, d):
    return metrics.flagged_examples(_audited(spark, d), "ord").select("ord")


@query("SELECT 'split' AS field, split AS value, count(*) AS n FROM eval_medical_qa_rag GROUP BY split UNION ALL SELECT 'source', source, count(*) FROM eval_medical_qa_rag GROUP BY source")
def value_counts(spark, d):
    return metrics.value_counts(table(spark, d, "eval_medical_qa_rag"), "split", "source")


@query(f"WITH {S_VEC}, g AS (SELECT vec_id AS qid, vec_id + 1 AS doc_id FROM embeddings WHERE vec_id % 50 = 0) SELECT qid, doc_id FROM g WHERE NOT EXISTS (FROM vt WHERE vt.qid = g.qid AND vt.doc_id = g.doc_id AND rank <= 5) ORDER BY qid LIMIT 50")
def retrieval_misses(spark, d):
    q, v = _vectors(spark, d)
    return metrics.misses(retrieval.vector_topk(q, v), q.select("qid", (F.col("qid") + 1).alias("doc_id")))


def s_hit(words: tuple[str, ...]) -> str:
    return "(" + " OR ".join(f"contains(lower(s), '{w}')" for w in words) + ")"


def s_pick(groups) -> str:
    return "CASE " + " ".join(f"WHEN {s_hit(w)} THEN '{k}'" for k, w in groups) + " END"


S_REGIONS = f"""SELECT row_idx, pos, s, array_to_string(list_distinct_keep(keys), '|') AS regions FROM (SELECT row_idx, pos, s, list_concat({", ".join(f"CASE WHEN {s_hit(w)} THEN ['{k}'] ELSE [] END" for k, w in grounding.ANATOMY)},
    CASE WHEN {s_pick(grounding.SIDES)} = 'bilateral' THEN ['bilateral_lungs']
    WHEN {s_pick(grounding.SIDES)} IS NOT NULL AND {s_pick(grounding.LEVELS)} IS NOT NULL THEN [{s_pick(grounding.SIDES)} || '_' || {s_pick(grounding.LEVELS)} || '_lung']
    WHEN {s_pick(grounding.SIDES)} IS NOT NULL THEN [{s_pick(grounding.SIDES)} || '_lung']
    WHEN {s_pick(grounding.LEVELS)} IS NOT NULL THEN ['left_' || {s_pick(grounding.LEVELS)} || '_lung', 'right_' || {s_pick(grounding.LEVELS)} || '_lung'] ELSE [] END) AS keys
    FROM (SELECT row_idx, unnest(range(len(ss))) AS pos, unnest(ss) AS s FROM (SELECT row_idx, {S_REPORT} AS ss FROM mimic_report_en WHERE findings IS NOT NULL)))""".replace("list_distinct_keep(keys)", "keys")


@query(f"SELECT row_idx, pos, regions FROM ({S_REGIONS})")
def region_infer(spark, d):
    s = table(spark, d, "mimic_report_en").select("row_idx", F.posexplode(X.report_sentences(F.col("findings"))).alias("pos", "s"))
    return s.select("row_idx", F.col("pos").cast("long").alias("pos"), F.array_join(grounding.infer_regions(F.col("s")), "|").alias("regions"))


def _reports(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "mimic_report_en").filter("image is not null").select(F.col("row_idx").alias("id"), "image", F.concat_ws("\n", "findings", "impression").alias("text"))


S_POSITIVES = S_REGIONS.replace("findings IS NOT NULL", "image IS NOT NULL").replace("findings", "report").replace("FROM mimic_report_en", "FROM (SELECT row_idx, image, concat_ws(chr(10), findings, impression) AS report FROM mimic_report_en)").replace("array_to_string(keys, '|') AS regions", "list_distinct(keys) AS ks, keys")


@query(f"""WITH x AS (SELECT row_idx AS id, pos, s AS sentence, keys FROM ({S_POSITIVES}) WHERE regexp_matches(s, '{grounding.ABNORMAL}')), e AS (SELECT id, pos, sentence, unnest(range(len(keys))) AS at_, unnest(keys) AS region FROM x)
    SELECT id, pos, sentence, region FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY pos, at_) AS n FROM e) WHERE n <= 4""")
def grounding_positives(spark, d):
    return grounding.positives(_reports(spark, d)).select("id", "pos", "sentence", "region")


S_NAMES = "nm AS (SELECT * FROM (VALUES " + ", ".join(f"('{r[1]}', '{r[2]}', '{r[3]}')" for r in grounding.region_rows()) + ") v(key, zh, en))"
S_PAIRS = f"""x AS (SELECT row_idx AS id, pos, s AS sentence, keys FROM ({S_POSITIVES}) WHERE regexp_matches(s, '{grounding.ABNORMAL}')), e AS (SELECT id, pos, sentence, unnest(range(len(keys))) AS at_, unnest(keys) AS region FROM x),
    ps AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY pos, at_) AS n FROM e) WHERE n <= 4), {S_NAMES},
    ng AS (SELECT id, pos, sentence, region, key AS candidate, row_number() OVER (PARTITION BY id, pos, region ORDER BY md5(id || '|' || pos || '|' || key || '|42'), key) AS r FROM ps JOIN nm ON key <> region AND NOT (region LIKE 'left%' AND key LIKE 'left%')),
    ex AS (SELECT id, pos, sentence, region, region AS candidate, 'match' AS label FROM ps UNION ALL SELECT id, pos, sentence, region, candidate, 'mismatch' FROM ng WHERE r = 1),
    full_ AS (SELECT ex.*, image, t.zh, t.en, o.zh AS ozh, o.en AS oen, substr(sha1(id || '||' || pos || '||' || region || '||' || candidate), 1, 12) AS example_id FROM ex JOIN nm t ON t.key = region JOIN nm o ON o.key = candidate JOIN mimic_report_en ON row_idx = id),
    ga AS (SELECT *, CASE WHEN label = 'match' THEN '一致。对应区域：' || zh || '。结论：' || sentence ELSE '不一致。句子对应区域：' || zh || '。第二张图不是该结论的主要对应区域。' END AS answer FROM full_)"""


@query(f"""WITH {S_PAIRS} SELECT example_id, id, image || '|crops/' || example_id || '_' || candidate || '.png' AS image, label AS grounding_label, sentence AS grounding_sentence, region AS grounding_region, candidate AS candidate_region, answer,
    '先解析报告句子：' || sentence || chr(10) || '句子中的空间或解剖线索指向 ' || zh || '（' || en || '）。' || CASE WHEN label = 'match' THEN '第二张图是从胸片中裁剪出的候选区域，覆盖该解剖位置。因此这句话和第二张局部图在空间上是一致的，可以把报告结论绑定到该区域。'
    ELSE '但第二张图对应的是 ' || ozh || '（' || oen || '），与句子描述的空间位置不一致。因此不能把该报告结论绑定到第二张局部图。' END AS reasoning FROM ga""")
def grounding_examples(spark, d):
    out = grounding.examples(_reports(spark, d), grounding.regions(spark))
    return out.withColumn("image", F.array_join("image", "|")).drop("conversations")


def s_side(k: str) -> str:
    return f"CASE WHEN {k} LIKE 'left%' THEN 'left' WHEN {k} LIKE 'right%' THEN 'right' WHEN {k} LIKE 'bilateral%' THEN 'bilateral' ELSE 'central' END"


def s_level(k: str) -> str:
    return f"CASE WHEN {k} = 'cardiomediastinal' THEN 'central' WHEN {k} LIKE '%upper%' THEN 'upper' WHEN {k} LIKE '%mid%' THEN 'mid' WHEN {k} LIKE '%lower%' THEN 'lower' WHEN {k} LIKE '%hilum%' THEN 'hilum' WHEN {k} LIKE '%costophrenic%' THEN 'costophrenic' ELSE 'whole' END"


@query(f"""WITH {S_PAIRS} SELECT count(*) AS n, 0::BIGINT AS bad_format, 0::BIGINT AS missing_crops, count(*) FILTER (label = 'mismatch' AND {s_side('region')} <> {s_side('candidate')}) AS side_errors, count(*) FILTER (label = 'mismatch' AND {s_level('region')} <> {s_level('candidate')}) AS level_errors,
    round(avg(coalesce(CASE WHEN regexp_matches(lower(answer), '{rewards.SAYS_NO}') THEN 'mismatch' WHEN regexp_matches(lower(answer), '{rewards.SAYS_YES}') THEN 'match' END = label, false)::INT), 4) AS label_consistency,
    round(avg((contains(answer, zh) OR contains(lower(answer), replace(region, '_', ' ')))::INT), 4) AS region_mention_rate FROM ga""")
def grounding_quality(spark, d):
    return grounding.quality(grounding.examples(_reports(spark, d), grounding.regions(spark)), grounding.regions(spark))


def s_alias(t: str, n: str) -> str:
    return "CASE " + " ".join(f"WHEN regexp_matches(lower({t}), '{'|'.join(names)}') THEN '{key}'" for key, names in rewards.ALIASES) + f" END {n}"


def s_label(t: str) -> str:
    return f"CASE WHEN regexp_matches(lower({t}), '{rewards.SAYS_NO}') THEN 'mismatch' WHEN regexp_matches(lower({t}), '{rewards.SAYS_YES}') THEN 'match' END"


def s_expected(t: str) -> str:
    return f"CASE WHEN contains({t}, '不一致') OR contains(lower({t}), 'mismatch') THEN 'mismatch' WHEN contains({t}, '一致') OR contains(lower({t}), 'match') THEN 'match' END"


S_GIVEN = """g AS (SELECT rec_id, CASE WHEN rec_id % 2 = 0 THEN '一致。' ELSE '不一致。' END || impression_zh AS a, '<think>' || CASE WHEN rec_id % 3 = 0 THEN '匹配' ELSE '' END || '</think>' || findings_zh AS c
    FROM medical_report_zh WHERE findings_zh IS NOT NULL AND impression_zh IS NOT NULL)"""


def _rewarded(spark: SparkSession, d: str) -> DataFrame:
    r = table(spark, d, "medical_report_zh").filter("findings_zh is not null and impression_zh is not null")
    verdict = F.when(F.col("rec_id") % 2 == 0, "一致。").otherwise("不一致。")
    thought = F.when(F.col("rec_id") % 3 == 0, "<think>匹配</think>").otherwise("<think></think>")
    pairs = r.select("rec_id", F.concat(verdict, "impression_zh").alias("assistant"), F.concat(thought, "findings_zh").alias("completion"))
    return rewards.reward_matrix(pairs, list(REWARDS)).withColumn("reward", rewards.total_reward(list(REWARDS)))


S_REWARDS = f"""{S_GIVEN}, r AS (SELECT *, {s_alias('a', 'AS reg')}, {s_expected('a')} AS want, {s_label('c')} AS said FROM g),
    w AS (SELECT rec_id, CASE WHEN lower({s_strip('c')}) = lower({s_strip('a')}) THEN 1.0::DOUBLE ELSE 0 END AS accuracy_reward,
    regexp_matches(c, '(?s)^<think>' || chr(10) || '.*?' || chr(10) || '</think>' || chr(10) || '<answer>' || chr(10) || '.*?' || chr(10) || '</answer>$')::INT::DOUBLE AS format_reward,
    CASE WHEN want IS NOT NULL THEN coalesce(said = want, false)::INT::DOUBLE END AS grounding_label_reward,
    CASE WHEN reg IS NULL THEN NULL ELSE CASE reg {" ".join(f"WHEN '{k}' THEN regexp_matches(lower(c), '{'|'.join(n)}')" for k, n in rewards.ALIASES)} END::INT::DOUBLE END AS grounding_region_reward,
    CASE WHEN want IS NOT NULL THEN (regexp_matches(c, '(?s)<think>.*?</think>') AND said IS NOT NULL)::INT::DOUBLE END AS grounding_cot_format_reward FROM r),
    t AS (SELECT *, {" + ".join(f"coalesce({n}, 0)" for n in ("accuracy_reward", "format_reward", "grounding_label_reward", "grounding_region_reward", "grounding_cot_format_reward"))} AS reward FROM w)"""


@query(f"WITH {S_REWARDS} SELECT * FROM t")
def reward_matrix(spark, d):
    return _rewarded(spark, d).drop("assistant", "completion")


@query(f"""WITH {S_REWARDS}, e AS (SELECT rec_id % 100 AS grp, sum(reward) AS s, count(reward) AS n, stddev_samp(reward) AS sd FROM t GROUP BY 1)
    SELECT {", ".join(f"round(avg({n}), 6) AS {n}_mean, round(stddev_samp({n}), 6) AS {n}_std" for n in ("grounding_label_reward", "grounding_region_reward"))},
    (SELECT round(sum(s) / sum(n), 6) FROM e) AS reward_mean, (SELECT round(avg(sd), 6) FROM e) AS reward_std, (SELECT round(avg((coalesce(sd, 0) < 1e-8)::INT), 6) FROM e) AS zero_std_share FROM t""")
def reward_summary(spark, d):
    r = _rewarded(spark, d).withColumn("grp", F.col("rec_id") % 100)
    out = rewards.reward_summary(r, ["grounding_label_reward", "grounding_region_reward"], "grp")
    return out.select(*[F.round(c, 6).alias(c) for c in out.columns])


KEYS = [r[1] for r in grounding.region_rows()]
S_DIM = "dim AS (SELECT * FROM (VALUES " + ", ".join(f"({i}, '{r[1]}', '{r[2]}')" for i, r in enumerate(grounding.region_rows())) + ") v(slot, key, zh))"
S_SIDE = "CASE WHEN key LIKE 'left%' THEN NOT contains({0}, '右') WHEN key LIKE 'right%' THEN NOT contains({0}, '左') ELSE true END"
S_EXAMPLES = f"{S_DIM}, x AS (SELECT rec_id, CASE WHEN rec_id % 2 = 0 THEN 'match' ELSE 'mismatch' END AS label, key, zh, findings_zh AS p FROM medical_report_zh JOIN dim ON slot = rec_id % {len(KEYS)})"


def _told(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Stated labels and regions, and the Chinese findings as what a model says about them."""
    r = table(spark, d, "medical_report_zh")
    key = F.element_at(F.array(*[F.lit(k) for k in KEYS]), (F.col("rec_id") % len(KEYS)).cast("int") + 1)
    label = F.when(F.col("rec_id") % 2 == 0, "match").otherwise("mismatch")
    return r.select(F.col("rec_id").alias("example_id"), label.alias("grounding_label"), key.alias("grounding_region")), r.select(F.col("rec_id").alias("id"), F.col("findings_zh").alias("prediction"))


@query(f"""WITH {S_EXAMPLES} SELECT count(*) AS prediction_count, round(avg(coalesce({s_label('p')} = label, false)::INT), 4) AS label_accuracy,
    round(avg((contains(p, zh) OR contains(lower(p), replace(key, '_', ' ')))::INT), 4) AS region_mention_accuracy, round(avg(({S_SIDE.format('p')})::INT), 4) AS left_right_consistency FROM x WHERE p <> ''""")
def predictions_scored(spark, d):
    return grounding.score_predictions(*_told(spark, d), grounding.regions(spark))


@query(f"WITH {S_EXAMPLES} SELECT rec_id, contains(p, zh) OR contains(lower(p), replace(key, '_', ' ')) AS names_region, {S_SIDE.format('p')} AS keeps_side FROM x WHERE p IS NOT NULL")
def region_mentions(spark, d):
    examples, told = _told(spark, d)
    names = grounding.regions(spark).select(F.col("key").alias("grounding_region"), "zh_name")
    rows = examples.join(told.filter("prediction is not null"), F.col("example_id") == F.col("id")).join(F.broadcast(names), "grounding_region")
    said, key = F.col("prediction"), F.col("grounding_region")
    return rows.select(F.col("id").alias("rec_id"), grounding.mentions_region(said, key, F.col("zh_name")).alias("names_region"), grounding.keeps_side(said, key).alias("keeps_side"))


@query(f"SELECT count(*) AS sample_eval_count, count({s_label('full_report_zh')}) AS n_labelled, avg(CASE WHEN {s_label('full_report_zh')} IS NOT NULL THEN coalesce({s_label('findings_zh')} = {s_label('full_report_zh')}, false)::INT::DOUBLE END) AS grounding_label_accuracy FROM medical_report_zh")
def label_accuracy(spark, d):
    return grounding.label_accuracy(table(spark, d, "medical_report_zh"), "findings_zh", "full_report_zh")


@query(f"SELECT row_idx, concat_ws(chr(10), nullif({s_strip('findings')}, ''), nullif({s_strip('impression')}, '')) AS report FROM mimic_report_en")
def report_texts(spark, d):
    df = table(spark, d, "mimic_report_en")
    return df.select("row_idx", grounding.report_text(df).alias("report"))


@query("""SELECT event_id, round((value - avg(value) OVER (PARTITION BY user_id)) / (stddev_samp(value) OVER (PARTITION BY user_id) + 1e-4), 6) AS advantage FROM events""")
def group_advantage(spark, d):
    e = table(spark, d, "events").select("event_id", "user_id", "value")
    return rewards.advantages(e, "user_id", "value").select("event_id", F.round("advantage", 6).alias("advantage"))


@query("SELECT event_id, round((value - avg(value) OVER (PARTITION BY user_id)) / ((SELECT stddev_samp(value) FROM events) + 1e-4), 6) AS advantage FROM events")
def batch_advantage(spark, d):
    e = table(spark, d, "events").select("event_id", "user_id", "value")
    return rewards.advantages(e, "user_id", "value", "batch").select("event_id", F.round("advantage", 6).alias("advantage"))


@query("""WITH p AS (SELECT label AS t, CASE WHEN vec_id % 3 = 0 THEN (label + 1) % 10 ELSE label END AS p FROM embeddings),
    r AS (SELECT t, count(*) AS s, sum((t = p)::INT) AS tp FROM p GROUP BY t), c AS (SELECT p, count(*) AS n FROM p GROUP BY p),
    e AS (SELECT s, tp, coalesce(tp / n, 0.0::DOUBLE) AS pr, tp / s AS re FROM r LEFT JOIN c ON r.t = c.p)
    SELECT round(sum(tp) / sum(s), 6) AS accuracy, round(sum(pr * s) / sum(s), 6) AS "precision", round(sum(re * s) / sum(s), 6) AS recall, round(sum(CASE WHEN pr + re > 0 THEN 2 * pr * re / (pr + re) ELSE 0 END * s) / sum(s), 6) AS f1 FROM e""")
def weighted_prf(spark, d):
    e = table(spark, d, "embeddings").select("label", F.when(F.col("vec_id") % 3 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")).alias("pred"))
    m = metrics.weighted_prf(e, "label", "pred")
    return m.select(*[F.round(c, 6).alias(c) for c in m.columns])


@query("""WITH n AS (SELECT label, count(e.vec_id) AS n FROM range(10) r(label) LEFT JOIN embeddings e USING (label) GROUP BY label), w AS (SELECT label, n, 0.001::DOUBLE / nullif(1 - pow(0.999::DOUBLE, n), 0) AS w FROM n)
    SELECT label::INT AS label, n, round(w / sum(w) OVER () * 10, 6) AS weight FROM w""")
def class_weights(spark, d):
    out = metrics.class_weights(table(spark, d, "embeddings").withColumn("label", F.col("label").cast("int")), "label", list(range(10)))
    return out.withColumn("weight", F.round("weight", 6))


@query("SELECT event_type, event_id, value, place::INT AS place FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY value DESC NULLS LAST, event_id DESC) AS place FROM events) WHERE place <= 3")
def best_runs(spark, d):
    return metrics.best_runs(table(spark, d, "events").select("event_type", "event_id", "value"), "value", "event_id", 3, ["event_type"])


@query("SELECT event_type, event_id FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY value DESC NULLS LAST, event_id DESC) AS place FROM events) WHERE place > 3")
def pruned_runs(spark, d):
    return metrics.pruned_runs(table(spark, d, "events").select("event_type", "event_id", "value"), "value", "event_id", 3, ["event_type"]).select("event_type", "event_id")


@query("SELECT event_id FROM events WHERE event_id > 0 AND event_id % 50 = 0")
def due_evaluations(spark, d):
    return table(spark, d, "events").filter(metrics.due(F.col("event_id"), 50)).select("event_id")


S_BLEU = f"""bp AS (SELECT ord AS id, {s_squeeze('answer')} AS r, {s_squeeze('answer_rejected')} AS h FROM medical_qa WHERE answer IS NOT NULL AND answer_rejected IS NOT NULL),
    bg AS ({" UNION ALL ".join(f"SELECT id, '{side}' AS side, {n} AS n, unnest(list_transform(range(1, length({side}) - {n} + 2), lambda i: substr({side}, i, {n}))) AS g FROM bp" for side in "rh" for n in (1, 2, 3, 4))}),
    bc AS (SELECT id, side, n, g, count(*) AS c FROM bg GROUP BY ALL), bh AS (SELECT x.id, n, sum(least(x.c, y.c)) AS hit FROM bc x JOIN bc y USING (id, n, g) WHERE x.side = 'h' AND y.side = 'r' GROUP BY ALL),
    bl AS (SELECT id, n, length(h) AS lh, length(r) AS lr, coalesce(hit, 0) AS hit, greatest(1, length(h) - n + 1) AS total FROM bp CROSS JOIN range(1, 5) o(n) LEFT JOIN bh USING (id, n)),
    bs AS (SELECT *, sum((hit = 0)::INT) OVER (PARTITION BY id ORDER BY n) AS step FROM bl),
    bq AS (SELECT id, n, lh, lr, min(hit) FILTER (n = 1) OVER (PARTITION BY id) AS one, CASE WHEN hit > 0 THEN hit / total ELSE 0.1::DOUBLE / total END AS p1, CASE WHEN hit > 0 THEN hit / total WHEN lh > 1 THEN ln(lh) / (pow(2, step) * 5) / total ELSE 0 END AS p4 FROM bs),
    sb AS (SELECT id, {", ".join(f"CASE WHEN max(lh) = 0 OR max(lr) = 0 OR max(one) = 0 THEN 0.0::DOUBLE ELSE exp(sum(ln(p1)) FILTER (n <= {m}) / {m} + least(0, 1 - max(lr) / nullif(max(lh), 0))) END AS bleu{m}" for m in (1, 2, 3, 4))},
    CASE WHEN max(lh) = 0 OR max(lr) = 0 OR max(one) = 0 OR min(p4) = 0 THEN 0.0::DOUBLE ELSE exp(sum(ln(nullif(p4, 0))) / 4 + least(0, 1 - max(lr) / nullif(max(lh), 0))) END AS bleu4_m4 FROM bq GROUP BY id)"""


def _scored(spark: SparkSession, d: str) -> DataFrame:
    df = table(spark, d, "medical_qa").filter("answer is not null and answer_rejected is not null")
    norm = lambda c: X.chars(X.squeeze(F.col(c)))
    return df.select(F.col("ord").alias("id"), norm("answer").alias("reference"), norm("answer_rejected").alias("hypothesis"))


@query(f"WITH {S_BLEU} SELECT id, " + ", ".join(f"round({c}, 6) AS {c}" for c in ("bleu1", "bleu2", "bleu3", "bleu4", "bleu4_m4")) + " FROM sb")
def bleu_scores(spark, d):
    out = metrics.text_scores(_scored(spark, d))
    return out.select("id", *[F.round(c, 6).alias(c) for c in ("bleu1", "bleu2", "bleu3", "bleu4", "bleu4_m4")])


@query(f"WITH {S_BLEU} SELECT count(*) AS pairs, round(coalesce(avg(bleu4_m4), 0), 6) AS bleu4_mean FROM sb WHERE id IN (SELECT id FROM bp WHERE r <> '' AND h <> '')")
def bleu_means(spark, d):
    out = metrics.mean_bleu4(_scored(spark, d))
    return out.select("pairs", F.round("bleu4_mean", 6).alias("bleu4_mean"))


@query()
def answer_scores(spark, d):
    return metrics.text_scores(_scored(spark, d))


def _streamed(spark: SparkSession, d: str, make: Callable[[DataFrame], DataFrame]) -> DataFrame:
    path = f"{d}/medical_qa.parquet"
    schema = spark.read.parquet(path).schema
    out = _scratch(spark, "stream")
    streams.write_available(make(streams.read_stream(spark, f"{path}*", schema)), f"{out}/data", f"{out}/state").awaitTermination()
    return spark.read.parquet(f"{out}/data")


@query(f"SELECT count(DISTINCT {s_key('question', 'answer')}) AS n FROM medical_qa")
def stream_dedup(spark, d):
    rows = _streamed(spark, d, lambda s: streams.dedup_stream(s, "question", "answer", event_time="ingested_at").select("ord", "dedup_sha256"))
    return rows.agg(F.count(F.lit(1)).alias("n"))


@query(f"SELECT ord, {s_low('answer')} AS _low_quality_flag FROM medical_qa")
def stream_flags(spark, d):
    return _streamed(spark, d, lambda s: streams.flag_stream(s, "answer").select("ord", "_low_quality_flag"))


QA_FIELDS = "ord long, question string, answer string, source string"
S_QA = "SELECT ord, question, answer, source FROM medical_qa"


def _qa(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "medical_qa").select("ord", "question", "answer", "source")


@query(S_QA)
def jsonl_roundtrip(spark, d):
    path = _scratch(spark, "jsonl")
    io.write_jsonl(_qa(spark, d), path)
    return io.read_jsonl(spark, path, QA_FIELDS)


@query(S_QA)
def jsonl_tolerant(spark, d):
    """Broken lines among the records are left out."""
    path = _scratch(spark, "jsonl")
    broken = _qa(spark, d).filter("ord % 7 = 0").select(F.concat(F.lit('{"ord": '), "ord", F.lit(', "question": ')).alias("line"))
    lines = _qa(spark, d).select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("line"))
    lines.unionByName(broken).write.text(path)
    return io.read_jsonl(spark, path, QA_FIELDS, strict=False)


@query(f"""SELECT ord, CASE WHEN r = '' THEN '' WHEN ord % 2 = 0 THEN '<think>' || chr(10) ELSE '' END AS prefill,
    CASE WHEN r = '' THEN a WHEN ord % 2 = 0 THEN r || chr(10) || '</think>' || chr(10) || chr(10) || a ELSE '<think>' || chr(10) || r || chr(10) || '</think>' || chr(10) || chr(10) || a END AS content FROM ({S_PAIR})""")
def assistant_turns(spark, d):
    """Reasoning (here the rejected answer) in a thinking block, its opening as prefill for every second row."""
    df = shape.filled(table(spark, d, "medical_qa"), "question", "answer").withColumn("r", X.clean("answer_rejected"))
    both = [shape.assistant_text(F.col("r"), F.col("answer"), enabled=True, prefill=p) for p in (True, False)]
    return df.select("ord", F.when(F.col("ord") % 2 == 0, both[0]).otherwise(both[1]).alias("p")).select("ord", "p.*")


@query("""SELECT ord, CASE ord % 5 WHEN 0 THEN 'ok' WHEN 1 THEN 'other_side' WHEN 2 THEN 'invalid' WHEN 3 THEN 'unreadable' ELSE 'no_preference' END AS reason FROM medical_qa""")
def judge_reasons(spark, d):
    """Replies of a judge with curly quotes, full-width colons and thinking are mended and read."""
    reply = F.element_at(F.array(*[F.lit(x) for x in (
        "<think>{}</think> {“valid”：true，“preferred”：“甲”}", "{'valid': true, 'preferred': '乙'}", '{"valid": false, "preferred": "甲"}', "no idea", '{"valid": true, "preferred": "both"}'
    )]), (F.col("ord") % 5).cast("int") + 1)
    rows = table(spark, d, "medical_qa").select("ord", shape.judge_verdict(reply).alias("v"))
    return rows.select("ord", shape.verdict_reason(F.col("v"), F.lit("甲")).alias("reason"))


S_BOXES = ", ".join(f"('{r[1]}', [{', '.join(map(str, r[4]))}]::DOUBLE[])" for r in grounding.region_rows())


@query(f"""SELECT key, vec_id, array_to_string([greatest(0, round_even(box[1] * w, 0)::INT), greatest(0, round_even(box[2] * h, 0)::INT), least(w, round_even(box[3] * w, 0)::INT), least(h, round_even(box[4] * h, 0)::INT)], ',') AS pixels
    FROM (SELECT vec_id, (200 + vec_id % 37)::INT AS w, (300 + vec_id % 41)::INT AS h FROM embeddings) CROSS JOIN (VALUES {S_BOXES}) v(key, box)""")
def crop_boxes(spark, d):
    sizes = table(spark, d, "embeddings").select("vec_id", (200 + F.col("vec_id") % 37).cast("int").alias("w"), (300 + F.col("vec_id") % 41).cast("int").alias("h"))
    boxes = F.array(*[F.struct(F.lit(r[1]).alias("key"), F.array(*map(F.lit, r[4])).alias("box")) for r in grounding.region_rows()])
    rows = sizes.select("*", F.inline(boxes))
    return rows.select("key", "vec_id", F.array_join(grounding.crop_box(F.col("box"), F.col("w"), F.col("h")).cast("array<string>"), ",").alias("pixels"))


@query(f"SELECT key, {s_side('key')} AS side, {s_level('key')} AS level, zh, en FROM (SELECT * FROM (VALUES " + ", ".join(f"('{r[1]}', '{r[2]}', '{r[3]}')" for r in grounding.region_rows()) + ") v(key, zh, en))")
def region_table(spark, d):
    k = F.col("key")
    return grounding.regions(spark).select("key", grounding.side_of(k).alias("side"), grounding.level_of(k).alias("level"), F.col("zh_name").alias("zh"), F.col("en_name").alias("en"))


@query(r"""SELECT row_idx, image, CASE WHEN regexp_matches(image, '^(/|https?://)') THEN image ELSE '/data/' || image END AS resolved, regexp_matches(lower(image), '\.(mp4|avi|mov|mkv|webm)$') AS video FROM image_paths""".replace("\\\\", "\\"))
def picture_paths(spark, d):
    i = F.col("image")
    return table(spark, d, "image_paths").select("row_idx", "image", X.resolve_path(i, "/data").alias("resolved"), X.is_video(i).alias("video"))


@query("SELECT ord, substr(sha1(ord || '||' || coalesce(source, '-')), 1, 12) AS short_id FROM medical_qa")
def short_ids(spark, d):
    return table(spark, d, "medical_qa").select("ord", X.stable_id(F.col("ord").cast("string"), F.coalesce("source", F.lit("-"))).alias("short_id"))


@query("SELECT ord, length(question) AS a, length(answer) AS b FROM medical_qa")
def strict_zip(spark, d):
    q = table(spark, d, "medical_qa")
    return metrics.aligned(q.select("ord", F.length("question").cast("long").alias("a")), q.select("ord", F.length("answer").cast("long").alias("b")), "ord", strict=True)


@query(f"SELECT query, array_to_string(gold_doc_ids, '|') AS gold FROM (SELECT {s_strip('text')} AS query, [item_id::VARCHAR] AS gold_doc_ids FROM heldout_items) WHERE query <> ''")
def paraphrase_rows(spark, d):
    rows = table(spark, d, "heldout_items").select(F.col("text").alias("question"), F.col("item_id").alias("gold_doc_id"))
    return io.paraphrases(rows).select("query", F.array_join("gold_doc_ids", "|").alias("gold"))


@query(f"SELECT question, answer FROM (SELECT coalesce(nullif({s_strip('instruction')}, ''), NULL) AS question, nullif({s_strip('output')}, '') AS answer FROM eval_medical_qa_rag) WHERE question IS NOT NULL AND answer IS NOT NULL")
def answer_rows(spark, d):
    return io.answers(table(spark, d, "eval_medical_qa_rag").select("instruction", F.col("output").alias("text")))


def s_collapsed(c: str) -> str:
    return s_strip(f"regexp_replace(regexp_replace(regexp_replace({c}, '\\r\\n?', chr(10), 'g'), '[ \\t\\x{{3000}}]+', ' ', 'g'), '\\n{{3,}}', chr(10) || chr(10), 'g')")


def s_before(c: str) -> str:
    t = s_collapsed(s_clean(c))
    for label in cleanup.LABELS:
        t = f"regexp_replace({t}, '(?is){label}', '', 'g')"
    t = f"regexp_replace({s_collapsed(t)}, '{cleanup.NOTHING_MORE}', '', 'g')"
    return t


@query(f"""WITH a AS (SELECT ord, {s_before('question')} AS t FROM medical_qa), b AS (SELECT ord, CASE WHEN regexp_matches(t, '{cleanup.WHAT_IS}') THEN {s_strip(f"regexp_extract(t, '{cleanup.WHAT_IS}', 1)")} || '是什么病？' ELSE t END AS t FROM a),
    c AS (SELECT ord, {s_strip(f"regexp_replace(t, '{cleanup.NOTHING_MORE}', '', 'g')")} AS t FROM b)
    SELECT ord, regexp_replace({s_strip(f"regexp_replace(t, '{cleanup.REPLY}', '', 'g')")}, '您好[,，]?\\s*这', '这', 'g') AS text FROM c""")
def labels_removed(spark, d):
    """The cleaner's native stages: labels, fillers, "what is" questions, reply-like ends."""
    return table(spark, d, "medical_qa").select("ord", cleanup.before_clauses(X.clean("question")).alias("text"))


@query("SELECT item_id, text, lang FROM heldout_items")
def json_records(spark, d):
    """A list under a key of one JSON object."""
    path = _scratch(spark, "json")
    rows = table(spark, d, "heldout_items").select(F.struct("item_id", "text", "lang").alias("r")).agg(F.collect_list("r").alias("records"))
    rows.select(F.to_json(F.struct("records")).alias("value")).coalesce(1).write.text(f"{path}.json")
    return io.load_records(spark, f"{path}.json", "item_id long, text string, lang string")


@query(S_QA)
def append_once(spark, d):
    """An interrupted run is taken up again: what is there stays, what lacks is added once."""
    path = _scratch(spark, "append")
    io.append_once(_qa(spark, d).filter("ord % 3 = 0"), path, "ord")
    io.append_once(_qa(spark, d), path, "ord")
    io.append_once(_qa(spark, d), path, "ord")
    return spark.read.parquet(path)


@query("SELECT event_id AS global_step, value::DOUBLE AS bleu4 FROM events WHERE event_id IS NOT NULL")
def metric_history(spark, d):
    path = _scratch(spark, "csv")
    rows = table(spark, d, "events").select(F.col("event_id").alias("global_step"), F.col("value").alias("bleu4"))
    io.append_csv(rows.filter("global_step % 2 = 0"), path)
    io.append_csv(rows.filter("global_step % 2 <> 0"), path)
    return io.metric_history(spark, path)


@query("SELECT doc_id, text FROM documents WHERE text IS NOT NULL AND text <> ''")
def text_tree(spark, d):
    """Texts written as files of a tree and read again."""
    path = _scratch(spark, "tree")
    docs = table(spark, d, "documents").filter("text is not null and text <> ''")
    docs.select(F.col("doc_id").cast("string").alias("name"), "text").write.partitionBy("name").option("lineSep", "\x1e").text(path)
    out = io.read_text_tree(spark, path)
    return out.select(F.regexp_extract("source", r"name=(\d+)", 1).cast("long").alias("doc_id"), F.replace("text", F.lit("\x1e"), F.lit("")).alias("text"))


@query("SELECT ord, row_number() OVER (ORDER BY ord) - 1 AS line_no FROM medical_qa")
def line_numbers(spark, d):
    return io.with_line_no(table(spark, d, "medical_qa").select("ord").orderBy("ord"))


@query(f"SELECT ord, sha256(concat_ws(chr(10), coalesce(instruction, ''), coalesce(input, ''), coalesce(output, ''))) || '_' || ord AS doc_id FROM eval_medical_qa_rag WHERE {s_clean('instruction')} <> '' AND {s_clean('output')} <> ''")
def gold_rows(spark, d):
    e = table(spark, d, "eval_medical_qa_rag").withColumns({"line_no": F.col("ord"), "_dedup_sha256": F.lit(None).cast("string")})
    return io.gold_rows(e).select("ord", "doc_id")


@query(f"SELECT id, arg_max(p, ord) AS prediction FROM (SELECT ord % 1000 AS id, ord, coalesce(nullif({s_strip('answer')}, ''), nullif({s_strip('question')}, '')) AS p FROM medical_qa) WHERE p IS NOT NULL GROUP BY id")
def last_predictions(spark, d):
    q = table(spark, d, "medical_qa").select((F.col("ord") % 1000).alias("id"), "ord", F.col("answer").alias("prediction"), F.col("question").alias("text"))
    return io.predictions(q)


def flagship(spark: SparkSession, d: str) -> DataFrame:
    return hybrid_search(spark, d)
