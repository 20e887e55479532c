"""Queries of the training-data operators, on the whole tables with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import components, table, text_of
from .leaks import RUN, leaked_items
from .mixture import mixture
from .near_duplicates import near_duplicate_links, near_duplicate_pairs
from .pair_defects import pair_defects
from .personal_data import personal_data
from .sentence_alignment import aligned_sentences
from .shared_spans import LEAST, shared_portions, shared_span_pairs
from .split_overlap import split_overlaps
from .truncation import truncated


def _free_texts(spark: SparkSession, d: str) -> DataFrame:
    parts = [
        table(spark, d, t).select(F.lit(t).alias("grp"), F.col(i).alias("id"), F.col(c).alias("text"))
        for t, i, c in (("medical_qa", "ord", "question"), ("mimic_report_en", "row_idx", "findings"))
    ]
    return personal_data(parts[0].unionByName(parts[1]))


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return _free_texts(spark, d).select(
        F.col("grp").alias("tbl"), F.col("id").alias("row_id"), F.explode("types").alias("pii_type")
    )


def p1_redacted(spark: SparkSession, d: str) -> DataFrame:
    """Every text with its placeholders."""
    return _free_texts(spark, d).select(F.col("grp").alias("tbl"), F.col("id").alias("row_id"), "text")


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    parts = [
        table(spark, d, t).select(F.lit(t).alias("grp"), F.col("ord").alias("id"), F.col(q).alias("question"), F.col(a).alias("answer"))
        for t, q, a in (("medical_qa", "question", "answer"), ("eval_medical_qa_rag", "instruction", "output"))
    ]
    return pair_defects(parts[0].unionByName(parts[1])).withColumnsRenamed({"grp": "tbl", "id": "row_id"})


def _fields(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "medical_qa").select(
        F.lit("medical_qa.answer").alias("grp"), F.col("ord").alias("id"), F.col("answer").alias("text"), "source"
    ).unionByName(
        table(spark, d, "medical_report_zh").select(
            F.col("rec_id").alias("id"), "source",
            F.inline(F.array(*[
                F.struct(F.lit(f"medical_report_zh.{c}").alias("grp"), F.col(c).alias("text")) for c in ("findings_zh", "full_report_zh")
            ])),
        )
    )


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    at = F.split("grp", r"\.")
    return truncated(_fields(spark, d)).select(at[0].alias("tbl"), F.col("id").alias("row_id"), at[1].alias("field"))


def p4_rates(spark: SparkSession, d: str) -> DataFrame:
    """How often each source truncates each field."""
    fields = _fields(spark, d)
    found = truncated(fields).withColumn("is_cut", F.lit(1))
    counted = fields.filter("text is not null").select("grp", "id", "source").join(found, ["grp", "id"], "left")
    return counted.groupBy("grp", "source").agg(
        F.count(F.lit(1)).alias("n_values"), F.count("is_cut").alias("n_cut"), (F.count("is_cut") / F.count(F.lit(1))).alias("share")
    ).withColumnRenamed("grp", "field")


def _records(spark: SparkSession, d: str) -> DataFrame:
    qa = table(spark, d, "medical_qa").select(
        F.lit("medical_qa").alias("grp"), F.col("ord").alias("id"), text_of("question", "answer").alias("text")
    )
    reports = table(spark, d, "mimic_report_en").select(
        F.lit("mimic_report_en").alias("grp"), F.col("row_idx").alias("id"), F.coalesce("findings", F.lit("")).alias("text")
    )
    return qa.unionByName(reports)


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return near_duplicate_pairs(_records(spark, d)).withColumnRenamed("grp", "tbl")


def p3_groups(spark: SparkSession, d: str) -> DataFrame:
    """One row for each record that has a near or exact copy: its group (transitive) of texts."""
    links, members = near_duplicate_links(_records(spark, d))
    roots = components(links.select(F.col("cls_a").alias("u"), F.col("cls_b").alias("v")))
    grouped = members.join(roots, members["cls"] == roots["u"], "left").select(
        F.col("grp").alias("tbl"), F.col("id").alias("row_id"), F.coalesce("root", "cls").alias("group_key")
    )
    sizes = grouped.groupBy("group_key").agg(F.min("row_id").alias("group_id"), F.count(F.lit(1)).alias("n_records"))
    return grouped.join(sizes.filter("n_records > 1"), "group_key").select("tbl", "row_id", "group_id", "n_records")


def _texts(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select(F.col("doc_id").alias("id"), "text")


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    sections = [F.struct(F.lit(s).alias("section"), F.col(f"{s}_en").alias("en"), F.col(f"{s}_zh").alias("zh")) for s in ("findings", "impression")]
    reports = table(spark, d, "medical_report_zh").select(F.col("rec_id").alias("id"), F.inline(F.array(*sections)))
    return aligned_sentences(reports, table(spark, d, "term_glossary")).withColumnRenamed("id", "rec_id")


def _overlaps(spark: SparkSession, d: str) -> DataFrame:
    return split_overlaps(
        table(spark, d, "eval_medical_qa_rag").select(
            F.col("ord").alias("id"), (F.col("split") == "train").alias("train"), text_of("instruction", "output").alias("text")
        )
    )


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return _overlaps(spark, d).select(
        F.least("id_train", "id_other").alias("ord_a"), F.greatest("id_train", "id_other").alias("ord_b")
    )


def p6_counts(spark: SparkSession, d: str) -> DataFrame:
    """Overlapping pairs and records of each held-out split and source."""
    own = table(spark, d, "eval_medical_qa_rag").select(F.col("ord").alias("id_other"), "split", "source")
    return _overlaps(spark, d).join(own, "id_other").groupBy("split", "source").agg(
        F.count(F.lit(1)).alias("n_pairs"), F.countDistinct("id_other").alias("n_records")
    )


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return leaked_items(_texts(spark, d), table(spark, d, "heldout_items")).withColumnRenamed("id", "doc_id")


def p7_items(spark: SparkSession, d: str) -> DataFrame:
    """Which held-out items leaked, into how many documents of which sources."""
    found = p7_found(spark, d).join(table(spark, d, "documents").select("doc_id", "source"), "doc_id")
    return found.groupBy("item_id").agg(
        F.count(F.lit(1)).alias("n_documents"), F.countDistinct(F.coalesce("source", F.lit(""))).alias("n_sources")
    )


#: First level of the weight tree: the kind of writing a source holds, by the stem of its name.
DOMAINS = {
    "encyclopedia": "reference", "textbook": "reference", "anatomy_atlas": "reference", "herbal_digest": "reference",
    "guideline": "professional", "drug_leaflet": "professional", "journal_abstract": "professional",
    "patient_forum": "clinical", "radiology_teaching": "clinical", "ward_round_notes": "clinical",
}


#: Vocabulary file of a public tokenizer; it must be there on every machine.
TOKENIZER = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"


def _mixture(spark: SparkSession, d: str, **options) -> tuple[DataFrame, DataFrame]:
    docs = table(spark, d, "documents").select(F.col("doc_id").alias("id"), "source", "text")
    return mixture(docs, table(spark, d, "source_weights"), DOMAINS, TOKENIZER, **options)


def p8_mixture(spark: SparkSession, d: str) -> DataFrame:
    return _mixture(spark, d)[0].withColumnRenamed("id", "doc_id")


def p8_shares(spark: SparkSession, d: str) -> DataFrame:
    return _mixture(spark, d)[1]


def p8_capped(spark: SparkSession, d: str) -> DataFrame:
    """Shares of a mixture as large as all sources: small ones run into their repeats, siblings take over."""
    return _mixture(spark, d, times=1.0)[1]


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return shared_span_pairs(_texts(spark, d)).withColumnsRenamed({"id_a": "doc_a", "id_b": "doc_b"})


def p9_shared(spark: SparkSession, d: str) -> DataFrame:
    """How much of each document stands elsewhere, too."""
    return shared_portions(_texts(spark, d)).withColumnRenamed("id", "doc_id")


QUERIES = {f.__name__: f for f in (p1_found, p1_redacted, p2_found, p4_found, p4_rates, p3_found, p3_groups, p5_found, p6_found, p6_counts, p7_found, p7_items, p8_mixture, p8_shares, p8_capped, p9_found, p9_shared)}
# SQL that finds the same by brute force, on small tables
def s_norm(c: str) -> str:
    return f"regexp_replace(lower({c}), '[^\\p{{L}}\\p{{N}}]', '', 'g')"


def s_windows(text: str, size: str) -> str:
    return f"unnest(list_transform(range(1, length({text}) - {size} + 2), lambda i: hash(substr({text}, i, {size}))))"


def s_similar(records: str) -> str:
    """Pairs ``x < y`` of ``records(grp, id, t)`` with similarity of at least 0.7 over 5-character substrings."""
    return f"""rec AS ({records}), sub AS (SELECT DISTINCT grp, id, h FROM (SELECT grp, id, {s_windows('t', '5')} AS h FROM rec)), num AS (SELECT grp, id, count(*) AS n FROM sub GROUP BY ALL),
    both_ AS (SELECT a.grp, a.id AS x, b.id AS y, count(*) AS c FROM sub a JOIN sub b ON a.grp = b.grp AND a.h = b.h AND a.id < b.id GROUP BY ALL),
    sim AS (SELECT both_.grp, x, y FROM both_ JOIN num p ON p.grp = both_.grp AND p.id = x JOIN num q ON q.grp = both_.grp AND q.id = y WHERE c::DOUBLE / (p.n + q.n - c) >= 0.7::DOUBLE)"""


S_SPLITS = s_similar(f"SELECT 1 AS grp, ord AS id, {s_norm("coalesce(instruction, '') || chr(10) || coalesce(output, '')")} AS t FROM eval_medical_qa_rag") + """,
    cross_ AS (SELECT x, y, a.split = 'train' AS first FROM sim JOIN eval_medical_qa_rag a ON a.ord = x JOIN eval_medical_qa_rag b ON b.ord = y WHERE coalesce(a.split = 'train', false) <> coalesce(b.split = 'train', false))"""
S_LEAKS = f"""it AS (SELECT item_id, CASE WHEN lang = 'zh' THEN {RUN['zh']} ELSE {RUN['en']} END AS k, {s_norm('text')} AS t FROM heldout_items WHERE text IS NOT NULL), dn AS (SELECT doc_id, source, {s_norm('text')} AS t FROM documents WHERE text IS NOT NULL),
    iw AS (SELECT item_id, k, {s_windows('t', 'k')} AS h FROM it), dw AS ({" UNION ALL ".join(f"SELECT doc_id, {k} AS k, {s_windows('t', str(k))} AS h FROM dn" for k in RUN.values())}),
    leak AS (SELECT DISTINCT doc_id, item_id FROM dw JOIN iw USING (k, h))"""
S_SPANS = f"sp AS (SELECT doc_id, unnest(range(1, length(text) - {LEAST} + 2)) AS pos, {s_windows('text', str(LEAST))} AS h FROM documents)"

S_RECORDS = s_similar(
    f"SELECT 'medical_qa' AS grp, ord AS id, {s_norm("coalesce(question, '') || chr(10) || coalesce(answer, '')")} AS t FROM medical_qa UNION ALL SELECT 'mimic_report_en', row_idx, {s_norm("coalesce(findings, '')")} FROM mimic_report_en"
)

ORACLE: dict[str, str] = {
    "p3_found": f"WITH {S_RECORDS} SELECT grp AS tbl, x AS id_a, y AS id_b FROM sim",
    "p6_found": f"WITH {S_SPLITS} SELECT x AS ord_a, y AS ord_b FROM cross_",
    "p6_counts": f"""WITH {S_SPLITS} SELECT split, source, count(*) AS n_pairs, count(DISTINCT ord) AS n_records FROM cross_ JOIN eval_medical_qa_rag ON ord = CASE WHEN first THEN y ELSE x END GROUP BY ALL""",
    "p7_found": f"WITH {S_LEAKS} SELECT doc_id, item_id FROM leak",
    "p7_items": f"WITH {S_LEAKS} SELECT item_id, count(*) AS n_documents, count(DISTINCT coalesce(source, '')) AS n_sources FROM leak JOIN documents USING (doc_id) GROUP BY item_id",
    "p9_found": f"WITH {S_SPANS} SELECT DISTINCT a.doc_id AS doc_a, b.doc_id AS doc_b FROM sp a JOIN sp b ON a.h = b.h AND a.doc_id < b.doc_id",
    "p9_shared": f"""WITH {S_SPANS}, many AS (SELECT h FROM sp GROUP BY h HAVING count(DISTINCT doc_id) > 1), st AS (SELECT doc_id, pos, lead(pos) OVER (PARTITION BY doc_id ORDER BY pos) AS next FROM sp WHERE h IN (FROM many)),
    cv AS (SELECT doc_id, sum(least({LEAST}, coalesce(next - pos, {LEAST})))::BIGINT AS shared_chars FROM st GROUP BY doc_id)
    SELECT doc_id, length(text) AS n_chars, shared_chars, shared_chars / length(text) AS share FROM cv JOIN documents USING (doc_id)""",
}
