"""Inverted index, BM25, vector search, fusion of scores, context packing."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpuskit.functions.text import bm25_tokens, clean

from .shape import qa_chunk

K1, B = 1.5, 0.75
MOST_QUERIES = 20_000

# Fixed value: the prompt with its safety rules.
PROMPT = """你是医学问答助手。请严格基于下面的参考资料回答用户问题。
如果资料不足，请说明“当前资料不足，建议结合医生面诊或检查结果判断”。
不要编造诊断、药物剂量、检查结论。

医疗安全规则：
1. 不能把参考资料中的“可能”改成“确诊”。
2. 涉及用药、剂量、停药、换药，必须提示遵医嘱。
3. 涉及胸痛、呼吸困难、意识障碍、大出血、孕产急症等，要提示及时就医。
4. 检索不到可靠资料时，不要强答。
5. 回答末尾用“参考依据：片段1、片段2”标明依据，便于审计。

参考资料：
{retrieved_context}

用户问题：
{question}

回答："""


Tokenize = Callable[[Column], Column]


def postings(df: DataFrame, tokenize: Tokenize = bm25_tokens) -> DataFrame:
    """``df(doc_id, text)`` -> ``(token, doc_id, tf)``."""
    return df.select("doc_id", F.explode(tokenize(F.col("text"))).alias("token")).groupBy("token", "doc_id").agg(F.count(F.lit(1)).alias("tf"))


def doc_stats(df: DataFrame, tokenize: Tokenize = bm25_tokens) -> DataFrame:
    return df.select("doc_id", F.size(tokenize(F.col("text"))).cast("long").alias("dl"))


def idf_table(post: DataFrame, n_docs: DataFrame) -> DataFrame:
    """``(token, df, idf)``; ``n_docs(n)`` is one row."""
    df = post.groupBy("token").agg(F.count(F.lit(1)).alias("df"))
    return df.join(F.broadcast(n_docs)).select("token", "df", F.log(1 + (F.col("n") - F.col("df") + 0.5) / (F.col("df") + 0.5)).alias("idf"))


TOKEN = re.compile(r"[a-zA-Z0-9]+|[一-鿿]")


def _tokens(text: str) -> list[str]:
    return [t.lower() for t in TOKEN.findall(text)]


def _asked(queries: DataFrame, most: int) -> list[tuple[int, str]]:
    """A stated query set, read once; more than ``most`` raise an error."""
    rows = queries.select("qid", "query").limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} queries; pass them in parts")
    return sorted((r["qid"], r["query"] or "") for r in rows)


def _text_topk(
    queries: list[tuple[int, str]], docs: DataFrame, k: int, weights: Callable[[str], dict[str, float]], impacts: Callable[[str, dict[str, int]], list[tuple[int, float]]],
    zeros: bool = False, block: int = 512, step: int = 512,
) -> DataFrame:
    """Scores of all ``docs(doc_id, text)`` for a stated query set, a block of queries at a time.

    Map-only: a task turns its documents into rows over the block's terms, multiplies them with the
    block, and passes on its best ``k`` a query. Only those are shuffled.
    """
    blocks = []  # what ships with the task grows with the queries' terms, not with their vocabulary squared
    for at in range(0, len(queries), block):
        part = [(q, weights(t)) for q, t in queries[at : at + block]]
        vocab = {t: i for i, t in enumerate(sorted({t for _, w in part for t in w}))}
        cells = [(i, vocab[t], x) for i, (_, w) in enumerate(part) for t, x in w.items()]
        where = np.array([(i, j) for i, j, _ in cells], np.int32).reshape(-1, 2)
        blocks.append((np.array([q for q, _ in part], np.int64), vocab, where, np.array([x for _, _, x in cells], np.float64)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for qids, vocab, where, values in blocks:
                matrix = np.zeros((len(qids), len(vocab)))
                matrix[where[:, 0], where[:, 1]] = values
                for at in range(0, whole.num_rows, step):
                    batch = whole.slice(at, step)
                    ids, texts = batch.column("doc_id").to_numpy(zero_copy_only=False), batch.column("text").to_pylist()
                    rows = np.zeros((len(texts), len(vocab)))
                    for i, t in enumerate(texts):
                        for j, x in impacts(t or "", vocab):
                            rows[i, j] = x
                    score = np.round(matrix @ rows.T, 6)
                    best = np.lexsort((np.broadcast_to(ids, score.shape), -score), axis=1)[:, :k]
                    out = np.repeat(qids, best.shape[1]), ids[best].ravel(), np.take_along_axis(score, best, 1).ravel()
                    keep = (out[2] > 0) | zeros
                    yield pa.RecordBatch.from_arrays([pa.array(x[keep]) for x in out], names=["qid", "doc_id", "score"])

    return ranked(docs.select("doc_id", "text").mapInArrow(run, "qid long, doc_id long, score double"), k)


def bm25_topk(queries: DataFrame, docs: DataFrame, k: int = 8, most: int = MOST_QUERIES) -> DataFrame:
    """``queries(qid, query)`` x ``docs(doc_id, text)`` -> ``(qid, doc_id, score, rank)``.

    Document frequencies of the queries' terms and the mean length are counted over all documents; a
    query's repeated token counts as often as it stands there. Only positive scores are hits.
    """
    asked = _asked(queries, most)
    terms = sorted({t for _, q in asked for t in _tokens(q)})
    spark = docs.sparkSession
    vocabulary = spark.createDataFrame([(t,) for t in terms], "token string")
    each = docs.select(F.explode(F.array_distinct(bm25_tokens(F.col("text")))).alias("token"))
    df = {r["token"]: r["n"] for r in each.join(vocabulary, "token").groupBy("token").agg(F.count(F.lit(1)).alias("n")).collect()}
    totals = doc_stats(docs).agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.avg("dl"), F.lit(0.0)).alias("avgdl")).first()
    n, mean = totals["n"], totals["avgdl"]
    idf = {t: math.log(1 + (n - x + 0.5) / (x + 0.5)) for t, x in df.items()}

    def weights(text: str) -> dict[str, float]:
        return {t: c * idf[t] for t, c in Counter(_tokens(text)).items() if t in idf}

    def impacts(text: str, vocab: dict[str, int]) -> list[tuple[int, float]]:
        tokens = _tokens(text)
        base = K1 * (1 - B + B * len(tokens) / mean) if mean > 0 else K1
        return [(vocab[t], c * (K1 + 1) / (c + base)) for t, c in Counter(tokens).items() if t in vocab]

    return _text_topk(asked, docs, k, weights, impacts)


def ranked(scored: DataFrame, k: int) -> DataFrame:
    """Best ``k`` of each query, ties by id; Spark's group limit keeps each task's best before the shuffle."""
    w = Window.partitionBy("qid").orderBy(F.desc("score"), "doc_id")
    return scored.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def vector_topk(queries: DataFrame, docs: DataFrame, k: int = 8, block: int = 1024, most: int = MOST_QUERIES) -> DataFrame:
    """``queries(qid, vec)`` against all ``docs(doc_id, vec)`` by inner product -> ``(qid, doc_id, score, rank)``.

    The stated query set is taken in blocks: each task multiplies its rows with a block at a time and
    passes on its best ``k`` a query only. More than ``most`` queries raise an error.
    """
    rows = queries.select("qid", "vec").limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} queries; pass them in parts")
    ids = [r["qid"] for r in rows]
    matrix = np.array([r["vec"] for r in rows], np.float64).reshape(len(rows), -1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows or not ids:
                continue
            docs_ = batch.column("doc_id").to_numpy(zero_copy_only=False)
            vecs = np.stack([np.asarray(v, np.float64) for v in batch.column("vec").to_pylist()])
            for at in range(0, len(ids), block):
                s = np.round(matrix[at : at + block] @ vecs.T, 6)
                best = np.lexsort((np.broadcast_to(docs_, s.shape), -s), axis=1)[:, :k]
                out = [np.repeat(ids[at : at + block], best.shape[1]), docs_[best].ravel(), np.take_along_axis(s, best, 1).ravel()]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in out], names=["qid", "doc_id", "score"])

    return ranked(docs.select("doc_id", "vec").mapInArrow(run, "qid long, doc_id long, score double"), k)


def char_overlap_topk(queries: DataFrame, docs: DataFrame, k: int = 8, most: int = MOST_QUERIES) -> DataFrame:
    """Number of distinct characters shared; documents that share none fill up the places, the smallest ids first."""
    return _text_topk(
        _asked(queries, most), docs, k,
        lambda text: dict.fromkeys(text, 1.0), lambda text, vocab: [(vocab[c], 1.0) for c in set(text) if c in vocab], zeros=True,
    )


def minmax(scores: DataFrame) -> DataFrame:
    """Scores of each query on 0..1; all equal: 1."""
    w = Window.partitionBy("qid")
    lo, hi = F.min("score").over(w), F.max("score").over(w)
    close = F.abs(hi - lo) <= 1e-9 * F.greatest(F.abs(hi), F.abs(lo))
    return scores.withColumn("norm", F.when(close, F.lit(1.0)).otherwise((F.col("score") - lo) / (hi - lo)))


def hybrid(
    question_scores: DataFrame, doc_scores: DataFrame, bm25_scores: DataFrame, low: DataFrame,
    question_weight: float = 0.7, doc_weight: float = 0.3, bm25_weight: float = 0.25, penalty: float = 0.85,
    threshold: float | None = None, top: int = 3, rerank: Callable[[Column, Column], Column] | None = None, texts: DataFrame | None = None,
    queries: DataFrame | None = None,
) -> DataFrame:
    """Fuse three score lists ``(qid, doc_id, score)``; ``low(doc_id, low_quality)`` demotes.

    One union and one aggregation instead of two outer joins. With ``rerank`` a model scores the
    candidates' ``texts(doc_id, text)`` against ``queries(qid, query)``, and its score, demoted alike,
    decides. When the best candidate of a query is under the threshold the query has no result.
    """
    zero = F.lit(0.0)
    names = ("question_score", "doc_score", "bm25_norm")
    parts = [
        s.select("qid", "doc_id", *[(F.col(c) if n == name else zero).alias(n) for n in names])
        for s, name, c in ((question_scores, "question_score", "score"), (doc_scores, "doc_score", "score"), (minmax(bm25_scores), "bm25_norm", "norm"))
    ]
    each = parts[0].unionByName(parts[1]).unionByName(parts[2]).groupBy("qid", "doc_id").agg(*[F.sum(c).alias(c) for c in names])
    each = each.join(low.select("doc_id", "low_quality"), "doc_id", "left")
    mixed = question_weight * F.col("question_score") + doc_weight * F.col("doc_score") + bm25_weight * F.col("bm25_norm")
    if rerank is not None:
        each = each.join(texts.select("doc_id", F.col("text").alias("_text")), "doc_id").join(queries.select("qid", F.col("query").alias("_query")), "qid")
        mixed = rerank(F.col("_query"), F.col("_text"))
    weight = F.when(F.coalesce("low_quality", F.lit(False)), penalty).otherwise(1.0)
    each = each.withColumn("score", F.round(mixed * weight, 10)).drop("_text", "_query")
    w = Window.partitionBy("qid").orderBy(F.desc("score"), "doc_id")
    out = each.withColumn("final_rank", F.row_number().over(w)).withColumn("best", F.max("score").over(Window.partitionBy("qid")))
    if threshold is not None:
        out = out.filter(F.col("best") >= threshold)
    return out.filter(F.col("final_rank") <= top).drop("best")


def depth(top_k: int, vector_top_k: int | None = None, bm25_top_k: int | None = None) -> tuple[int, int]:
    """How deep the two searches go: their own depth, or ``top_k`` where that is none or 0."""
    return vector_top_k or top_k, bm25_top_k or top_k


INDEX = ("docs", "postings", "stats", "idf", "question_vectors", "doc_vectors")


def retrieval_docs(df: DataFrame) -> DataFrame:
    """``ord, instruction, input, output`` -> documents of an index; rows without question or answer are dropped."""
    q, a = clean("instruction"), clean("output")
    low = F.coalesce(F.col("_low_quality_flag"), F.lit(False)) if "_low_quality_flag" in df.columns else F.lit(False)
    return df.filter((q != "") & (a != "")).select(
        F.col("ord").alias("doc_id"), qa_chunk(F.col("instruction"), F.col("input"), F.col("output")).alias("text"),
        q.alias("question"), a.alias("answer"), clean("input").alias("input"), low.alias("low_quality"),
    )


def write_index(docs: DataFrame, path: str, embed: Callable[[Column], Column], k1: float = K1, b: float = B, tokenize: Tokenize = bm25_tokens) -> None:
    """An index of ``retrieval_docs`` below a shared folder, as tables: texts, postings with their documents'
    lengths, idf, vectors of question and text, and one row of parameters. Any earlier index there is replaced."""
    spark = docs.sparkSession
    post, n = postings(docs, tokenize), doc_stats(docs, tokenize)
    totals = n.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.avg("dl"), F.lit(0.0)).alias("avgdl"))
    tables = {
        "docs": docs, "postings": post.join(n, "doc_id"), "idf": idf_table(post, totals.select("n")),
        "stats": totals.withColumns({"k1": F.lit(k1), "b": F.lit(b)}),
        "question_vectors": docs.select("doc_id", embed(F.col("question")).alias("vec")), "doc_vectors": docs.select("doc_id", embed(F.col("text")).alias("vec")),
    }
    for name, table in tables.items():
        table.write.mode("overwrite").parquet(f"{path.rstrip('/')}/{name}")
    spark.catalog.clearCache()


def read_index(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """The tables of an index; without vectors of the questions those of the texts stand for both."""
    out = {}
    for name in INDEX:
        try:
            out[name] = spark.read.parquet(f"{path.rstrip('/')}/{name}")
        except AnalysisException:
            if name != "question_vectors":
                raise
    out.setdefault("question_vectors", out["doc_vectors"])
    return out


def indexed_bm25(queries: DataFrame, index: dict[str, DataFrame], k: int = 8, most: int = MOST_QUERIES, tokenize: Tokenize = bm25_tokens) -> DataFrame:
    """BM25 over a stored index: an equi-join of query tokens and postings.

    Only the postings of the queries' tokens are read on; scores are summed per query and document with
    map-side combine. A token of many queries or documents is split by adaptive skew handling.
    """
    if queries.limit(most + 1).count() > most:
        raise ValueError(f"more than {most} queries; pass them in parts")
    asked = queries.select("qid", F.explode(tokenize(F.col("query"))).alias("token")).groupBy("qid", "token").agg(F.count(F.lit(1)).alias("times"))
    base = F.col("k1") * (1 - F.col("b") + F.col("b") * F.col("dl") / F.col("avgdl"))
    impact = F.col("times") * F.col("idf") * F.col("tf") * (F.col("k1") + 1) / (F.col("tf") + F.when(F.col("avgdl") > 0, base).otherwise(F.col("k1")))
    hits = index["postings"].join(asked, "token").join(index["idf"].select("token", "idf"), "token").join(F.broadcast(index["stats"]))
    scored = hits.groupBy("qid", "doc_id").agg(F.round(F.sum(impact), 6).alias("score"))
    return ranked(scored.filter("score > 0"), k)


def search_index(
    queries: DataFrame, index: dict[str, DataFrame], embed: Callable[[Column], Column], top_k: int = 8, vector_top_k: int | None = None,
    bm25_top_k: int | None = None, **options,
) -> DataFrame:
    """Hybrid search of ``queries(qid, query)`` over a stored index; ``options`` are those of ``hybrid``."""
    deep, broad = depth(top_k, vector_top_k, bm25_top_k)
    asked = queries.select("qid", embed(F.col("query")).alias("vec"))
    if options.get("rerank") is not None:
        options |= {"texts": index["docs"].select("doc_id", "text"), "queries": queries}
    return hybrid(
        vector_topk(asked, index["question_vectors"], deep), vector_topk(asked, index["doc_vectors"], deep), indexed_bm25(queries, index, broad),
        index["docs"].select("doc_id", "low_quality"), **options,
    )


def pack_context(hits: DataFrame, budget: int = 4000, first_always: bool = True, separator: str = "\n\n---\n\n", empty: str = "无可用参考资料。", score: str | None = None) -> DataFrame:
    """``hits(qid, rank, block)`` -> ``(qid, context)``: blocks in rank order until the budget overflows.

    With ``score`` hits whose score isn't positive are passed over.

    Block lengths never fall, so stopping at the first overflow is a bound on the running sum.
    """
    w = Window.partitionBy("qid").orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)
    some = hits.filter(F.col(score) > 0) if score else hits
    sums = some.withColumn("upto", F.sum(F.length("block")).over(w)).withColumn("first", F.min("rank").over(Window.partitionBy("qid")))
    fit = F.col("upto") <= budget
    keep = fit | (F.col("rank") == F.col("first")) if first_always else fit
    kept = sums.filter(keep).groupBy("qid").agg(F.array_sort(F.collect_list(F.struct("rank", "block"))).alias("blocks"))
    text = F.array_join(F.transform("blocks", lambda b: b["block"]), separator)
    return hits.select("qid").distinct().join(kept, "qid", "left").select("qid", F.coalesce(text, F.lit(empty)).alias("context"))


def hit_block(rank: Column, doc_id: Column, line: Column, score: Column, text: Column, low: Column) -> Column:
    head = F.format_string("[片段%d] doc_id=%s line=%s score=%.4f", rank, doc_id.cast("string"), line.cast("string"), score)
    return F.concat(head, F.when(low, F.lit(" low_quality=true")).otherwise(F.lit("")), F.lit("\n"), text)


def chunk_block(source: Column, chunk_id: Column, text: Column) -> Column:
    """A block of a knowledge base under its header."""
    return F.concat(F.format_string("[%s #%s]\n", source.cast("string"), chunk_id.cast("string")), text)


def prompt(context: Column, question: Column) -> Column:
    return F.replace(F.replace(F.lit(PROMPT), F.lit("{retrieved_context}"), context), F.lit("{question}"), question)


def chunk_text(text: Column, max_chars: int = 800, overlap: int = 100) -> Column:
    """Paragraphs packed up to ``max_chars``; a longer paragraph is cut with overlap."""
    if overlap >= max_chars:
        raise ValueError("overlap must be under max_chars")
    from corpuskit.functions.text import pystrip

    paragraphs = F.filter(F.transform(F.split(text, r"\n\s*\n"), pystrip), lambda p: p != "")
    step = max_chars - overlap
    cuts = lambda p: F.transform(F.sequence(F.lit(0), F.length(p) - 1, F.lit(step)), lambda i: F.substring(p, i + 1, F.lit(max_chars)))
    state = F.struct(F.array().cast("array<string>").alias("done"), F.lit("").alias("buf"))

    def fold(acc: Column, p: Column) -> Column:
        fits = F.length(acc["buf"]) + F.length(p) + 1 <= max_chars
        flushed = F.when(acc["buf"] != "", F.concat(acc["done"], F.array(acc["buf"]))).otherwise(acc["done"])
        joined = F.when(acc["buf"] == "", p).otherwise(F.concat(acc["buf"], F.lit("\n\n"), p))
        short = F.length(p) <= max_chars
        done = F.when(fits, acc["done"]).when(short, flushed).otherwise(F.concat(flushed, cuts(p)))
        return F.struct(done.alias("done"), F.when(fits, joined).when(short, p).otherwise(F.lit("")).alias("buf"))

    finish = lambda acc: F.when(acc["buf"] != "", F.concat(acc["done"], F.array(acc["buf"]))).otherwise(acc["done"])
    return F.aggregate(paragraphs, state, fold, finish)


GRAM_WORD = re.compile(r"\w+")


def char_grams(text: str, low: int = 2, high: int = 4) -> Counter:
    """Character n-grams inside words padded by a space, lower case."""
    out: Counter = Counter()
    for w in GRAM_WORD.findall(text.lower()):
        w = f" {w} "
        for n in range(low, high + 1):
            out.update(w[i : i + n] for i in range(len(w) - n + 1))
    return out


def tfidf_topk(queries: DataFrame, docs: DataFrame, k: int = 8, low: int = 2, high: int = 4, features: int = 200_000, most: int = MOST_QUERIES) -> DataFrame:
    """Cosine of smoothed TF-IDF weights of character n-grams, of the ``features`` most frequent ones.

    Weights and norms are counted over all documents in two linear passes; then a stated query set is
    scored against each document in one map-only pass, a block of queries at a time, so no pair of a
    query and a document is ever shuffled but the best ``k`` a task. The features come to the driver.
    """
    asked = _asked(queries, most)
    schema = "g string, tf long, df long"

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tf, df = Counter(), Counter()
            for t in batch.column("text").to_pylist():
                own = char_grams(t or "", low, high)
                tf.update(own)
                df.update(own.keys())
            yield pa.RecordBatch.from_pydict({"g": list(tf), "tf": list(tf.values()), "df": [df[g] for g in tf]}, pa.schema([("g", pa.string()), ("tf", pa.int64()), ("df", pa.int64())]))

    n = docs.count()
    each = docs.select("text").mapInArrow(counted, schema).groupBy("g").agg(F.sum("tf").alias("tf"), F.sum("df").alias("df"))
    idf = {r["g"]: math.log((1 + n) / (1 + r["df"])) + 1 for r in each.orderBy(F.desc("tf"), "g").limit(features).select("g", "df").collect()}

    def unit(text: str) -> dict[str, float]:
        w = {g: c * idf[g] for g, c in char_grams(text, low, high).items() if g in idf}
        norm = math.sqrt(sum(x * x for x in w.values()))
        return {g: x / norm for g, x in w.items()}

    return _text_topk(asked, docs, k, unit, lambda text, vocab: [(vocab[g], x) for g, x in unit(text).items() if g in vocab])
