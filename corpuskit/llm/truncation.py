"""Text cut off by field limits (problem 4).

A value that doesn't end with a sentence end is *open*. Tries over the whole corpus (corpus_trie.py)
and the lengths of the values say whether an open value was cut:

* word trie: the last word is no known word (words hardly ever end at its node) but a proper prefix
  of known ones. For Chinese, where no blanks divide words, a word is a run of characters between marks;
* ending trie: of all places where the text before reads like the last characters of the value, the
  share at which a sentence ends. The longest node seen often enough counts; between clear and likely,
  the nodes of the clause (how it begins and ends) decide, the most special one seen often enough;
* length evidence: of the values of this length, cut marks aside, far more are surely cut than of the
  lengths around it, as with a field limit. It lowers what the ending trie has to say, no more.

An open value that no trie knows anything about is no case. A last piece that follows at least CLOSING
different texts word for word, and begins no complete sentence, is a closing phrase.

Defined cases: null, blank and mark-up only values are no case; a complete sentence without its full
stop or with a closing phrase is none; values of any length are read whole; rows without a group are
ignored; repeated rows come out once; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, sieve
from .corpus_trie import OPEN_SCHEMA, node_counts, open_values

SURE, UNSURE = 0.1, 0.95
CLEAR = 0.03  # an ending node that says less needs no clause node to confirm it
NEAR = 10
CLOSING = 3  # different texts that a closing phrase follows
SEEN = 6  # occurrences of an ending node that count
KNOWN = 0.01  # a known word ends at least at this share of the words that begin like it


def _opened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield open_values(batch)


def judged(open_: DataFrame, df: DataFrame) -> DataFrame:
    """Open values with ``p``, the probability that they are complete, from the tries over all of ``df``."""
    closing = cut(
        open_.filter("piece is not null").groupBy("piece", "piece_len").agg(F.count_distinct("before").alias("n"))
        .filter(F.col("n") >= CLOSING).select("piece", "piece_len")
    )
    asked = open_.select(F.explode(F.concat("nodes", "clauses")).alias("node")).union(open_.select("word")).union(closing.select("piece"))
    known = sieve(asked.filter("node is not null").distinct(), "node")
    lengths = [sorted(r[0] for r in t.filter(f"{c} is not null").select(c).distinct().collect()) for t, c in ((open_, "word_len"), (closing, "piece_len"))]
    counts = cut(
        df.select("grp", "text").filter("text is not null").mapInArrow(node_counts(known, *lengths), "node long, n long, ended long")
        .groupBy("node").agg(F.sum("n").alias("n"), F.sum("ended").alias("ended"))
    )
    share = (F.col("ended") + 0.25) / (F.col("n") + 0.5)
    seen = counts.filter(F.col("n") >= SEEN)

    def longest(column: str, name: str) -> DataFrame:
        """What the longest node that was seen often enough says about each value."""
        asked = open_.select("uid", F.posexplode(column).alias("at", "node"))
        return asked.join(seen, "node").groupBy("uid").agg(F.max_by(share, "at").alias(name), F.max("at").alias(f"{name}_at"))

    word = counts.select(F.col("node").alias("word"), F.col("n").alias("word_n"), F.col("ended").alias("word_ended"))
    begun = counts.select(F.col("node").alias("piece"), F.lit(True).alias("begins"))
    closer = closing.join(begun, "piece", "left_anti").select("piece", F.lit(True).alias("closes"))
    p = F.coalesce("end", F.lit(0.5))
    p = F.when((p >= CLEAR) & (p < 0.6) & (F.col("clause_at") > 0), F.col("clause")).when(p < 0.6, F.least(p, "clause")).otherwise(p)
    stub = (F.col("word_n") - F.col("word_ended") >= SEEN) & (F.col("word_ended") < KNOWN * F.col("word_n"))
    p = F.when(stub & (~F.col("han") | (p < 0.5)), F.least(p, F.lit(0.01))).otherwise(p)
    return (
        open_.dropDuplicates(["uid"]).join(longest("nodes", "end"), "uid", "left").join(longest("clauses", "clause"), "uid", "left").join(word, "word", "left")
        .join(closer, "piece", "left").filter("closes is null")
        .select("grp", "id", "len", F.when(F.col("goes_on"), F.lit(0.0)).otherwise(p).alias("p"))
    )


def cut_values(open_: DataFrame, df: DataFrame) -> DataFrame:
    """``grp, id`` of the open values that are cut."""
    rows = cut(judged(open_, df))
    around = Window.partitionBy("grp").orderBy("len").rangeBetween(-NEAR, NEAR)
    lengths = (
        rows.groupBy("grp", "len").agg(F.count_if(F.col("p") < SURE).alias("sure"))
        .withColumn("near", F.sum("sure").over(around) - F.col("sure"))
        .withColumn("limit", (F.col("sure") >= 5) & (F.col("sure") > 5 * F.col("near") / (2 * NEAR)))
        .select("grp", "len", "limit")
    )
    return rows.join(lengths, ["grp", "len"]).filter((F.col("p") < SURE) | F.col("limit") & (F.col("p") < UNSURE)).select("grp", "id").distinct()


def truncated(df: DataFrame) -> DataFrame:
    """``df(grp, id, text)`` -> ``grp, id`` of the values that are cut."""
    df = df.select("grp", "id", "text").filter("grp is not null")
    return cut_values(cut(df.filter("text is not null").mapInArrow(_opened, OPEN_SCHEMA)), df)
