"""Text functions as native column expressions. Null counts as empty where the name says ``clean``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HAN = r"一-鿿"


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, however often ``body`` speaks of it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def pystrip(c: Column) -> Column:
    """Strip all Unicode white space (``trim`` knows only the space)."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def clean(c: Column | str) -> Column:
    """Stripped text; null becomes empty."""
    return F.coalesce(pystrip(F.col(c) if isinstance(c, str) else c), F.lit(""))


def squeeze(c: Column) -> Column:
    """Runs of white space become one space, none at the ends; null becomes empty."""
    return F.coalesce(pystrip(F.regexp_replace(c, r"(?U)\s+", " ")), F.lit(""))


def chars(c: Column) -> Column:
    return F.filter(F.split(c, ""), lambda x: x != "")


def mixed_tokens(c: Column) -> Column:
    """Han runs of up to three characters and alphanumeric words; characters too where these are under three."""
    def parts(t: Column) -> Column:
        return F.regexp_extract_all(t, F.lit(f"([{HAN}]{{1,3}}|[a-z0-9]+)"), F.lit(1))

    def more(t: Column) -> Column:
        return let(parts(t), lambda p: F.when(F.size(p) < 3, F.concat(p, chars(F.replace(t, F.lit(" "), F.lit(""))))).otherwise(p))

    full = let(F.lower(pystrip(F.coalesce(c, F.lit("")))), more)
    full = let(full, lambda p: F.when(F.size(p) == 0, F.array(F.lit("_"))).otherwise(p))
    return F.when(F.coalesce(c, F.lit("")) == "", F.array().cast("array<string>")).otherwise(full)


def bm25_tokens(c: Column) -> Column:
    """Alphanumeric words and single Han characters, lower case."""
    return F.transform(F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(f"([a-zA-Z0-9]+|[{HAN}])"), F.lit(1)), F.lower)


def top_char_share(c: Column) -> Column:
    """Share of the most frequent character; null for empty text."""
    def most(t: Column) -> Column:
        return F.array_max(F.transform(F.array_distinct(chars(t)), lambda x: F.length(t) - F.length(F.replace(t, x, F.lit("")))))

    return let(c, lambda t: F.try_divide(most(t), F.length(t)))


def crowded(t: Column, share: float) -> Column:
    """Whether one character is more than ``share`` of a text.

    In the sorted characters such a run covers a multiple of ``share`` of the length, so only the
    characters at these places are counted.
    """
    def test(s: Column) -> Column:
        step = F.greatest(F.lit(1), F.floor(F.length(t) * share).cast("int"))
        places = F.sequence(F.lit(0), F.lit(int(1 / share) + 1))
        return F.exists(places, lambda i: F.length(t) - F.length(F.replace(t, F.get(s, i * step), F.lit(""))) > share * F.length(t))

    return let(F.array_sort(chars(t)), test)


def low_quality(c: Column) -> Column:
    """Very short, short without a full stop, one character repeated, or a run of placeholders."""
    def test(t: Column) -> Column:
        n = F.length(t)
        return (
            (n < 12)
            | ((n < 40) & ~t.contains("。") & ~t.contains("."))
            | t.rlike(r"(?i)(测试|test|TODO|待补充|不知道){3,}")
            | F.coalesce(crowded(t, 0.34), F.lit(False))
        )

    return let(clean(c), test)


def collapse_whitespace(c: Column) -> Column:
    t = F.regexp_replace(F.regexp_replace(c, "\r\n?", "\n"), "[ \t　]+", " ")
    return pystrip(F.regexp_replace(t, "\n{3,}", "\n\n"))


def strip_think(c: Column) -> Column:
    """Without redacted thinking blocks and bare thinking tags."""
    blocks = F.regexp_replace(pystrip(c), r"(?i)<redacted_thinking>[\s\S]*?</redacted_thinking>", "")
    return pystrip(F.regexp_replace(blocks, r"(?i)</?think>", ""))


def after_think(c: Column) -> Column:
    """What follows the last redacted thinking block."""
    return pystrip(F.regexp_replace(c, r"(?s)^.*</redacted_thinking>", ""))


def qa_sentences(c: Column) -> Column:
    """Sentences of a question or answer of at least four characters; else the whole text."""
    parts = F.filter(F.transform(F.split(c, r"(?<=[。！？!?])\s*|\n+"), pystrip), lambda x: F.length(x) >= 4)
    whole = pystrip(c)
    alone = F.when(whole != "", F.array(whole)).otherwise(F.array().cast("array<string>"))
    return let(parts, lambda p: F.when(F.size(p) > 0, p).otherwise(alone))


def report_sentences(c: Column) -> Column:
    """Sentences of a report of 8 to 260 characters, section headers dropped."""
    t = F.replace(F.regexp_replace(c, r"(?i)\b(FINDINGS|IMPRESSION|CONCLUSION)\s*:", " "), F.lit("\r"), F.lit("\n"))
    parts = F.split(t, r"(?<=[.!?。！？；;])\s+|\n+|(?<=。)")
    parts = F.transform(parts, lambda s: F.regexp_replace(F.regexp_replace(s, r"(?U)\s+", " "), r"^[ \-\t]+|[ \-\t]+$", ""))
    return F.filter(parts, lambda s: F.length(s).between(8, 260))


def dedup_key(*columns: Column) -> Column:
    return F.sha2(F.concat_ws("\n", *[squeeze(c) for c in columns]), 256)


def draw(key: Column, seed: int, sides: int = 1000) -> Column:
    """A number from 0 to sides - 1 by key and seed, the same in every partitioning."""
    digest = F.md5(F.concat_ws("|", key.cast("string"), F.lit(str(seed))))
    return F.pmod(F.conv(F.substring(digest, 1, 8), 16, 10).cast("long"), F.lit(sides))


def stable_id(*parts: Column) -> Column:
    return F.substring(F.sha1(F.concat_ws("||", *parts)), 1, 12)


def hamming(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def resolve_path(c: Column, folder: str) -> Column:
    """Absolute paths and addresses as they are, others below ``folder``."""
    return F.when(c.rlike(r"^(/|https?://)"), c).otherwise(F.concat(F.lit(folder.rstrip("/") + "/"), c))


def first_path(paths: Column, folder: str) -> Column:
    """The first of several paths, resolved."""
    return resolve_path(F.get(paths, F.lit(0)), folder)


def is_video(c: Column) -> Column:
    return F.lower(c).rlike(r"\.(mp4|avi|mov|mkv|webm)$")
