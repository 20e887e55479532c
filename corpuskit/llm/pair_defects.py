"""Broken prompt and response pairs (problem 2).

At most one defect a pair, tested in this order: ``empty``; ``refusal`` (what the answer says besides
the question aligns with the frames of refusals and redirections, a refusal among them);
``copied_question`` (shingle containment proposes, the longest common subsequence confirms);
``wrong_language`` (script and function words of the answer differ from the question's, which asks for
no other language); ``truncated`` (truncation.py). One pass finds the defects and what the ends of the
other answers ask the corpus tries; a second one counts the tries.

Defined cases: a null or blank answer is empty; a null or blank question is never copied and asks for
no language; answers of any length are read whole; a pair too short for shingles is a copy only if
equal; repeated rows come out once.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut
from .corpus_trie import FOLD, OPEN_SCHEMA, TAG, open_values
from .truncation import cut_values

# Answers that say nothing.
FILLERS = frozenset("na none null nil nan tbd todo empty blank noanswer notavailable nodata unknown undefined 无 空 略 暂无 没有 无答案 无回答 无数据 暂缺 缺 待补充 待回复 未知 不详 答案 回答".split())
WIDE = re.compile("[Ａ-Ｚａ-ｚ]")  # full-width letters may write a label
LONGEST_FILLER = max(map(len, FILLERS))
LABEL = re.compile(r"^(?:answer|response|reply|output|a|the answer|答案?|回答|回复|医生回答|解答|答复)\s*[:：.]\s*", re.I)

# Frames of refusals, and of sentences that send the asker away.
REFUSALS = (
    "I am sorry but I cannot help with that",
    "I am unable to give medical advice here",
    "As an automated helper I am unable to answer that question",
    "I would rather not interpret reports please understand",
    "I would rather not give advice about medicines",
    "No answer can be given as it would mean to assess symptoms from afar",
    "My guidelines keep me from helping to comment on a case like this is off limits",
    "This request was declined we do not comment on a case like this",
    "This request was declined",
    "We do not answer that question",
    "Unfortunately nobody on this service is allowed to discuss personal health",
    "Sorry answering that question is beyond what I may do",
    "We must pass on this one and will not say anything about treatment",
    "I cannot answer this question",
    "I am not able to provide medical advice or a diagnosis",
    "As an AI language model I cannot provide medical advice",
    "抱歉我不能回答这个问题",
    "恕我不能提供用药建议",
    "对不起这里不允许讨论个人健康状况",
    "作为自动助手我没有办法解读检查报告",
    "很遗憾系统无法判断病情",
    "本平台不便在线诊断请谅解",
    "按照规定此处不予对治疗发表意见",
    "该问题已被过滤不支持提供用药建议",
    "这个我帮不上忙不会讨论个人健康状况",
    "我是人工智能无法提供医疗建议",
)
AWAY = (
    "Kindly contact a clinic",
    "Please ask elsewhere",
    "Try another topic",
    "Please understand",
    "Please see a doctor or consult your physician",
    "In an emergency call 911 or your local emergency number",
    "If this is an emergency please go to the nearest emergency room",
    "建议咨询线下医生",
    "请另寻帮助",
    "换个话题吧",
    "请谅解",
    "请咨询专业医生",
    "请及时到医院就诊",
    "如有紧急情况请拨打120",
)
# Proposes sentences only; plain strings, as they are sought in every answer.
CUES = (
    "不能", "无法", "不便", "不予", "不允许", "没有办法", "没办法", "不支持", "不会", "帮不上", "恕我", "拒绝", "不可以", "不方便", "抱歉", "对不起", "遗憾",
    "cannot", "can not", "can't", "can’t", "unable", "not able", "not allowed", "not permitted", "nobody", "declin", "off limits", "beyond what", "rather not",
    "will not", "won't", "won’t", "keep me from", "no answer", "pass on", "refuse", "must not", "may not", "do not", "does not", "don't", "don’t", "sorry", "unfortunately",
)
SHORT = tuple((re.compile(a), b) for a, b in (("’", "'"), (r"\bcan(?:'t| not)\b", "cannot"), (r"\bwon't\b", "will not"), (r"n't\b", " not"), (r"'m\b", " am"), (r"'d\b", " would"), (r"'re\b", " are")))
TOKEN = re.compile(r"[㐀-鿿]|[^\W_㐀-鿿]+")
SENTENCE = re.compile(r"[。!?;\n]+|\.(?:\s|$)")
ALIGNED, REFUSED, QUOTED = 0.6, 0.7, 4

ASKED = {
    "en": re.compile(r"(?:用|以|翻译成|译成)\s?(?:英文|英语)|\bin english\b", re.I),
    "zh": re.compile(r"(?:用|以)\s?(?:中文|汉语)|\bin (?:chinese|mandarin)\b", re.I),
    "es": re.compile(r"用西班牙|\bin spanish\b|en español", re.I),
    "fr": re.compile(r"用法[文语]|\bin french\b|en français", re.I),
    "de": re.compile(r"用德[文语]|\bin german\b|auf deutsch", re.I),
}
# Frequent function words, by language.
WORDS = {
    "en": frozenset("the of and to in is for with on that by or from was be at as are after it this than when may should not if without who had more every over".split()),
    "es": frozenset("el la los las de del que y en un una por con para se al cabo es lo como más personas mejora días".split()),
    "fr": frozenset("le la les des du de et en un une est pour par au aux que qui dans sur sont avec puis ans on à près".split()),
    "de": frozenset("der die das und ist den dem ein eine mit für von zu bei sollte auf nicht wird noch schon unter vor allem wenn".split()),
    "it": frozenset("il lo gli della di che è un una per con sono nel alla dei delle più".split()),
    "pt": frozenset("o os as do da dos das que e em um uma para com não por mais ao".split()),
}


NO_WORD = re.compile(r"[\W_]+")
HAN = re.compile(r"[㐀-鿿]")
KANA = re.compile(r"[぀-ヿ가-힯]")
LATIN = re.compile(r"[A-Za-zÀ-ɏ]+")


def plain(text: str) -> str:
    return re.sub(r"\s+", " ", TAG.sub(" ", text).translate(FOLD)).strip()


def squeeze(text: str) -> str:
    return NO_WORD.sub("", text.lower())


def is_empty(answer: str | None) -> bool:
    answer = answer or ""
    rest = plain(answer) if "<" in answer or "&" in answer or WIDE.search(answer) else answer
    while (m := LABEL.match(rest := rest.strip())) and m.end():
        rest = rest[m.end() :]
    said = 0
    for c in rest:  # more letters than any filler has end the test
        said += c.isalnum()
        if said > LONGEST_FILLER:
            return False
    return not said or squeeze(rest) in FILLERS


def language(text: str) -> str:
    """zh, en, es, ... by script first and function words second; "" where there is too little text."""
    if text.isascii():  # the usual cases without a regular expression
        split = text.lower().split()
        if split and sum(map(WORDS["en"].__contains__, split)) * 6 >= len(split):
            return "en"
    elif len(text.encode()) > 2.2 * len(text) and HAN.search(text) and not KANA.search(text):
        return "zh"
    han, words = len(HAN.findall(text)), LATIN.findall(text)
    latin = sum(map(len, words))
    if han * 3 >= latin and han > 1:  # a Han character says about as much as three Latin ones
        return "zh"
    if not latin:
        return "other" if any(c.isalpha() for c in text) else ""
    tokens = [w.lower() for w in words]
    english = sum(map(WORDS["en"].__contains__, tokens))
    if english * 6 >= len(tokens):
        return "en"
    if latin * 2 < sum(c.isalpha() for c in text):
        return "other"
    score = {k: sum(map(w.__contains__, tokens)) for k, w in WORDS.items()}
    best = max(score, key=lambda k: (score[k], k == "en"))
    return best if score[best] > 1 and score[best] > english else "en"


def common_subsequence(a: str | list[str], b: str | list[str]) -> int:
    """Length of the longest common subsequence, bit-parallel: one big-integer step an element."""
    if not a or not b:
        return 0
    where: dict[str, int] = {}
    for i, c in enumerate(a):
        where[c] = where.get(c, 0) | 1 << i
    full = (1 << len(a)) - 1
    v = full
    for c in b:
        u = v & where.get(c, 0)
        v = ((v + u) | (v - u)) & full
    return len(a) - v.bit_count()


def containment(a: str, b: str, enough: float, k: int = 5) -> bool:
    """Whether b has at least the share ``enough`` of a's k-character shingles."""
    n = max(1, len(a) - k + 1)
    known = b if len(b) <= 200 else {b[i : i + k] for i in range(len(b) - k + 1)}
    left = n - enough * n
    for i in range(n):
        if a[i : i + k] not in known:
            left -= 1
            if left < 0:
                return False
    return True


def unaligned(a: str, b: str) -> int:
    """How many characters of a don't align with b; what both begin and end with alike aligns."""
    n, i = min(len(a), len(b)), 0
    if a[:n] == b[:n]:
        i = n
    while i < n and a[i] == b[i]:
        i += 1
    j = 0
    while j < n - i and a[-1 - j] == b[-1 - j]:
        j += 1
    a, b = a[i : len(a) - j], b[i : len(b) - j]
    return len(a) - common_subsequence(a, b)


def tokens(text: str) -> list[str]:
    """Words of alphabetic scripts and single Han characters, short forms written out."""
    text = text.lower()
    for short, whole in SHORT:
        text = short.sub(whole, text)
    return TOKEN.findall(text)


def runs(words: list[str], k: int) -> set[tuple[str, ...]]:
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)}


def covered(words: list[str], known: set[tuple[str, ...]], k: int) -> list[bool]:
    """Which words stand in a run of k that is known."""
    hit = [False] * len(words)
    for i in range(len(words) - k + 1):
        if tuple(words[i : i + k]) in known:
            hit[i : i + k] = [True] * k
    return hit


DECLINING, SENDING = ([tokens(t) for t in frames] for frames in (REFUSALS, AWAY))
DECLINED, SENT = (set().union(*(runs(f, 2) for f in frames)) for frames in (DECLINING, SENDING))
EITHER = DECLINED | SENT


def alignment(words: list[str], frames: list[list[str]], known: set[tuple[str, ...]]) -> float:
    """Share of the words in word pairs of the frames (whose parts may be combined), or the longest
    common subsequence with one frame as a share of both."""
    contained = sum(covered(words, known, 2)) / len(words)
    if contained >= ALIGNED:
        return contained
    # frames so much shorter or longer that no alignment reaches the threshold are left out
    fit = (f for f in frames if 2 * min(len(words), len(f)) >= ALIGNED * (len(words) + len(f)))
    return max(contained, *(2 * common_subsequence(words, f) / (len(words) + len(f)) for f in fit), 0.0)


def has_cue(text: str) -> bool:
    return any(c in text for c in CUES)


def is_refusal(answer: str, question: str = "") -> bool:
    """Whether what the answer says besides quoting the question is a refusal, whatever its length."""
    if not has_cue(answer.lower()):
        return False
    asked = runs(tokens(question), QUOTED)
    total = aligned = 0
    declines = False
    for sentence in SENTENCE.split(TAG.sub(" ", answer).translate(FOLD)):
        words = tokens(sentence)
        if asked:
            words = [w for w, quoted in zip(words, covered(words, asked, QUOTED)) if not quoted]
        if not words:
            continue
        total += len(words)
        refused = alignment(words, DECLINING, DECLINED) >= ALIGNED
        if refused or alignment(words, SENDING, SENT) >= ALIGNED or sum(covered(words, EITHER, 2)) >= ALIGNED * len(words):
            aligned += len(words)
        declines = declines or refused and (has_cue(" ".join(words)) or has_cue("".join(words)))
    return declines and aligned >= REFUSED * total


def is_copy(question: str, answer: str) -> bool:
    """Whether the answer is the question, perhaps several times over, and no more than a lead-in."""
    q, a = squeeze(question), squeeze(plain(answer) if "<" in answer or "&" in answer else answer)
    if len(q) < 8 or len(a) < 8:  # too short for shingles
        return bool(q) and len(a) >= len(q) and a == q * (len(a) // len(q))
    if not containment(a, q, 0.75):  # a short question behind a lead-in
        return len(a) - len(q) <= 20 and a.endswith(q[-8:]) and containment(q, a, 0.9)
    whole = q * max(1, round(len(a) / len(q)))
    return unaligned(a, whole) <= max(12, 0.25 * min(len(a), len(q)))


def defect_of(question: str | None, answer: str | None) -> str | None:
    """The defect of a pair, truncation aside."""
    if is_empty(answer):
        return "empty"
    question = question or ""
    if is_refusal(answer, question):
        return "refusal"
    if question.strip() and is_copy(question, answer):
        return "copied_question"
    asked, given = language(question), language(answer)
    if asked != given:  # mark-up aside
        asked, given = language(plain(question)), language(plain(answer))
    if asked and given and asked != given and len(squeeze(plain(answer))) >= 4 and not (given in ASKED and ASKED[given].search(question)):
        return "wrong_language"
    return None


def pair_defects(df: DataFrame) -> DataFrame:
    """``df(grp, id, question, answer)`` -> ``grp, id, defect``, a row for each defective pair."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [defect_of(q, a) for q, a in zip(batch.column("question").to_pylist(), batch.column("answer").to_pylist())]
            bad = np.array([x is not None for x in found], bool)
            kind = pa.array(found, pa.string())
            fine = open_values(batch.rename_columns(["grp", "id", "question", "text"]).filter(pa.array(~bad & batch.column("grp").is_valid().to_numpy(False))))
            yield fine.append_column("defect", pa.nulls(fine.num_rows, pa.string()))
            broken = batch.select(["grp", "id"]).append_column("defect", kind).filter(pa.array(bad))
            yield pa.RecordBatch.from_arrays(
                [broken.column(f.name) if f.name in ("grp", "id", "defect") else pa.nulls(broken.num_rows, f.type) for f in (*fine.schema, pa.field("defect", pa.string()))],
                names=[*fine.schema.names, "defect"],
            )

    df = df.select("grp", "id", "question", "answer")
    both = cut(df.mapInArrow(run, f"{OPEN_SCHEMA}, defect string"))
    ends = cut_values(both.filter("defect is null"), df.select("grp", F.col("answer").alias("text")).filter("grp is not null"))
    return both.filter("defect is not null").select("grp", "id", "defect").distinct().unionByName(ends.withColumn("defect", F.lit("truncated")))
