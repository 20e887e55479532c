import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from corpuskit.llm import corpus_trie, kernels, leaks, mixture, near_duplicates, pair_defects, personal_data, sentence_alignment, shared_spans, split_overlap, truncation
from corpuskit.llm.fm_index import FMIndex, long_matches, suffix_array


TOKENIZER = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"


def norm(s):
    return "".join(c for c in (s or "").lower() if c.isalnum())


def jaccard(a, b, k=5):
    x, y = ({s[i : i + k] for i in range(len(s) - k + 1)} for s in (norm(a), norm(b)))
    return len(x & y) / len(x | y) if x | y else 0.0


def words(rng, n, size=400):
    return " ".join(f"w{rng.randrange(size)}q" for _ in range(n))


def edited(rng, text, n):
    t = text.split()
    for _ in range(n):
        t[rng.randrange(len(t))] = f"x{rng.randrange(99)}y"
    return " ".join(t)


def frame(spark, rows, schema):
    """Rows with further columns whose names clash with inner ones."""
    return spark.createDataFrame(rows, schema).withColumns({"cls": F.lit(1), "key": F.lit("x"), "rep": F.lit(None).cast("string"), "n": F.lit(0)})


# kernels
@pytest.mark.parametrize("rows", [[], [None], ["", "a", None, "é肺😀", "X-1"], ["a" * 5000]])
def test_flat_and_normalise(rows):
    codes, starts = kernels.flat(pa.array(rows, pa.string()))
    assert kernels.texts(codes, starts) == [r or "" for r in rows]
    assert kernels.texts(*kernels.normalise(codes, starts)) == [norm(r) for r in rows]


def test_gram_hashes_equal_iff_text_equal():
    rng = np.random.default_rng(0)
    codes = rng.integers(97, 99, 3000).astype(np.uint32)
    for k in (1, 2, 3, 5, 12, 33):
        h = kernels.gram_hashes(codes, k).tolist()
        seen = {}
        for i, x in enumerate(h):
            assert seen.setdefault(x, codes[i : i + k].tobytes()) == codes[i : i + k].tobytes()
        assert len(set(h)) == len({codes[i : i + k].tobytes() for i in range(len(h))})


def test_signature_estimates_similarity():
    rng = random.Random(3)
    a = words(rng, 120)
    b = edited(rng, a, 6)
    sig, filled = near_duplicates.signatures(*kernels.normalise(*kernels.flat(pa.array([a, b, "", "abc", "abcde"]))), 5, 216)
    assert abs((sig[0] == sig[1]).mean() - jaccard(a, b)) < 0.12
    assert (sig[2] == near_duplicates.NONE).all() and (sig[3] == near_duplicates.NONE).all() and (sig[4] == sig[4][0]).all() and filled[2:].tolist() == [0, 0, 1]


def test_pruning_keeps_what_can_reach_the_threshold(spark):
    most = [near_duplicates.most_differing(0.7, n, n) for n in (64, 128, 192)]
    # at similarity 0.7 a value differs with probability 0.15
    assert all(0.15 * n < m < 0.5 * n for n, m in zip((64, 128, 192), most)) and near_duplicates.most_differing(0.7, 64, 8) > most[0]
    rows = [(0, 0, 0, 216, 0, 0, 0, 216), (0, 0, 0, 216, -1, 0, 0, 216), (0, 0, 0, 216, (1 << most[0]) - 1, 0, 0, 216), (0, 0, 0, 3, -1, 0, 0, 216)]
    df = spark.createDataFrame(rows, "s0_a long, s1_a long, s2_a long, filled_a int, s0_b long, s1_b long, s2_b long, filled_b int")
    assert [r[0] for r in df.select(near_duplicates.likely(0.7, 216)).collect()] == [True, False, True, True]


def test_sieve(spark):
    from corpuskit.llm.common import sieve

    rng = np.random.default_rng(0)
    some, other = rng.integers(-(1 << 62), 1 << 62, (2, 3000))
    known = sieve(spark.createDataFrame([(int(x),) for x in some], "h long").repartition(3), "h")
    assert known.has(some).all() and known.has(other).mean() < 0.05
    assert not sieve(spark.createDataFrame([], "h long"), "h").has(other).any()


# problem 3
def test_near_duplicates_equal_brute_force(spark):
    rng = random.Random(5)
    base = [words(rng, 60) for _ in range(30)]
    rows = [("t", i, edited(rng, base[rng.randrange(30)], rng.choice([0, 1, 2, 4, 9]))) for i in range(150)]
    rows += [("t", 900, None), ("t", 901, ""), ("t", 902, "ab"), ("t", 903, "ab"), ("u", 0, rows[0][2]), (None, 7, "abcdefg"), (None, 8, "abcdefg"), ("t", None, rows[0][2])]
    want = {
        (g, min(i, j), max(i, j)) for x, (g, i, s) in enumerate(rows) for h, j, t in rows[:x]
        if i is not None and j is not None and g == h and jaccard(s, t) >= 0.7
    }
    got = near_duplicates.near_duplicate_pairs(frame(spark, rows, "grp string, id long, text string")).collect()
    assert {(r.grp, r.id_a, r.id_b) for r in got} == want and len(got) == len(want)


def test_copies_stay_linear(spark):
    rng = random.Random(6)
    a = words(rng, 50)
    rows = [("t", i, a) for i in range(40)] + [("t", 100, edited(rng, a, 1))]
    got = {(r.id_a, r.id_b) for r in near_duplicates.near_duplicate_pairs(spark.createDataFrame(rows, "grp string, id long, text string")).collect()}
    assert got == {(0, i) for i in range(1, 40)} | {(0, 100)}


def test_near_duplicates_of_nothing(spark):
    assert near_duplicates.near_duplicate_pairs(spark.createDataFrame([], "grp string, id long, text string")).count() == 0


def test_a_hot_band_is_split(spark):
    hot, n = 1500, 3000
    band = spark.range(n).select(F.col("id").alias("cls"), F.when(F.col("id") < hot, -1).otherwise(F.col("id")).alias("key")).repartition(6)
    settings = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2k", "spark.sql.shuffle.partitions": "8"}
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        pairs = near_duplicates.proposed(band)
        assert len(pairs.collect()) == hot * (hot - 1) // 2
        assert "SortMergeJoin(skew=true)" in pairs._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


# problem 9
def test_suffix_array():
    rng = np.random.default_rng(1)
    for n, sigma in ((1, 2), (50, 2), (300, 3), (200, 1)):
        t = np.append(rng.integers(1, sigma + 1, n), 0)
        assert suffix_array(t).tolist() == sorted(range(len(t)), key=lambda i: t[i:].tolist())


def test_fm_index_counts_and_matches():
    rng = random.Random(2)
    texts = ["".join(rng.choice("abc") for _ in range(rng.randrange(40, 90))) for _ in range(6)]
    codes = [np.array(list(map(ord, t)), np.uint32) for t in texts]
    index = FMIndex(codes)
    query = "".join(rng.choice("abcd") for _ in range(10)) + texts[2][5:33] + "d" + texts[4][:21]
    q = np.array(list(map(ord, query)), np.uint32)
    lo, hi, longest = index.backward(index.symbols(q), np.arange(4, len(q) + 1), 4, 12)
    whole = "\0".join(texts)
    assert longest.tolist() == [max(n for n in range(13) if n <= e and query[e - n : e] in whole) for e in range(4, len(q) + 1)]
    joined = "".join(t + "|" for t in texts)
    places = index.locate(np.arange(len(index.text)))
    assert sorted(places.tolist()) == list(range(len(joined) + 1)) and (places[lo[hi > lo]] >= 0).all()
    for k in np.nonzero(hi > lo)[0]:
        assert {joined[p : p + 4] for p in places[lo[k] : hi[k]]} == {query[k : k + 4]}
    assert (hi - lo).tolist() == [sum(t[i : i + 4] == query[k : k + 4] for t in texts for i in range(len(t) - 3)) for k in range(len(q) - 3)]
    hits = {(int(p), int(s), int(e)) for _, p, s, e in long_matches(index, q, np.array([0, len(q)]), 20)}
    assert any(p == 2 and e - s >= 20 for p, s, e in hits) and any(p == 4 for p, _, _ in hits)
    for p, s, e in hits:
        assert query[s:e] in texts[p]


def test_shared_spans_equal_brute_force(spark):
    rng = random.Random(7)
    alphabet = "abcdefghij 肺炎"
    make = lambda n: "".join(rng.choice(alphabet) for _ in range(n))
    spans = [make(n) for n in (60, 79, 80, 81, 120, 300)]
    rows = [(i, make(rng.randrange(0, 300)) + rng.choice(spans) + make(rng.randrange(0, 200)) + rng.choice(spans)) for i in range(60)]
    rows += [(100, rows[0][1]), (101, None), (102, ""), (103, "a" * 500), (104, "b" + "a" * 90), (None, rows[1][1])]
    rows += [(200 + i, "z" * 79 + make(5)) for i in range(5)]
    least = 80
    grams = {i: {t[k : k + least] for k in range(len(t) - least + 1)} for i, t in rows if t and i is not None}
    want = {(i, j) for i in grams for j in grams if i < j and grams[i] & grams[j]}
    df = frame(spark, rows, "id long, text string")
    got = shared_spans.shared_span_pairs(df, least=least, window=31, shard_chars=3000, query_chars=5000).collect()
    assert {(r.id_a, r.id_b) for r in got} == want
    portions = {r.id: r for r in shared_spans.shared_portions(df, least=least, window=31).collect()}
    for i, t in rows:
        if not t or i is None:
            continue
        mask = np.zeros(len(t), bool)
        for k in range(len(t) - least + 1):
            if any(t[k : k + least] in g for j, g in grams.items() if j != i):
                mask[k : k + least] = True
        assert (portions[i].shared_chars if i in portions else 0) == mask.sum()
    assert shared_spans.shared_span_pairs(df.limit(0)).count() == 0


def test_a_passage_in_very_many_texts(spark):
    rng = random.Random(17)
    make = lambda n: "".join(rng.choice("abcdefghij") for _ in range(n))
    passage = make(260)
    n = 400
    rows = [(i, make(150) + passage + make(150)) for i in range(n)] + [(n, make(600))]
    df = spark.createDataFrame(rows, "id long, text string")
    assert shared_spans.shared_span_pairs(df, shard_chars=20_000, query_chars=30_000).count() == n * (n - 1) // 2
    portions = {r.id: r.shared_chars for r in shared_spans.shared_portions(df, shard_chars=20_000, query_chars=30_000).collect()}
    assert n not in portions and all(260 <= portions[i] < 270 for i in range(n))


# problem 7
def test_leaks_equal_brute_force(spark):
    rng = random.Random(8)
    items = [(i, words(rng, 25, 60), "en") for i in range(12)] + [(20, "肺炎" * 20 + "的下列哪一项处理是首选", "zh"), (21, "short", "en"), (22, None, "zh"), (23, "", "en"), (24, words(rng, 30), None)]
    docs = []
    for i in range(80):
        t = words(rng, 60, 60)
        if i % 3 == 0:
            it = rng.choice(items[:12])[1]
            n = rng.randrange(40, len(it))
            t += " - " + it[:n].upper() + ". " + words(rng, 10, 60)
        docs.append((i, t))
    docs += [(100, None), (101, ""), (102, "。" + items[12][1][3:50] + "x"), (None, items[0][1])]
    runs = {"en": 70, "zh": 34}
    want = set()
    for d, t in docs:
        for i, s, lang in items:
            n, m = norm(s), runs.get(lang, 70)
            if d is not None and any(n[k : k + m] in norm(t) for k in range(len(n) - m + 1)):
                want.add((d, i))
    got = leaks.leaked_items(frame(spark, docs, "id long, text string"), spark.createDataFrame(items, "item_id long, text string, lang string")).collect()
    assert want and {(r.id, r.item_id) for r in got} == want
    none = spark.createDataFrame([], "item_id long, text string, lang string")
    assert leaks.leaked_items(spark.createDataFrame(docs, "id long, text string"), none).count() == 0
    with pytest.raises(ValueError):
        leaks.leaked_items(spark.createDataFrame(docs, "id long, text string"), spark.createDataFrame(items, "item_id long, text string, lang string"), most_items=3)


# problem 6
def test_split_overlaps_equal_brute_force(spark):
    rng = random.Random(9)
    base = [words(rng, 70) for _ in range(25)]
    rows = [(i, rng.choice([True, True, False, None]), edited(rng, rng.choice(base), rng.choice([0, 1, 3, 8]))) for i in range(120)]
    rows += [(200 + i, i % 2 == 0, "same text in many rows here") for i in range(30)] + [(300, True, None), (301, False, ""), (None, True, base[0])]
    got = {(r.id_train, r.id_other) for r in split_overlap.split_overlaps(frame(spark, rows, "id long, train boolean, text string")).collect()}
    want = {(i, j) for i, a, s in rows for j, b, t in rows if a and not b and i is not None and jaccard(s, t) >= 0.7}
    many = {(i, j) for i, j in want if 200 <= i < 300}
    assert want - many == got - many
    star = got & many  # of more than eight copies on a side the smallest id stands for all
    assert {i for i, _ in star} == {i for i, _ in many} and {j for _, j in star} == {j for _, j in many}
    assert split_overlap.split_overlaps(spark.createDataFrame([], "id long, train boolean, text string")).count() == 0


def overlaps(spark, rows):
    return {(r.id_train, r.id_other) for r in split_overlap.split_overlaps(spark.createDataFrame(rows, "id long, train boolean, text string")).collect()}


def test_scattered_edits_are_found_down_to_the_threshold(spark):
    rng = random.Random(12)
    letters = "abcdefghijklmnopqrstuvwxyz"
    rows, want = [], set()
    while len(want) < 300:
        n = rng.choice([80, 150, 300])
        a = "".join(rng.choice(letters) for _ in range(n))
        b = list(a)
        for i in rng.sample(range(n), n // 25):
            b[i] = rng.choice(letters)
        if 0.7 <= jaccard(a, "".join(b)) < 0.76:
            want.add((len(rows), len(rows) + 1))
            rows += [(len(rows), True, a), (len(rows) + 1, False, "".join(b))]
    assert overlaps(spark, rows) == want


def test_the_exact_way_loses_nothing(spark):
    rng = random.Random(21)
    base = ["".join(rng.choice("abcdef") for _ in range(rng.choice([6, 12, 40, 150]))) for _ in range(20)]
    rows = []
    for i in range(160):
        t = list(rng.choice(base))
        for _ in range(rng.choice([0, 1, 1, 3, 6])):
            t[rng.randrange(len(t))] = rng.choice("abcdef")
        rows.append((i, i % 3 > 0, "".join(t)))
    df = spark.createDataFrame([*rows, (900, True, ""), (901, False, None)], "id long, train boolean, text string")
    want = {(i, j) for i, a, s in rows for j, b, t in rows if a and not b and jaccard(s, t) >= 0.7}
    got = {(r.id_train, r.id_other) for r in split_overlap.split_overlaps(df, exact=True).collect()}
    assert want and {p for p in want if rows[p[0]][2] != rows[p[1]][2]} == {p for p in got if rows[p[0]][2] != rows[p[1]][2]}


def test_equal_texts_are_cut_alike_whatever_stands_before():
    rng = random.Random(5)
    rows = ["".join(rng.choice("abcdefgh") for _ in range(rng.randrange(60))) for _ in range(400)]
    codes, starts = kernels.flat(pa.array(rows))
    got = split_overlap.Cutter(codes, starts).bounds(1)
    for row, at, end in zip(rows, starts[:-1].tolist(), starts[1:].tolist()):
        alone = split_overlap.Cutter(*kernels.flat(pa.array([row]))).bounds(1).tolist()
        assert row == "" or [x - at for x in got.tolist() if at <= x <= end] == alone


def test_repeated_passages_count_as_often_as_they_stand(spark):
    rng = random.Random(13)
    rows = []
    for i in range(0, 40, 2):
        passage = words(rng, 40)
        rows += [(i, True, passage * 8 + " a" + words(rng, 2)), (i + 1, False, passage * 7 + " b" + words(rng, 2))]
    assert overlaps(spark, rows) == {(i, i + 1) for i in range(0, 40, 2)}


def test_all_copies_are_paired(spark):
    rng = random.Random(31)
    text = words(rng, 60)
    rows = [(i, i < 20, text) for i in range(32)] + [(50, True, edited(rng, text, 2)), (60, False, edited(rng, text, 2))]
    want = {(i, j) for i, a, s in rows for j, b, t in rows if a and not b and jaccard(s, t) >= 0.7}
    assert len(want) >= 20 * 12 + 20 + 12 and overlaps(spark, rows) == want


def test_short_and_long_pairs_at_the_threshold_are_found(spark):
    # very short texts, and pairs of different length at the threshold
    rng = random.Random(32)
    rows = []
    letters = "abcdefghijklmnopqrstuvwxyz"
    for n in (6, 7, 9, 12, 24, 60, 700, 3000, 20000):
        for _ in range(12):
            a = "".join(rng.choice(letters) for _ in range(n))
            i = len(rows)
            rows += [(i, True, a), (i + 1, False, a[: n // 2] + rng.choice("0123") + a[n // 2 :] if n > 30 else a + rng.choice("0123")), (i + 2, False, a[: -(-n * 3 // 4) + 1])]
    shared = [(i, j) for i in range(0, len(rows), 3) for j in (i + 1, i + 2)]
    want = {(i, j) for i, j in shared if jaccard(rows[i][2], rows[j][2]) >= 0.7}
    assert len(want) > len(shared) / 2 and overlaps(spark, rows) == want


def test_bitmaps_and_places_only_spare_comparisons():
    rng = random.Random(33)
    base = [words(rng, n) for n in (3, 20, 60, 130, 300, 900)]
    rows = [norm(edited(rng, rng.choice(base), rng.choice([0, 1, 4, 15])))[: rng.choice([-1, -9, None])] for _ in range(90)]
    train = [i % 2 == 0 for i in range(len(rows))]
    ranks = np.full(split_overlap.BUCKETS, 7, np.uint8)
    group = [
        next(split_overlap._prefixes(ranks, 1, 0.7)(iter([pa.record_batch({"cls": pa.array([i for i, x in enumerate(train) if x == k]), "text": pa.array([t for t, x in zip(rows, train) if x == k])})])))
        for k in (True, False)
    ]
    got = split_overlap._near(0.7)(*[pa.Table.from_batches([g]) for g in group])
    got = set(zip(got["cls_a"].to_pylist(), got["cls_b"].to_pylist()))
    want = {(i, j) for i, a in enumerate(train) for j, b in enumerate(train) if a and not b and jaccard(rows[i], rows[j]) >= 0.7}
    assert want and want <= got and len(got) < 45 * 45 / 2


# problem 8
def test_shares_go_to_siblings_first():
    root = mixture.tree([("a_en", 0.4, 10), ("b_en", 0.1, 1000), ("c_zh", 0.3, 1000), ("d_en", 0.2, 1000)], {"a": "x", "b": "x", "c": "x", "d": "y"})
    got = mixture.budgets(root, 100)
    assert got == pytest.approx({"a_en": 10, "b_en": 40, "c_zh": 30, "d_en": 20})
    assert mixture.budgets(mixture.tree([("a_en", 1, 5)], {}), 100) == {"a_en": 5}
    assert mixture.share_out(10, [0, 1], [5, 5]) == [0, 5]


def test_mixture_reaches_its_shares(spark):
    rng = random.Random(1)
    rows = [(i, rng.choice(["a_en", "b_en", "b_en", "b_en", None]), words(rng, 20)) for i in range(600)] + [(900, "a_en", None), (901, "a_en", "")]
    weights = spark.createDataFrame([("a_en", 0.5, 3), ("b_en", 0.3, 1), ("none_zh", 0.2, 9), (None, 0.1, 1)], "source string, target_share double, max_repeats int")
    mixed, report = mixture.mixture(frame(spark, rows, "id long, source string, text string"), weights, {}, TOKENIZER)
    got = {r.source: r for r in report.collect()}
    assert got["none_zh"].tokens == 0 and abs(got["a_en"].share - 0.625) < 0.01 and got["a_en"].most_copies <= 3 and got["b_en"].most_copies == 1
    copies = {r.id: r.n_copies for r in mixed.collect()}
    assert 900 not in copies and 901 not in copies and max(copies.values()) <= 3
    again = mixture.mixture(spark.createDataFrame(rows, "id long, source string, text string").repartition(7), weights, {}, TOKENIZER)[0]
    assert {r.id: r.n_copies for r in again.collect()} == copies
    assert mixture.mixture(spark.createDataFrame([], "id long, source string, text string"), weights, {}, TOKENIZER)[0].count() == 0
    capped = {r.source: r for r in mixture.mixture(spark.createDataFrame(rows, "id long, source string, text string"), weights, {}, TOKENIZER, times=1.5)[1].collect()}
    assert capped["b_en"].most_copies == 1 and capped["b_en"].tokens == capped["b_en"].source_tokens and capped["a_en"].most_copies == 3


# problem 1
@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("Write to jo.doe+x@mail.example please.", {"email"}), ("mail: jo [at] mail [dot] example", {"email"}), ("邮箱：jo＠mail.example。", {"email"}),
        ("Dose given @ 2 mg/kg, then @ 0.2 mg/kg.", set()), ("Call 555-0134 after six.", {"phone"}), ("Device lot 055-9217 was checked.", set()), ("(555-0175, mornings only)", {"phone"}), ("See table 555-0175, row 2.", set()), ("要不要紧？——柏翊医生您好，我头痛", {"name"}), ("（见上）鄢霁旻的家属留言。", {"name"}),
        ("手机１７９００５１８８８２，微信同号。", {"phone"}), ("打一九零零零二一八六七一找家属", {"phone"}), ("(408) 555-0128", {"phone"}), ("药品批号13800138000。", set()),
        ("Registered under SSN 965-95-3031.", {"id_number"}), ("身份证号：991512 19451115 9664，请查", {"id_number"}), ("Accession 6857-00-7296 was used", set()), ("检查编号77116083416。", set()),
        ("I live at 592 tollgate rise.", {"address"}), ("Visit house no. 251 on Stonepath St.", {"address"}), ("家在落霞大道159号，远", {"address"}), ("落霞大道社区站开的药。在5号楼0层CT室做的。", set()),
        ("72 nights in a row it was close to 5.2 cm", set()), ("My name is Orrin Dalgrist.", {"name"}), ("seen by Dr. Tillensor today", {"name"}), ("The Kellmar sign is negative.", set()),
        ("Number 11010519491231002X was read out", {"id_number"}), ("Number 110105194912310021 was read out", set()), ("身份证号110105194912310021", {"id_number"}),
        ("Paid from GB82 WEST 1234 5698 7654 32 then", {"id_number"}), ("DE89370400440532013000", {"id_number"}), ("NO9386011117947", {"id_number"}), ("Paid from GB82 WEST 1234 5698 7654 33 then", set()),
        ("It was 4539 5787 6362 1486.", {"id_number"}), ("It was 4539 5787 6362 1487.", set()), ("000-00-0000 or 666-12-1234 or 123-00-1234", set()), ("Device 4539 5787 6362 1486.", set()),
        ("Referred by respiratory medicine.", set()), ("Discussed with [NAME] by telephone.", set()), ("孩子叫巫砺珩，一直在看。", {"name"}), ("姓名：***。医生您好", set()), ("之前是柯岑汐医生看的。", {"name"}),
        ("", set()), ("plain words " * 4000, set()),
    ],
)
def test_personal_data(text, want):
    assert {k for _, _, k in personal_data.find_spans(text)} == want


def test_validators():
    assert personal_data.luhn("4539578763621486") and not personal_data.luhn("4539578763621487")
    assert personal_data.mod97("GB82WEST12345698765432") and not personal_data.mod97("GB82WEST12345698765431")
    assert personal_data.citizen("11010519491231002X") and not personal_data.citizen("110105194912310021")


def test_redaction(spark):
    rows = [("t", 1, "Hi jo@a.example, ring 555-0134."), ("t", 2, None), ("t", 3, "nothing"), (None, None, "")]
    got = [(r.id, r.text, r.types) for r in personal_data.personal_data(frame(spark, rows, "grp string, id long, text string")).collect()]
    assert got == [(1, "Hi [EMAIL], ring [PHONE].", ["email", "phone"]), (2, None, []), (3, "nothing", []), (None, "", [])]


# problem 2
LONG = "For most people, taking one tablet of 5 mg after meals keeps the value within 3 units over the next weeks."


@pytest.mark.parametrize(
    ("question", "answer", "want"),
    [
        ("q", None, "empty"), ("q", " <p>&nbsp;</p> ", "empty"), ("q", "答：", "empty"), ("q", "Ａｎｓｗｅｒ：", "empty"), ("q", "回答：　Ｎ／Ａ", "empty"), ("q", "N/A", "empty"), ("问题是什么呢", "无", "empty"),
        ("Is it safe?", "I am sorry, but I cannot give advice about medicines here. Please ask elsewhere.", "refusal"), ("能吃吗？", "恕我不能提供用药建议。换个话题吧。", "refusal"),
        ("Is it safe?", "I cannot see the film, yet from the text: " + LONG, None), ("能吃吗", "不能替代面诊，不过每日服用5毫克后多数人会好转，两周后复查肝功能。", None),
        ("Is walking after dinner enough for me?", "So the question is: is walking after dinner enough for me?", "copied_question"),
        ("Is walking after dinner enough for me?", "Is walking after dinner enough for me? " + LONG, None),
        ("我头痛三天了怎么办？", LONG, "wrong_language"), ("我头痛三天了怎么办？请用英文回答。", LONG, None), ("Can I take it?", "Cerca del 33 por ciento de las personas que toman esto mejora en 32 días.", "wrong_language"),
        ("", LONG, None), (None, LONG, None), ("Can I take it?", LONG, None),
    ],
)
def test_defects(question, answer, want):
    assert pair_defects.defect_of(question, answer) == want


def test_refusals_are_decided_by_the_frames_at_any_length():
    question = "Can I take warfarin with 200 mg ibuprofen after my knee surgery in 2021 or is it better to wait?"
    refused = [
        "I'm sorry, but I can't help with that. In an emergency, call 911.", "I am unable to give medical advice here. " * 20,
        f'You asked: "{question}" I am sorry, but I cannot answer that question.', "抱歉，我不能回答这个问题（2024年规定）。请咨询专业医生。",
    ]
    given = ["Do not take this with alcohol.", "You should not drive.", "不能吃辣。", "I cannot help with that. Take one tablet daily after meals for ten days.", question]
    assert [pair_defects.defect_of(question, a) == "refusal" for a in refused + given] == [True] * len(refused) + [False] * len(given)


def test_copies_and_empty_answers_at_any_length():
    question = "Is walking after dinner enough for me?"
    for n in (1, 5, 8, 16, 300):
        assert pair_defects.defect_of(question, (question + " ") * n) == "copied_question"
        assert pair_defects.defect_of("能吃吗？", "恕我不能提供用药建议。" * n) == "refusal"
        assert pair_defects.defect_of(question, "Answer: " * n) == "empty"
    assert pair_defects.defect_of(question, question * 8 + LONG * 4) is None
    assert pair_defects.defect_of("头痛吗？", "头痛吗") == "copied_question" and pair_defects.defect_of(LONG * 300, LONG * 299) == "copied_question"
    assert pair_defects.defect_of(LONG * 300, "Yes, after meals.") is None and pair_defects.defect_of(question, "n" * 13) is None


def test_unaligned():
    rng = random.Random(11)
    for _ in range(60):
        a, b = ("".join(rng.choice("ab") for _ in range(rng.randrange(9))) for _ in range(2))
        assert pair_defects.unaligned(a, b) == len(a) - pair_defects.common_subsequence(a, b)


def test_common_subsequence():
    rng = random.Random(4)
    for _ in range(30):
        a, b = ("".join(rng.choice("abc") for _ in range(rng.randrange(15))) for _ in range(2))
        best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
        assert pair_defects.common_subsequence(a, b) == best[-1][-1]


# problem 4
def reports(rng, n):
    nouns, ends = ["fever", "swelling", "tenderness", "stiffness"], ["for two weeks", "after the meal", "without further treatment"]
    return [" ".join(f"The {rng.choice(nouns)} of grade {rng.randrange(9)} improved slowly {rng.choice(ends)}." for _ in range(4)) for _ in range(n)]


def test_truncated_values(spark):
    rng = random.Random(2)
    whole = reports(rng, 400)
    rows = [("a", i, t) for i, t in enumerate(whole)]
    cut = {1000 + i: t[: rng.randrange(60, 150)] for i, t in enumerate(reports(rng, 60))}
    cut = {i: t for i, t in cut.items() if not t.rstrip().endswith((".", "weeks", "meal", "treatment"))}
    fine = {2000 + i: t.rstrip(".") for i, t in enumerate(reports(rng, 40))}
    fine |= {3000 + i: t + "\nKind regards" for i, t in enumerate(reports(rng, 40))}
    rows += [("a", i, t) for i, t in [*cut.items(), *fine.items()]] + [("a", 5000, None), ("a", 5001, " "), ("a", 5002, "<p></p>"), (None, 1, "The fever of grade")]
    got = {r.id for r in truncation.truncated(frame(spark, rows, "grp string, id long, text string")).filter("grp = 'a'").collect()}
    assert len(got & set(cut)) >= 0.95 * len(cut) and len(got - set(cut)) <= 2
    assert truncation.truncated(spark.createDataFrame([], "grp string, id long, text string")).count() == 0


def test_copies_of_a_cut_value_make_no_closing_phrase(spark):
    whole = reports(random.Random(6), 300)
    rows = [("a", i, t) for i, t in enumerate(whole)] + [("a", 1000 + i, whole[0] + " Swelling of grade") for i in range(90)]
    rows += [("a", 2000 + i, t + " Kind regards") for i, t in enumerate(whole[:3])]
    got = {r.id for r in truncation.truncated(spark.createDataFrame(rows, "grp string, id long, text string")).collect()}
    assert got == {1000 + i for i in range(90)}


def test_values_are_read_whole(spark):
    long = " ".join(reports(random.Random(7), 500))
    rows = [("a", 1, long + " The fever of grade 3 improved slowly after the me"), ("a", 2, long + " The fever of grade 3 improved slowly after the meal"), ("a", 3, long)]
    assert len(long) > 100_000
    assert [r.id for r in truncation.truncated(spark.createDataFrame(rows, "grp string, id long, text string")).collect()] == [1]


def test_a_stub_that_recurs_is_no_word(spark):
    rows = [("a", i, t) for i, t in enumerate(reports(random.Random(8), 200))] + [("a", 1000 + i, f"The fever of grade {i} improved slowly after the me") for i in range(50)]
    got = {r.id for r in truncation.truncated(spark.createDataFrame(rows, "grp string, id long, text string")).collect()}
    assert got == {1000 + i for i in range(50)}


def test_chinese_cuts(spark):
    rng = random.Random(9)
    make = lambda: "".join(f"{rng.choice(['右肺', '左肺', '心影'])}见{rng.choice(['结节', '阴影'])}{rng.randrange(9)}毫米，大致{rng.choice(['如前', '同前'])}。" for _ in range(4))
    rows = [("a", i, make()) for i in range(300)]
    rows += [("a", 1000 + i, make() + "右肺见结节3毫米，大") for i in range(9)] + [("a", 2000 + i, make() + "左肺见阴影5毫") for i in range(9)] + [("a", 3000 + i, make()[:-1]) for i in range(9)]
    got = {r.id for r in truncation.truncated(spark.createDataFrame(rows, "grp string, id long, text string")).collect()}
    assert got == {x + i for x in (1000, 2000) for i in range(9)}


def test_folding_and_nodes():
    f = corpus_trie.Folded(pa.array(["Ａb  12３ c. X", "", None, " a", "胸部：正常。<p>x</p> 3.5mm. 好！"]))
    assert kernels.texts(f.codes, f.starts) == ["ab 0 c. x", "", "", "a", "胸部:正常。 x 0.0mm. 好!"]
    begin, end = f.words()
    assert ["".join(map(chr, f.codes[a:b])) for a, b in zip(begin, end)] == ["ab", "c", "x", "a", "胸部", "正常", "x", "mm", "好"]
    assert ["".join(map(chr, f.codes[i - 2 : i + 1])) for i in np.nonzero(f.sentence_ends())[0]] == [" c.", "正常。", "mm.", " 好!"]
    z, at = np.zeros(1, np.uint64), np.array
    one, two = corpus_trie.Folded(pa.array(["xyab"])), corpus_trie.Folded(pa.array(["ab"]))
    assert one.hashes(at([2]), at([4]), 2, z) == two.hashes(at([0]), at([2]), 2, z) != two.hashes(at([0]), at([2]), 3, z)


def test_pair_defects_frame(spark):
    rows = [("t", i, "What now?", t) for i, t in enumerate(reports(random.Random(1), 200))] + [("t", 500, "What now?", None), ("t", 501, None, "The swelling of grade 3 impro"), ("t", 502, None, None)]
    got = {r.id: r.defect for r in pair_defects.pair_defects(frame(spark, rows, "grp string, id long, question string, answer string")).collect()}
    assert got == {500: "empty", 501: "truncated", 502: "empty"}


# problem 5
def test_splitting_and_numbers():
    assert sentence_alignment.split_en(" A 5.2 cm node. New! Cut of") == ["A 5.2 cm node.", "New!", "Cut of"]
    assert sentence_alignment.split_zh("甲。 乙！丙") == ["甲。", "乙！", "丙"] and sentence_alignment.split_zh("  ") == []
    assert sentence_alignment.numbers_en("The second rib, 3.8 cm, in May") == sentence_alignment.numbers_zh("第2肋骨，38毫米，五月") and sentence_alignment.zh_value("二十三") == 23


def plain_warp(score):
    n, m = score.shape
    best = np.zeros((n + 1, m + 1))
    for i in range(1, n + 1):
        for j in range(1, m + 1):
            g = score[i - 1, j - 1] - 0.35
            best[i, j] = max(best[i - 1, j], best[i, j - 1], *((best[i - 1, j - 1] + g, best[i - 1, j] + g, best[i, j - 1] + g) if g > 0 else ()))
    return best[-1, -1]


def test_warping_in_a_corridor_finds_the_path_and_visits_less():
    rng = np.random.default_rng(3)
    for n, m in ((1, 1), (3, 7), (17, 40), (60, 60), (90, 200)):
        score = rng.uniform(0, 0.45, (n, m))
        for i in range(n):
            score[i, i * m // n] = 0.9
        gain = sum(score[i, j] - 0.35 for i, j, match in sentence_alignment.warp(score) if match)
        assert gain == pytest.approx(plain_warp(score))
        lo, hi = sentence_alignment.corridor(score)
        if lo is None:
            assert min(n, m) <= sentence_alignment.SMALL
            continue
        near = sum(score[i, j] - 0.35 for i, j, match in sentence_alignment.warp(score, lo, hi) if match)
        assert near >= 0.97 * gain and (min(n, m) < 50 or (hi - lo).sum() < 0.5 * n * m)


def test_bag_sums():
    rng = np.random.default_rng(5)
    table, lengths = rng.random((9, 4)).astype(np.float32), rng.integers(0, 7, 20)
    ids, bounds = rng.integers(0, 9, lengths.sum()), np.concatenate([[0], np.cumsum(lengths)])
    want = np.array([table[ids[a:b]].sum(0) for a, b in zip(bounds[:-1], bounds[1:])])
    assert np.allclose(sentence_alignment.bag_sums(table, ids, bounds), want, atol=1e-5)
    assert len(sentence_alignment.bag_sums(table, ids[:0], np.zeros(1, np.int64))) == 0


def test_neighbours_and_companions_are_counted_over_all_rows(spark):
    rng = random.Random(41)
    names, zh_names = ["lung", "heart", "rib", "hilum"], ["肺", "心", "肋", "门"]
    rows = []
    for i in range(2500):
        k = [rng.randrange(4) for _ in range(rng.randrange(1, 4))]
        rows.append((i, "findings", " ".join(f"The {names[x]} is at {i} mm." for x in k), "".join(f"{zh_names[x]}在{i}毫米。" for x in k)))
    df = spark.createDataFrame(rows, "id long, section string, en string, zh string").repartition(5)
    tokens = [[w(s) for r in rows for s in split(r[at])] for at, w, split in ((2, sentence_alignment.words_en, sentence_alignment.split_en), (3, sentence_alignment.words_zh, sentence_alignment.split_zh))]
    counts = [dict(sorted(Counter(x for t in side for x in set(t)).items())) for side in tokens]
    vocab = [{x: i for i, x in enumerate(c)} for c in counts]

    def read(found):
        out = [Counter(), Counter(), Counter()]
        for r in found.collect():
            out[r["side"]].update(dict(zip(*(np.frombuffer(r[c], np.int64).tolist() for c in ("keys", "counts")))))
        return out

    got = read(sentence_alignment.tallies(df, sentence_alignment._neighbours(vocab)))
    for side in (0, 1):
        of, want = vocab[side], Counter()
        for t in tokens[side]:
            for i in range(len(t)):
                for j in range(i + 1, min(len(t), i + sentence_alignment.WINDOW + 1)):
                    a, b = sorted((of[t[i]], of[t[j]]))
                    want[a * len(of) + b] += 1
        assert got[side] == want
    aligner = sentence_alignment.Aligner(counts, [len(t) for t in tokens], sentence_alignment.word_vectors(df, vocab))
    aligner.rotate([(aligner.phrase(e, 0), aligner.phrase(z, 1)) for e, z in zip(names, zh_names)])
    sure = read(sentence_alignment.tallies(df, aligner.companions))
    want = Counter()
    for s in aligner.scores([r[2:] for r in rows]):
        want["sure"] += sum(match and s[i, j] >= sentence_alignment.SURE for i, j, match in sentence_alignment.warp(s))
    assert sure[0][vocab[0]["the"]] == sure[1][vocab[1]["在"]] == sure[2][vocab[0]["the"] * len(vocab[1]) + vocab[1]["在"]] == want["sure"] > 2000


def test_training_takes_all_words_at_once():
    # two words in the same company come near each other, and repeated counts change nothing
    pairs = Counter()
    for topic in range(20):
        at = range(topic * 30, topic * 30 + 30)
        pairs.update((i, j) for i in at for j in at if i <= j)
    keys = np.array(sorted(i * 600 + j for i, j in pairs))
    v, again = (sentence_alignment.unit(sentence_alignment.skip_gram(keys, np.full(len(keys), n), 600)) for n in (1, 50))
    near = v @ v.T
    same = np.arange(600)[:, None] // 30 == np.arange(600)[None, :] // 30
    assert near[same].min() > near[~same].max() and np.allclose(v, again, atol=1e-3)
    assert sentence_alignment.skip_gram(keys[:0], keys[:0], 3).shape == (3, sentence_alignment.DIM)


def test_many_clauses_and_terms(spark):
    zh = "，".join(f"左肺见结节{i}毫米" for i in range(3000)) + "。"
    rows = [(i, "findings", f"The left lung shows a nodule of {i} mm.", f"左肺见结节{i}毫米。") for i in range(10, 60)] + [(900, "findings", "A nodule of 7 mm.", zh)]
    df = spark.createDataFrame(rows, "id long, section string, en string, zh string")
    glossary = spark.createDataFrame([("left lung", "左肺"), ("nodule", "结节")], "term_en string, term_zh string")
    aligner = sentence_alignment.fitted(df, glossary)
    got = {(r.id, r.en_idx, r.zh_idx) for r in sentence_alignment.aligned_sentences(df, glossary, aligner).collect()}
    assert {(i, 0, 0) for i in range(10, 60)} <= got
    most, sentence_alignment.MOST_TERMS = sentence_alignment.MOST_TERMS, 1
    try:
        with pytest.raises(ValueError):
            sentence_alignment.fitted(df, glossary)
    finally:
        sentence_alignment.MOST_TERMS = most


def test_alignment_recovers_order_and_merges(spark):
    rng = random.Random(3)
    parts = [("left lung", "左肺"), ("right lung", "右肺"), ("heart", "心影"), ("trachea", "气管"), ("pleura", "胸膜"), ("hilum", "肺门")]
    finds = [("nodule", "结节"), ("effusion", "积液"), ("fracture", "骨折"), ("opacity", "阴影")]
    rows, want = [], set()
    for r in range(160):
        picked = [(rng.choice(parts), rng.choice(finds), rng.randrange(10, 99)) for _ in range(5)]
        picked = list({(p, f): (p, f, n) for p, f, n in picked}.values())
        en = [f"The {p[0]} shows a {f[0]} of {n} mm." for p, f, n in picked]
        order = list(range(len(picked)))
        if r % 4 == 0 and len(order) > 1:
            order = [*order[1:], order[0]]
        zh = [f"{picked[i][0][1]}见{picked[i][1][1]}{picked[i][2]}毫米。" for i in order]
        if r % 5 == 0:
            zh.insert(1, "请结合临床。")
            place = {i: k + (k > 0) for k, i in enumerate(order)}
        else:
            place = {i: k for k, i in enumerate(order)}
        rows.append((r, "findings", "\n".join(en) if r % 2 else " ".join(en), "".join(zh)))
        want |= {(r, i, k) for i, k in place.items()}
    rows += [(900, "findings", None, "甲。"), (901, "findings", "", "  "), (902, "x", "A.", None)]
    glossary = spark.createDataFrame([(a, b) for a, b in parts[:4] + finds[:2]] + [(None, "x")], "term_en string, term_zh string")
    got = {(r.id, r.en_idx, r.zh_idx) for r in sentence_alignment.aligned_sentences(frame(spark, rows, "id long, section string, en string, zh string"), glossary).collect()}
    assert len(got & want) >= 0.95 * len(want) and len(got & want) >= 0.95 * len(got)
    assert sentence_alignment.aligned_sentences(spark.createDataFrame([], "id long, section string, en string, zh string"), glossary.limit(0)).count() == 0
