import json
import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from corpuskit.functions import text as X
from corpuskit.functions.models import REWARDS
from corpuskit.operators import cleanup, dedup, generate, graph, grounding, metrics, retrieval, rewards, shape
from corpuskit.sources import io
from corpuskit.streaming import streams


def one(spark, expr, **values):
    schema = ", ".join(f"{k} string" for k in values)
    return spark.createDataFrame([tuple(values.values())], schema).select(expr.alias("x")).first().x


@pytest.mark.parametrize(
    ("text", "want"),
    [(None, []), ("", []), ("   ", ["_"]), ("ab cd", ["ab", "cd", "a", "b", "c", "d"]), ("肺炎肺炎肺炎肺", ["肺炎肺", "炎肺炎", "肺"]), ("a1 肺炎 B2 x", ["a1", "肺炎", "b2", "x"]), ("😀", ["😀"]), ("　é　", ["é"])],
)
def test_mixed_tokens(spark, text, want):
    assert one(spark, X.mixed_tokens(F.col("t")), t=text) == want


@pytest.mark.parametrize(
    ("text", "want"),
    [(None, True), ("", True), ("x" * 11, True), ("abcdefghijkl", True), ("abcdefghijk.", False), ("测试test待补充abcdefgh.", True), ("aaaabcdefgh.", False), ("aaaaabcdefgh.", True), ("abcdefghijklmnopqrstuvwxyzabcdefghijklmnop", False)],
)
def test_low_quality(spark, text, want):
    assert one(spark, X.low_quality(F.col("t")), t=text) is want


def test_text_helpers(spark):
    assert one(spark, X.pystrip(F.col("t")), t="　a\n ") == "a"
    assert one(spark, X.squeeze(F.col("t")), t=" a \n\t b ") == "a b"
    assert one(spark, X.squeeze(F.col("t")), t=None) == ""
    assert one(spark, X.strip_think(F.col("t")), t="<redacted_thinking>x</redacted_thinking> <think>b</think> c") == "b c"
    assert one(spark, X.qa_sentences(F.col("t")), t="好吗？我头痛三天。短。") == ["我头痛三天。"]
    assert one(spark, X.report_sentences(F.col("t")), t="FINDINGS: The heart is normal.  No effusion seen;\nshort") == ["The heart is normal.", "No effusion seen;"]


def test_exact_dedup(spark):
    df = spark.createDataFrame([(1, "a  b", None, "c"), (2, "a b", "", "c"), (3, "a b", "x", "c"), (4, None, None, None)], "ord long, q string, i string, a string")
    assert {r.ord for r in dedup.exact_dedup(df, "ord", "q", "i", "a").collect()} == {1, 3, 4}
    assert dedup.exact_dedup(df.limit(0), "ord", "q").count() == 0


def greedy(sigs, keep, k=3):
    slots = []
    for i, h, n in sorted(sigs):
        for s in slots:
            if ((h ^ s[1]) & (1 << 64) - 1).bit_count() <= k:
                if keep == "longest" and n > s[2]:
                    s[:] = [i, h, n]
                break
        else:
            slots.append([i, h, n])
    return {s[0] for s in slots}


@pytest.mark.parametrize("keep", ["first", "longest"])
def test_near_dedup_equals_sequential(spark, keep):
    rng = random.Random(1)
    words = [f"w{i}" for i in range(300)]
    texts = [" ".join(rng.choices(words, k=60)) for _ in range(25)]
    rows = []
    for i in range(120):
        t = rng.choice(texts).split()
        for _ in range(rng.choice([0, 0, 1, 2, 3])):
            t[rng.randrange(len(t))] = rng.choice(words)
        rows.append((i, " ".join(t) + " " * rng.randrange(3)))
    rows += [(200, "  "), (201, None)]
    df = spark.createDataFrame(rows, "id long, text string")
    sigs = {r.id: r.simhash for r in dedup.simhash(df).collect()}
    want = greedy([(i, sigs[i], len(t)) for i, t in rows if t and t.strip()], keep)
    assert {r.id for r in dedup.near_dedup(df, 3, keep).collect()} == want


def test_components(spark):
    df = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (7, 7)], "u long, v long")
    roots = {r.u: r.root for r in graph.components(df).collect()}
    assert set(roots) == set(range(41)) | {100, 101} and {roots[i] for i in range(41)} == {0} and roots[101] == 100


def test_cleanup(spark):
    raw = [
        (1, "头痛三天怎么办，无"), (2, "对于阳痿是什么病，无"), (3, "病情描述：胃痛，一直胃痛"), (4, "无"), (5, None), (6, "咳嗽怎么办？希望得到怎样的帮助：尽快好"),
        (7, "孩子发烧三十九度怎么办，孩子发烧三十九度怎么办"), (8, "胃疼很久了。胃疼很久了。"),
    ]
    got = {r.id: r.cleaned for r in cleanup.clean_questions(spark.createDataFrame(raw, "id long, text string")).collect()}
    assert got[1] == "头痛三天怎么办" and got[2] == "阳痿是什么病？" and got[3].startswith("胃痛") and got[4] == "无" and got[5] == ""
    assert got[6] == "咳嗽怎么办？" and got[7] == "孩子发烧三十九度怎么办" and got[8] == "胃疼很久了。"


def test_shapes(spark):
    df = spark.createDataFrame([(1, " q ", "answer of some length", "bad"), (2, "", "x", None), (3, "q", "short", None)], "ord long, question string, answer string, answer_rejected string")
    assert [(r.ord, r.conversations[0].value) for r in shape.sharegpt(df, image="p.jpg").orderBy("ord").collect()] == [(1, "<image>\nq"), (3, "<image>\nq")]
    assert [r.response_rejected for r in shape.dpo(df, "explicit").collect()] == ["bad"]
    weak = {r.ord: r.response_rejected for r in shape.dpo(df).collect()}
    assert weak[1].endswith("answer o") and weak[3] == "信息不足，无法回答。"
    v = spark.createDataFrame([(1, [1, 2, 3], [4])], "id long, p array<int>, a array<int>")
    r = v.select(shape.masked_labels(F.col("p"), F.col("a")).alias("m"), shape.pad(F.col("a"), 3, 0, left=True).alias("l"), shape.pad_truncate_eos(F.col("p"), 2, 9).alias("e")).first()
    assert (r.m, r.l, r.e) == ([-100, -100, -100, 4], [0, 0, 4], [1, 9])
    c = spark.createDataFrame([(1, ["a", "b", "c"], [("human", "<image>x<image>", None), ("gpt", "y", None), ("human", "<image>", None)])], "id long, image array<string>, conversations array<struct<from:string,value:string,reasoning:string>>")
    assert [r.images for r in shape.image_slices(c, "id").orderBy("pos").collect()] == [["a", "b"], [], ["c"]]
    j = spark.createDataFrame([("x {“valid”：true, 'preferred': '甲'}",), ("none",), ('{"valid": false, "preferred": "乙"}',)], "raw string").withColumn("v", shape.judge_verdict(F.col("raw")))
    assert sorted(r.x for r in j.select(shape.verdict_reason(F.col("v"), F.lit("甲")).alias("x")).collect()) == ["invalid", "ok", "unreadable"]


def test_merge_images(spark):
    reports = spark.createDataFrame([(1, "5", {"a": "b"}), (2, "6", None), (3, "zh-1", {"image": "old"}), (4, "x", {"row_idx": "7"}), (5, "x", {"_resume_key": "5"})], "rec_id long, _resume_key string, meta map<string,string>")
    paths = spark.createDataFrame(
        [(5, "z9", None, None, 1), (5, " ", "p1", None, 2), (5, " ", "p1", None, 3), (5, "", " ", None, 4), (6, None, None, None, 5), (None, "x", None, None, 6), (7, "m", None, None, 7)],
        "row_idx long, image string, path string, image_path string, ord int",
    )
    got = {r.rec_id: r.meta for r in shape.merge_images(reports, paths).collect()}
    assert got == {1: {"a": "b", "image": "p1"}, 2: None, 3: {"image": "old"}, 4: {"row_idx": "7", "image": "m"}, 5: {"_resume_key": "5", "image": "p1"}}


def test_bm25_and_packing(spark):
    import math

    docs = spark.createDataFrame([(1, "肺 炎 cough"), (2, "cough cough"), (3, ""), (4, None)], "doc_id long, text string")
    q = spark.createDataFrame([(9, "cough cough zzz"), (8, None)], "qid long, query string")
    idf, avg = math.log(1 + (4 - 2 + 0.5) / 2.5), 5 / 4
    want = {d: round(2 * idf * tf * 2.5 / (tf + 1.5 * (0.25 + 0.75 * dl / avg)), 6) for d, tf, dl in ((1, 1, 3), (2, 2, 2))}
    got = retrieval.bm25_topk(q, docs).collect()
    assert {r.doc_id: r.score for r in got} == pytest.approx(want) and {r.qid for r in got} == {9}
    hits = spark.createDataFrame([(1, 1, "a" * 50), (1, 2, "b" * 10), (2, 1, "c" * 5), (2, 2, "d" * 50), (2, 3, "e")], "qid long, rank int, block string")
    packed = {r.qid: r.context for r in retrieval.pack_context(hits, 20, separator="|").collect()}
    assert packed == {1: "a" * 50, 2: "c" * 5}
    assert {r.qid: r.context for r in retrieval.pack_context(hits, 20, first_always=False, separator="|", empty="-").collect()} == {1: "-", 2: "c" * 5}


def chunks(text, most, overlap):
    out, buf = [], ""
    for p in (p.strip() for p in __import__("re").split(r"\n\s*\n", text)):
        if not p:
            continue
        if len(buf) + len(p) + 1 <= most:
            buf = f"{buf}\n\n{p}" if buf else p
        else:
            out += [buf] if buf else []
            long = len(p) > most
            out += [p[i : i + most] for i in range(0, len(p), most - overlap)] if long else []
            buf = "" if long else p
    return out + ([buf] if buf else [])


def test_chunks(spark):
    rng = random.Random(2)
    for _ in range(20):
        t = "\n\n".join("x" * rng.choice([1, 5, 9, 10, 25, 0]) for _ in range(rng.randrange(6)))
        assert one(spark, retrieval.chunk_text(F.col("t"), 10, 3), t=t) == chunks(t, 10, 3)
    with pytest.raises(ValueError):
        retrieval.chunk_text(F.lit("a"), 5, 5)


@pytest.mark.parametrize(
    ("s", "want"),
    [("Bilateral opacities", ["bilateral_lungs"]), ("left lower opacity", ["left_lower_lung"]), ("on the right", ["right_lung"]), ("upper zone", ["left_upper_lung", "right_upper_lung"]), ("the heart", ["cardiomediastinal", "right_lung"]), ("nothing", []), ("左肋膈角变钝", ["left_costophrenic_angle", "left_lower_lung"])],
)
def test_regions(spark, s, want):
    assert one(spark, grounding.infer_regions(F.col("t")), t=s) == want


def test_grounding_examples(spark):
    reports = spark.createDataFrame([(1, "a.jpg", "Opacity in the left upper zone. Effusion on the right lower zone. No nodule in the left mid zone. Mass at the left apex. Clear right upper zone."), (2, "b.jpg", None)], "id long, image string, text string")
    out = grounding.examples(reports, grounding.regions(spark), most=3).collect()
    assert len([r for r in out if r.grounding_label == "match"]) == 3 and len(out) == 6
    assert all(not (r.grounding_region.startswith("left") and r.candidate_region.startswith("left")) for r in out if r.grounding_label == "mismatch")
    q = grounding.quality(spark.createDataFrame(out), grounding.regions(spark)).first()
    assert (q.n, q.bad_format, q.label_consistency, q.region_mention_rate) == (6, 0, 1.0, 1.0)
    assert all(r.conversations[0].value.startswith("<image>\n<image>\n") and r.conversations[1].value == r.answer for r in out)
    assert len(grounding.region_rows()) == 14


def test_scores():
    a = list("abcdefgh")
    assert metrics.bleu(a, a) == pytest.approx(1.0) and metrics.bleu(a, list("zzzz")) == 0.0 and metrics.bleu([], a) == 0.0
    assert metrics.bleu(a, list("abxd"), smoothing=1) == pytest.approx((3 / 4 * 1 / 3 * 0.1 / 2 * 0.1 / 1) ** 0.25 * 2.718281828459045 ** (1 - 2))
    assert metrics.rouge_l(list("abcd"), list("axcd")) == pytest.approx(0.75) and metrics.rouge_l([], a) == 0.0


def test_rewards_and_advantages(spark):
    rows = [(1, "<think>a</think> 一致。左上肺野", "一致。对应区域：左上肺野"), (1, "不匹配", "一致。左上肺野"), (2, "x", "free text"), (2, None, "free text")]
    df = rewards.reward_matrix(spark.createDataFrame(rows, "g long, completion string, assistant string"))
    got = [(r.grounding_label_reward, r.grounding_region_reward, r.grounding_cot_format_reward) for r in df.collect()]
    assert got == [(1, 1, 1), (0, 0, 0), (None, None, None), (None, None, None)] and set(REWARDS) >= {"accuracy_reward", "format_reward"}
    assert one(spark, REWARDS["format_reward"](F.col("c"), F.col("c")), c="<think>\na\n</think>\n<answer>\nb\n</answer>\nmore") == 1.0
    df = df.withColumn("reward", rewards.total_reward(["grounding_label_reward", "accuracy_reward"]))
    adv = sorted(r.advantage for r in rewards.advantages(df, "g").collect())
    assert adv == pytest.approx([-0.5 / (0.5**0.5 + 1e-4), 0, 0, 0.5 / (0.5**0.5 + 1e-4)])


def test_alignment_strict(spark):
    a, b = spark.createDataFrame([(1, 1), (2, 1)], "ord long, a long"), spark.createDataFrame([(1, 2)], "ord long, b long")
    assert metrics.aligned(a, b, "ord").count() == 1
    with pytest.raises(Exception, match="partner"):
        metrics.aligned(a, b, "ord", strict=True).collect()


def test_sources(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"question": "q", "answer": "a"}\n\n{"question": "r"}\nbroken\n', encoding="utf-8")
    assert io.read_jsonl(spark, str(tmp_path / "a.jsonl"), io.QA, strict=False).filter("question is not null").count() == 2
    with pytest.raises(Exception):
        io.read_jsonl(spark, str(tmp_path / "a.jsonl"), io.QA).collect()
    (tmp_path / "l.json").write_text(json.dumps([{"id": 1}, {"id": 2}]))
    (tmp_path / "d.json").write_text(json.dumps({"items": [{"id": 3}]}))
    (tmp_path / "c.csv").write_text("id\n4\n5\n")
    assert [len(io.load_records(spark, str(tmp_path / n), "id long").collect()) for n in ("l.json", "d.json", "c.csv")] == [2, 1, 2]
    kb = tmp_path / "kb" / "sub"
    kb.mkdir(parents=True)
    (kb / "x.MD").write_bytes("肺炎".encode() + b"\xff")
    (kb / "y.bin").write_bytes(b"no")
    assert [(r.source, r.text) for r in io.read_text_tree(spark, str(tmp_path / "kb")).collect()] == [("sub/x.MD", "肺炎�")]
    df = spark.createDataFrame([(1, None), (2, "乙")], "id long, t string")
    io.write_jsonl(df, str(tmp_path / "out"))
    assert '"t":null' in "".join(p.read_text(encoding="utf-8") for p in (tmp_path / "out").glob("part*"))
    assert io.export_json_array(df, str(tmp_path / "arr.json")) == 2
    for _ in range(2):
        io.append_once(df, str(tmp_path / "table"), "id")
    assert spark.read.parquet(str(tmp_path / "table")).count() == 2
    p = spark.createDataFrame([("a", 1, "x", None), ("a", 2, None, "y"), ("b", 1, " ", None)], "id string, ord int, prediction string, text string")
    assert [(r.id, r.prediction) for r in io.predictions(p).collect()] == [("a", "y")]


def test_arrow_shards(spark, tmp_path):
    names = []
    for i, kind in enumerate((pa.ipc.new_file, pa.ipc.new_stream)):
        t = pa.table({"findings": [f"f{i}a", f"f{i}b"]})
        with kind(str(tmp_path / f"s{i}.arrow"), t.schema) as w:
            w.write_table(t)
        names.append({"filename": f"s{i}.arrow"})
    (tmp_path / "state.json").write_text(json.dumps({"_data_files": names[::-1]}))
    spark.dataSource.register(io.ArrowShards)
    got = spark.read.format("arrow_shards").option("path", str(tmp_path)).load().orderBy("row_id").collect()
    assert [(r.row_id, r.findings) for r in got] == [(0, "f1a"), (1, "f1b"), (2, "f0a"), (3, "f0b")]


def test_stream_equals_batch(spark, tmp_path):
    src = str(tmp_path / "in")
    df = spark.createDataFrame([(i, f"q{i % 5}", "a") for i in range(20)], "ord long, q string, a string")
    df.repartition(4).write.parquet(src)
    for _ in range(2):  # the second call finds nothing new
        s = streams.dedup_stream(streams.read_stream(spark, src, df.schema, files_per_trigger=1), "q", "a")
        streams.write_available(s, str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == dedup.exact_dedup(df, "ord", "q", "a").count() == 5


def test_no_cartesian_product(spark):
    df = spark.createDataFrame([(1, "a b c"), (2, "b c d")], "id long, text string")
    plan = dedup.hamming_pairs(dedup.simhash(df))._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoop" not in plan


def test_saved_states_and_files(spark, tmp_path):
    for name, state in (("checkpoint-5", '{"save_steps": 5}'), ("checkpoint-20", '{"save_steps": 1}'), ("checkpoint-10", "{}"), ("checkpoint-x", '{"save_steps": 5}'), ("checkpoint-30", None)):
        (tmp_path / name).mkdir()
        if state:
            (tmp_path / name / "trainer_state.json").write_text(state)
    states = io.checkpoints(spark, str(tmp_path))
    assert sorted(r.step for r in states.collect()) == [-1, 5, 10, 20]
    assert [r.step for r in io.last_complete(states, 5).collect()] == [10] and [r.step for r in io.last_complete(states, 1).collect()] == [20]
    for name in ("b.txt", "a.txt"):
        (tmp_path / name).write_text(name)
    assert io.first_file(spark, f"{tmp_path}/*.txt").endswith("/a.txt")
    for split, n in (("train", 5), ("test", 2)):
        (tmp_path / split).mkdir()
        batch = pa.table({"x": list(range(n))})
        with pa.ipc.new_file(str(tmp_path / split / "data-0.arrow"), batch.schema) as f:
            f.write_table(batch)
    rows = io.read_saved_splits(spark, str(tmp_path), "train", 3)
    assert sorted((r.row_id, r.x) for r in rows.collect()) == [(0, 0), (1, 1), (2, 2)]
    assert [r.x for r in io.record_by_id(io.read_saved_splits(spark, str(tmp_path), "train"), 4).collect()] == [4]


def test_line_numbers_follow_the_files(spark, tmp_path):
    spark.range(100).repartition(7).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    numbered = io.with_line_no(df)
    assert [r.line_no for r in numbered.collect()] == list(range(100)) and [r.id for r in numbered.collect()] == [r.id for r in df.collect()]
    assert io.with_line_no(df.limit(0)).count() == 0


def test_preference_records(spark):
    rows = [(1, "a<image>\nb", "yes", "no", "why", "hm"), (2, "q", "yes", "no", None, " ")]
    df = spark.createDataFrame(rows, "id long, prompt string, chosen string, rejected string, chosen_reasoning string, rejected_reasoning string")
    got = {r.id: r for r in shape.dpo_record(df, reasoning=True).collect()}
    assert got[1].prompt == f"<|im_start|>user\na{shape.VISION}b<|im_end|>\n<|im_start|>assistant\n" and got[1].chosen == "<think>\nwhy\n</think>\n\nyes<|im_end|>\n"
    assert got[2].rejected == "no<|im_end|>\n"
    with pytest.raises(Exception, match="reasoning on one side"):
        shape.dpo_record(df.withColumn("rejected_reasoning", F.lit(None).cast("string")), reasoning=True).collect()


def test_messages_scores_and_tables(spark):
    r = spark.range(1).select(
        shape.chat_message(F.array(F.lit("a.png")), F.lit("hi")).alias("m"), shape.score_item(F.array(F.lit("3"), F.lit("0.5"))).alias("two"),
        shape.score_item(F.array(F.lit("1"), F.lit("d"), F.lit("0.25"))).alias("three"),
    ).first()
    assert [tuple(p) for p in r.m] == [("image", "a.png", None), ("text", None, "hi")] and tuple(r.two) == (3, None, 0.5) and tuple(r.three) == (1, "d", 0.25)
    df = spark.createDataFrame([(7, (0.5, 0.25), (0.75, 0.5))], "step int, base struct<bleu1:double,bleu2:double>, finetuned struct<bleu1:double,bleu2:double>")
    flat = metrics.flat_metrics(df, ("bleu1", "bleu2"))
    assert flat.columns == ["step", "base_bleu1", "base_bleu2", "finetuned_bleu1", "finetuned_bleu2"]
    both = metrics.compared(df.select("base.*"), df.select("finetuned.*"), ("bleu1", "bleu2"))
    assert {(x.metric, x.delta) for x in both.collect()} == {("bleu1", 0.25), ("bleu2", 0.25)}
    pairs = spark.createDataFrame([(1, list("abcde"), list("abcde")), (2, [], list("a"))], "id long, reference array<string>, hypothesis array<string>")
    assert tuple(metrics.mean_bleu4(pairs).first()) == (1, 1.0) and metrics.mean_scores(metrics.text_scores(pairs)).first().bleu1 == 0.5
    assert retrieval.depth(8) == (8, 8) and retrieval.depth(8, 0, 3) == (8, 3)


def test_grounding_quality(spark):
    make = lambda i, label, g, c, a, image: (i, label, g, c, a, image)
    rows = [
        make(1, "match", "left_hilum", "left_hilum", "一致。对应区域：左肺门。", ["f", "c1"]), make(2, "mismatch", "left_hilum", "right_upper_lung", "不一致。左肺门", ["f", "c2"]),
        make(3, "mismatch", "cardiomediastinal", "bilateral_lungs", "一致。", ["f"]), make(4, "match", "left_lung", "left_lung", "左肺野不一致", ["f", "http://x"]),
    ]
    df = spark.createDataFrame(rows, "id long, grounding_label string, grounding_region string, candidate_region string, answer string, image array<string>")
    q = grounding.quality(df, grounding.regions(spark), spark.createDataFrame([("c1",)], "path string")).first()
    assert (q.n, q.bad_format, q.missing_crops, q.side_errors, q.level_errors, q.label_consistency, q.region_mention_rate) == (4, 1, 1, 2, 2, 0.5, 0.75)


def test_hamming_pairs_equal_brute_force(spark):
    rng = random.Random(4)
    base = [rng.getrandbits(64) for _ in range(40)]
    values = {b ^ sum(1 << i for i in rng.sample(range(64), rng.randrange(5))) for b in base for _ in range(5)}
    signed = sorted(v - (1 << 64) if v >> 63 else v for v in values)
    want = {(a, b) for i, a in enumerate(signed) for b in signed[i + 1 :] if ((a ^ b) & (1 << 64) - 1).bit_count() <= 3}
    got = {(r.a, r.b) for r in dedup.hamming_pairs(spark.createDataFrame([(x,) for x in signed], "simhash long")).collect()}
    assert got == want and want


def test_repeated_clauses():
    assert cleanup.merge_clauses("我已经头疼三天多了，我已经头疼三天多了怎么办？，您好，") == "我已经头疼三天多了怎么办？"
    assert cleanup.merge_clauses("a, b") == "a,b" and cleanup.merge_clauses("一句话") == "一句话"
    assert cleanup.distinct_sentences("胃疼很久了。胃疼很久了。短。") == ["胃疼很久了。"]
    assert cleanup.distinct_sentences("治疗情况：无\n今天上午开始咳嗽有痰并且发烧了。昨天今天上午开始咳嗽有痰并且发烧了。") == ["今天上午开始咳嗽有痰并且发烧了。"]


def test_steps_with_a_model(spark):
    df = spark.createDataFrame([(1, "q", "short"), (2, "q", "A long enough answer that ends well."), (3, "", "x")], "ord long, question string, answer string")
    got = {r.ord: (r.answer, r._rewritten) for r in generate.rewrite_low_quality(df, lambda p: F.concat(F.lit("<think>"), F.upper(p))).collect()}
    assert got[1][1] and got[1][0].startswith("问题：Q") and got[2] == ("A long enough answer that ends well.", False) and 3 not in got
    assert {r._rewritten for r in generate.rewrite_low_quality(df).collect()} == {False}
    reports = spark.createDataFrame([(1, "a b", " ", "s"), (2, None, "c", "s"), (3, "", None, "s"), (4, "done", "", "s")], "row_idx long, findings string, impression string, source string")
    done = spark.createDataFrame([("4",), ("9",)], "_resume_key string")
    rows = {r._resume_key: r for r in generate.translate_reports(reports, lambda p: F.upper(F.element_at(F.split(p, "\n"), -1)), done).collect()}
    assert set(rows) == {"1", "2"} and (rows["1"].findings_zh, rows["1"].impression_zh, rows["1"].full_report_zh) == ("A B", None, "A B") and rows["2"].meta == {"source": "s", "_resume_key": "2"}
    turns = spark.createDataFrame([(i, [("human", f"<image>\nq{i}"), ("gpt", "r")]) for i in range(40)], "id long, conversations array<struct<from:string,value:string>>")
    yes = generate.judged_pairs(turns, lambda p: F.lit("good"), lambda p: F.lit("bad"), lambda p: F.when(p.contains("回答甲：\ngood"), '{"valid": true, "preferred": "甲"}').otherwise('{"valid": true, "preferred": "乙"}'), "id")
    assert {r.reason: r.n for r in generate.outcome_counts(yes).collect()} == {"ok": 40} and generate.accepted(yes).columns == ["id", "prompt", "chosen", "rejected"]
    same = generate.judged_pairs(turns, lambda p: F.lit("x"), lambda p: F.lit(" x"), lambda p: p, "id")
    assert {r.reason for r in same.collect()} == {"same"}


def test_model_names_and_settings(spark):
    assert one(spark, generate.model_name(F.col("t")), t="/a/run/checkpoint-5/") == "run_checkpoint-5" and one(spark, generate.model_name(F.col("t")), t="a/b") == "b"
    assert one(spark, generate.base_model(F.col("t")), t="---\nbase_model: /m/x \nlib: y") == "/m/x" and one(spark, generate.base_model(F.col("t")), t="none") is None
    assert one(spark, X.after_think(F.col("t")), t="<redacted_thinking>a</redacted_thinking> b ") == "b"
    generate.check_settings(fps=1.0)
    for bad in ({"fps": 1.0, "nframes": 2}, {"lora": True}, {"vision_lora": True}):
        with pytest.raises(ValueError):
            generate.check_settings(**bad)


def test_tfidf_is_the_cosine(spark):
    docs = spark.createDataFrame([(1, "abc abd"), (2, "zzz"), (3, None), (4, "abc")], "doc_id long, text string")
    got = {(r.doc_id, r.score) for r in retrieval.tfidf_topk(spark.createDataFrame([(1, "abc")], "qid long, query string"), docs).collect()}
    assert (4, 1.0) in got and {d for d, _ in got} == {1, 4}


def test_counters_steps_and_samples(spark, tmp_path):
    df, watch = metrics.observed(spark.range(20), "run", n=F.count(F.lit(1)), even=F.count_if(F.col("id") % 2 == 0))
    assert df.count() == 20 and watch.get == {"n": 20, "even": 10}
    for step in (1, 2):
        metrics.write_predictions(spark.range(3).withColumn("global_step", F.lit(step)), str(tmp_path / "p"))
    assert {(r.global_step, r["count"]) for r in spark.read.json(str(tmp_path / "p")).groupBy("global_step").count().collect()} == {(1, 3), (2, 3)}
    metrics.review_sample(spark.range(100), "id", str(tmp_path / "r"), 7)
    assert spark.read.json(str(tmp_path / "r")).count() == 7 and dedup.seeded_sample(spark.range(9), "id", 0).count() == 9


def test_rouge_of_ascii_words():
    assert metrics.rouge_l(["肺", "x"], ["肺", "x"]) == 1.0 and metrics.rouge_l(["肺", "炎"], ["肺", "炎"], ascii_compat=True) == 0.0
    assert metrics.rouge_l(["A-b", "c"], ["a", "b"], ascii_compat=True) == pytest.approx(0.8)


def test_pictures_that_are_structs_are_passed_over(spark):
    df = spark.createDataFrame([(("x",), "p.png")], "image struct<bytes:string>, path string")
    assert shape.picture_columns(df) == ("path",)


def test_other_tokenizers(spark):
    docs = spark.createDataFrame([(1, "a-b"), (2, "a")], "doc_id long, text string")
    assert {r.token for r in retrieval.postings(docs, lambda c: F.split(c, " ")).collect()} == {"a-b", "a"}


def test_blocks_paths_arrays_and_windows(spark, tmp_path):
    r = spark.range(1).select(
        retrieval.hit_block(F.lit(2), F.lit("d"), F.lit(7), F.lit(0.5), F.lit("t"), F.lit(True)).alias("b"), X.first_path(F.array(F.lit("a.png"), F.lit("b")), "/x/").alias("p"),
        X.first_path(F.array(F.lit("http://a")), "/x").alias("h"),
    ).first()
    assert tuple(r) == ("[片段2] doc_id=d line=7 score=0.5000 low_quality=true\nt", "/x/a.png", "http://a")
    (tmp_path / "a.json").write_text('[{"x": 1}, {"x": 2}]')
    assert sorted(r.x for r in io.read_json_array(spark, str(tmp_path / "a.json"), "x int").collect()) == [1, 2]
    events = spark.createDataFrame([("2024-01-01 00:10:00", "a"), ("2024-01-01 00:50:00", "a"), ("2024-01-01 01:10:00", "b")], "at string, kind string").withColumn("at", F.to_timestamp("at"))
    hours = streams.hourly_counts(events, "at", "kind").select(F.hour("window.start").alias("hour"), "kind", "n")
    assert sorted(tuple(r) for r in hours.collect()) == [(0, "a", 2), (1, "b", 1)]
