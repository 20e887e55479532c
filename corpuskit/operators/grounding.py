"""Weakly supervised grounding of report sentences to image regions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpuskit.functions.text import clean, pystrip, report_sentences, stable_id

from .rewards import predicted_label
from .shape import turn

# Words of sides, levels and anatomical regions, in order of precedence.
SIDES = (("left", ("left", "lt", "左")), ("right", ("right", "rt", "右")), ("bilateral", ("bilateral", "both", "bibasal", "bibasilar", "双侧", "两侧")))
LEVELS = (
    ("upper", ("upper", "apical", "apex", "上")),
    ("mid", ("middle", "mid", "perihilar", "hilar", "中", "肺门")),
    ("lower", ("lower", "basal", "base", "basilar", "costophrenic", "下", "基底", "肋膈角")),
)
ANATOMY = (
    ("cardiomediastinal", ("cardiomediastinal", "mediastinum", "heart", "cardiac", "心影", "纵隔", "心脏")),
    ("left_costophrenic_angle", ("left costophrenic", "left cp angle", "左肋膈角")),
    ("right_costophrenic_angle", ("right costophrenic", "right cp angle", "右肋膈角")),
    ("left_hilum", ("left hilar", "left hilum", "左肺门")),
    ("right_hilum", ("right hilar", "right hilum", "右肺门")),
)
ABNORMAL = (
    r"(?i)\bopacity\b|\bopacities\b|\binfiltrate\w*\b|\bconsolidation\b|\batelectasis\b|\beffusion\b|\bpneumothorax\b|\bedema\b|\bcardiomegaly\b|\benlarg\w+\b|"
    r"\bnodule\w*\b|\bmass\b|\bfracture\b|\bpleural\b|\bairspace\b|\bvascular congestion\b|\bclear\b|\bnormal\b|\bno\b|\bwithout\b|"
    "阴影|渗出|实变|不张|积液|气胸|水肿|心影|心脏|结节|肿块|骨折|胸膜|未见|无明显"
)
REPORT_FIELDS = ("report", "report_text", "findings", "impression", "conclusion", "text")
ASK = (
    "<image>\n<image>\n第一张是胸片全图，第二张是候选局部区域。请判断下面报告句子是否主要对应第二张局部区域。"
    "回答时先在 reasoning 中解析空间位置、图像区域和结论绑定关系，最终答案只给出是否一致、对应区域和结论。\n报告句子："
)
SPANS = {"upper": (0.10, 0.43), "mid": (0.33, 0.68), "lower": (0.58, 0.92)}
NAMES = {"upper": ("上肺野", "upper lung zone"), "mid": ("中肺野", "middle lung zone"), "lower": ("下肺野", "lower lung zone")}


def region_rows(radiology_view: bool = True) -> list[tuple[int, str, str, str, list[float]]]:
    """(ord, key, zh_name, en_name, box); in radiology view the patient's left is on the right."""
    halves = {"left": (0.50, 0.96), "right": (0.04, 0.50)}
    if not radiology_view:
        halves = {"left": halves["right"], "right": halves["left"]}
    out = []
    for side, zh in (("left", "左"), ("right", "右")):
        x0, x1 = halves[side]
        out += [(f"{side}_{level}_lung", zh + NAMES[level][0], f"{side} {NAMES[level][1]}", [x0, y0, x1, y1]) for level, (y0, y1) in SPANS.items()]
        out.append((f"{side}_lung", f"{zh}肺野", f"{side} lung", [x0, 0.10, x1, 0.92]))
    (l0, l1), (r0, r1) = halves["left"], halves["right"]
    out += [
        ("bilateral_lungs", "双肺野", "bilateral lungs", [0.04, 0.10, 0.96, 0.92]),
        ("cardiomediastinal", "心影纵隔区", "cardiomediastinal region", [0.30, 0.30, 0.70, 0.86]),
        ("left_costophrenic_angle", "左肋膈角", "left costophrenic angle", [l0, 0.70, l1, 0.96]),
        ("right_costophrenic_angle", "右肋膈角", "right costophrenic angle", [r0, 0.70, r1, 0.96]),
        ("left_hilum", "左肺门", "left hilum", [l0 + 0.04, 0.34, l1 - 0.08, 0.62]),
        ("right_hilum", "右肺门", "right hilum", [r0 + 0.08, 0.34, r1 - 0.04, 0.62]),
    ]
    return [(i, *row) for i, row in enumerate(out)]


def regions(spark: SparkSession, radiology_view: bool = True) -> DataFrame:
    return spark.createDataFrame(region_rows(radiology_view), "ord int, key string, zh_name string, en_name string, box array<double>")


def _hit(s: Column, words: tuple[str, ...], whole: bool) -> Column:
    low = F.lower(s)
    tests = [low.rlike(rf"\b{w}\b") if whole and w.isascii() else low.contains(w) for w in words]
    out = tests[0]
    for t in tests[1:]:
        out = out | t
    return out


def infer_regions(s: Column, word_boundary: bool = False) -> Column:
    """Keys of the regions a sentence speaks of. Words count inside other words unless ``word_boundary``."""
    keys = [F.when(_hit(s, words, word_boundary), F.array(F.lit(key))).otherwise(F.array().cast("array<string>")) for key, words in ANATOMY]
    pick = lambda groups: F.coalesce(*[F.when(_hit(s, w, word_boundary), F.lit(k)) for k, w in groups])
    side, level = pick(SIDES), pick(LEVELS)
    last = (
        F.when(side == "bilateral", F.array(F.lit("bilateral_lungs")))
        .when(side.isNotNull() & level.isNotNull(), F.array(F.concat(side, F.lit("_"), level, F.lit("_lung"))))
        .when(side.isNotNull(), F.array(F.concat(side, F.lit("_lung"))))
        .when(level.isNotNull(), F.array(F.concat(F.lit("left_"), level, F.lit("_lung")), F.concat(F.lit("right_"), level, F.lit("_lung"))))
        .otherwise(F.array().cast("array<string>"))
    )
    return F.array_distinct(F.concat(*keys, last))


def positives(reports: DataFrame, most: int = 4, word_boundary: bool = False) -> DataFrame:
    """``reports(id, image, text)`` -> abnormal sentences with their region, at most ``most`` a report."""
    sentences = reports.select("id", "image", F.posexplode(report_sentences(F.col("text"))).alias("pos", "sentence"))
    pairs = sentences.filter(F.col("sentence").rlike(ABNORMAL)).select("*", F.posexplode(infer_regions(F.col("sentence"), word_boundary)).alias("region_pos", "region"))
    w = Window.partitionBy("id").orderBy("pos", "region_pos")
    return pairs.withColumn("n", F.row_number().over(w)).filter(F.col("n") <= most)


def examples(reports: DataFrame, dim: DataFrame, most: int = 4, negatives: int = 1, seed: int = 42, symmetric: bool = False) -> DataFrame:
    """Matching and, by a hash of the seed, mismatching candidate regions for each positive pair.

    For a left target no left region is a negative (for a right one none, unless ``symmetric``).
    ``dim`` has a fixed, small number of rows, so joining it to every pair is bounded.
    """
    pos = positives(reports, most)
    d = F.broadcast(dim)
    target = pos.join(d.select(F.col("key").alias("region"), F.col("zh_name").alias("zh"), F.col("en_name").alias("en")), "region")
    other = d.select(F.col("key").alias("candidate"), F.col("zh_name").alias("other_zh"), F.col("en_name").alias("other_en"))
    same_side = F.col("region").startswith("left") & F.col("candidate").startswith("left")
    if symmetric:
        same_side = same_side | F.col("region").startswith("right") & F.col("candidate").startswith("right")
    neg = target.join(other, (F.col("candidate") != F.col("region")) & ~same_side)
    w = Window.partitionBy("id", "pos", "region").orderBy(F.md5(F.concat_ws("|", F.col("id").cast("string"), F.col("pos").cast("string"), "candidate", F.lit(str(seed)))), "candidate")
    neg = neg.withColumn("r", F.row_number().over(w)).filter(F.col("r") <= negatives).drop("r").withColumn("grounding_label", F.lit("mismatch"))
    match = target.withColumns({"candidate": F.col("region"), "other_zh": F.col("zh"), "other_en": F.col("en"), "grounding_label": F.lit("match")})
    both = match.unionByName(neg)
    is_match = F.col("grounding_label") == "match"
    # The sentences of answer and reasoning.
    value = F.when(is_match, F.concat(F.lit("一致。对应区域："), "zh", F.lit("。结论："), "sentence")).otherwise(
        F.concat(F.lit("不一致。句子对应区域："), "zh", F.lit("。第二张图不是该结论的主要对应区域。"))
    )
    where = F.concat(F.lit("先解析报告句子："), "sentence", F.lit("\n句子中的空间或解剖线索指向 "), "zh", F.lit("（"), "en", F.lit("）。"))
    fits = F.lit("第二张图是从胸片中裁剪出的候选区域，覆盖该解剖位置。因此这句话和第二张局部图在空间上是一致的，可以把报告结论绑定到该区域。")
    differs = F.concat(F.lit("但第二张图对应的是 "), "other_zh", F.lit("（"), "other_en", F.lit("），与句子描述的空间位置不一致。因此不能把该报告结论绑定到第二张局部图。"))
    key = stable_id(F.col("id").cast("string"), F.col("pos").cast("string"), F.col("region"), F.col("candidate"))
    crop = F.concat(F.lit("crops/"), key, F.lit("_"), F.col("candidate"), F.lit(".png"))
    return both.select(
        key.alias("example_id"), "id", F.array("image", crop).alias("image"), "grounding_label", F.col("sentence").alias("grounding_sentence"),
        F.col("region").alias("grounding_region"), F.col("candidate").alias("candidate_region"), value.alias("answer"),
        F.concat(where, F.when(is_match, fits).otherwise(differs)).alias("reasoning"),
    ).withColumn("conversations", F.array(
        turn("human", F.concat(F.lit(ASK), "grounding_sentence")), turn("gpt", F.col("answer"), F.col("reasoning"))
    ))


def side_of(key: Column) -> Column:
    return F.when(key.startswith("left"), "left").when(key.startswith("right"), "right").when(key.startswith("bilateral"), "bilateral").otherwise("central")


def level_of(key: Column) -> Column:
    """upper, mid, lower, hilum or costophrenic as the key names it; else central or whole."""
    named = F.regexp_extract(key, "(upper|mid|lower|hilum|costophrenic)", 1)
    return F.when(key == "cardiomediastinal", "central").when(named != "", named).otherwise("whole")


def mentions_region(text: Column, key: Column, zh_name: Column) -> Column:
    """Whether a text names a region, by its Chinese name or its key in words."""
    return text.contains(zh_name) | F.lower(text).contains(F.replace(key, F.lit("_"), F.lit(" ")))


def keeps_side(text: Column, key: Column) -> Column:
    """Whether a text about a left (right) region doesn't speak of the right (left)."""
    side = side_of(key)
    return F.when(side == "left", ~text.contains("右")).when(side == "right", ~text.contains("左")).otherwise(True)


def report_text(df: DataFrame, fields: tuple[str, ...] = REPORT_FIELDS) -> Column:
    """The report fields that have text, a line each; else what the assistant's turns say."""
    own = F.concat_ws("\n", *[F.nullif(clean(c), F.lit("")) for c in fields if c in df.columns])
    if "conversations" not in df.columns:
        return own
    said = F.filter("conversations", lambda t: t["from"].isin("gpt", "assistant") & t["value"].isNotNull())
    lines = F.filter(F.transform(said, lambda t: pystrip(t["value"])), lambda x: x != "")
    return F.when(own != "", own).otherwise(F.coalesce(F.concat_ws("\n", lines), F.lit("")))


def rate(c: Column) -> Column:
    return F.round(F.coalesce(F.try_divide(F.count_if(c), F.count(F.lit(1))), F.lit(0.0)), 4)


def quality(examples_: DataFrame, dim: DataFrame, crops: DataFrame | None = None) -> DataFrame:
    """One row of counts and rates over a grounding set; ``crops(path)`` lists the crops there are."""
    mismatch = F.col("grounding_label") == "mismatch"
    g, c = F.col("grounding_region"), F.col("candidate_region")
    named = examples_.join(F.broadcast(dim.select(F.col("key").alias("grounding_region"), "zh_name")), "grounding_region", "left")
    crop = F.get("image", F.lit(1))
    if crops is None:
        named = named.withColumn("lost", F.lit(False))
    else:
        named = named.withColumn("path", crop).join(crops.select("path", F.lit(True).alias("there")).distinct(), "path", "left")
        named = named.withColumn("lost", (F.size("image") == 2) & F.col("there").isNull() & ~F.col("path").startswith("http"))
    return named.agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.size("image") != 2).alias("bad_format"), F.count_if("lost").alias("missing_crops"),
        F.count_if(mismatch & (side_of(g) != side_of(c))).alias("side_errors"),
        F.count_if(mismatch & (level_of(g) != level_of(c))).alias("level_errors"),
        rate(predicted_label(F.col("answer")).eqNullSafe(F.col("grounding_label"))).alias("label_consistency"),
        rate(mentions_region(F.col("answer"), g, F.col("zh_name"))).alias("region_mention_rate"),
    )


def score_predictions(examples_: DataFrame, predictions: DataFrame, dim: DataFrame, key: str = "example_id") -> DataFrame:
    """Examples with a non-empty prediction ``(id, prediction)``, ids compared as text: counts and rates of what is right."""
    told = predictions.select(F.col("id").cast("string").alias("_id"), "prediction").filter("prediction <> ''")
    rows = examples_.withColumn("_id", F.col(key).cast("string")).join(told, "_id")
    rows = rows.join(F.broadcast(dim.select(F.col("key").alias("grounding_region"), "zh_name")), "grounding_region", "left")
    said, region = F.col("prediction"), F.col("grounding_region")
    return rows.agg(
        F.count(F.lit(1)).alias("prediction_count"),
        rate(predicted_label(said).eqNullSafe(F.col("grounding_label"))).alias("label_accuracy"),
        rate(mentions_region(said, region, F.col("zh_name"))).alias("region_mention_accuracy"),
        rate(region.isNotNull() & keeps_side(said, region)).alias("left_right_consistency"),
    )


def label_accuracy(df: DataFrame, prediction: str, reference: str) -> DataFrame:
    """How often the predicted label is the reference's, of the rows whose reference has one."""
    want = predicted_label(F.col(reference))
    return df.agg(
        F.count(F.lit(1)).alias("sample_eval_count"), F.count(want).alias("n_labelled"),
        F.avg(F.when(want.isNotNull(), predicted_label(F.col(prediction)).eqNullSafe(want).cast("double"))).alias("grounding_label_accuracy"),
    )


def crop_box(box: Column, width: Column, height: Column) -> Column:
    """Pixel box of a fractional one, rounded half to even and kept inside the picture."""
    at = lambda i, size: F.bround(box[i] * size).cast("int")
    return F.array(F.greatest(F.lit(0), at(0, width)), F.greatest(F.lit(0), at(1, height)), F.least(width, at(2, width)), F.least(height, at(3, height)))
