"""Sources and sinks."""

from __future__ import annotations

import json
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from corpuskit.functions.text import clean, pystrip

QA = T.StructType([T.StructField(c, T.StringType()) for c in ("question", "answer", "answer_rejected", "source")])
REPORT = T.StructType([
    T.StructField("row_idx", T.LongType()), T.StructField("findings", T.StringType()),
    T.StructField("impression", T.StringType()), T.StructField("image", T.StringType()),
])


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType | str, strict: bool = True) -> DataFrame:
    """Lines of JSON; blank lines are skipped, broken ones fail the read or (tolerant) are dropped."""
    return spark.read.schema(schema).option("mode", "FAILFAST" if strict else "DROPMALFORMED").json(path)


def read_json_array(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    return spark.read.schema(schema).option("multiLine", True).json(path)


def load_records(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """.jsonl, .csv, or .json holding a list or an object with its list under data, items or records."""
    suffix = Path(path).suffix.lower()
    if suffix == ".jsonl":
        return read_jsonl(spark, path, schema)
    if suffix == ".csv":
        return spark.read.option("header", True).option("multiLine", True).option("escape", '"').schema(schema).csv(path)
    fields = schema if isinstance(schema, T.StructType) else T._parse_datatype_string(schema)
    boxed = T.StructType([T.StructField(k, T.ArrayType(fields)) for k in ("data", "items", "records")])
    whole = spark.read.option("wholetext", True).text(path)
    first = F.substring(F.ltrim("value"), 1, 1)
    rows = F.when(first == "[", F.from_json("value", T.ArrayType(fields))).otherwise(
        F.coalesce(*[F.from_json("value", boxed)[k] for k in ("data", "items", "records")])
    )
    return whole.select(F.inline(rows))


def with_line_no(df: DataFrame, name: str = "line_no") -> DataFrame:
    """Number rows in file order, from 0: counts of the partitions first, then their offsets are added."""
    own = df.withColumn("_at", F.monotonically_increasing_id())
    part = F.shiftright("_at", 33)
    counts = own.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).collect()  # one row a partition
    offset, at = {}, 0
    for r in sorted(counts, key=lambda r: r["part"]):
        offset[r["part"]] = at - (r["part"] << 33)
        at += r["n"]
    if not offset:
        return own.select(*df.columns, F.lit(0).cast("long").alias(name))
    shift = F.create_map(*[F.lit(x) for pair in offset.items() for x in pair])
    return own.select(*df.columns, (F.col("_at") + shift[part]).alias(name))


def first_file(spark: SparkSession, path: str) -> str:
    """The first file, by name, that a path or pattern stands for."""
    return spark.read.format("binaryFile").load(path).select("path").agg(F.min("path")).first()[0]


def checkpoints(spark: SparkSession, folder: str) -> DataFrame:
    """``step, path, save_steps`` of the saved states below a folder that have a trainer_state.json."""
    files = spark.read.option("wholetext", True).text(f"{folder.rstrip('/')}/checkpoint-*/trainer_state.json").withColumn("file", F.col("_metadata.file_path"))
    step = F.regexp_extract("file", r"checkpoint-(\d+)/trainer_state\.json$", 1).try_cast("long")
    return files.select(
        F.coalesce(step, F.lit(-1)).alias("step"), F.regexp_replace("file", r"/trainer_state\.json$", "").alias("path"),
        F.get_json_object("value", "$.save_steps").try_cast("double").cast("int").alias("save_steps"),
    )


def last_complete(states: DataFrame, save_steps: int) -> DataFrame:
    """The latest state saved with these steps, or with none named."""
    fit = states.filter(F.col("save_steps").isNull() | (F.col("save_steps") == save_steps))
    return fit.orderBy(F.desc("step"), "path").limit(1)


def record_by_id(df: DataFrame, row_id: int, key: str = "row_id") -> DataFrame:
    """One row by its id; the filter reaches the scan."""
    return df.filter(F.col(key) == row_id)


def read_saved_splits(spark: SparkSession, folder: str, split: str, most: int | None = None) -> DataFrame:
    """A split of a dataset saved as Arrow shards below ``folder/split``, at most the first ``most`` rows."""
    spark.dataSource.register(ArrowShards)
    rows = spark.read.format("arrow_shards").option("path", f"{folder.rstrip('/')}/{split}").load()
    return rows if most is None else rows.filter(F.col("row_id") < most)


def append_csv(df: DataFrame, path: str) -> None:
    """Add rows to a table of CSV files, each with its header."""
    df.coalesce(1).write.mode("append").option("header", True).csv(path)


def read_text_tree(spark: SparkSession, root: str) -> DataFrame:
    """``source, text`` of all .txt and .md files below a folder; broken bytes are replaced."""
    wanted = "*.{[tT][xX][tT],[mM][dD]}"  # other files are never opened
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", wanted).load(root)
    base = Path(root).resolve().as_posix()
    return files.select(F.regexp_replace(F.regexp_replace("path", "^file:/*", "/"), f"^{base}/", "").alias("source"), F.make_valid_utf8(F.col("content").cast("string")).alias("text"))


def gold_rows(df: DataFrame) -> DataFrame:
    """Rows with question and answer and a stable id: the dedup hash, else a hash of the texts and the line."""
    raw = F.sha2(F.concat_ws("\n", *[F.coalesce(c, F.lit("")) for c in ("instruction", "input", "output")]), 256)
    made = F.concat(raw, F.lit("_"), F.col("line_no").cast("string"))
    given = F.nullif(pystrip(F.col("_dedup_sha256")), F.lit("")) if "_dedup_sha256" in df.columns else F.lit(None)
    return df.filter((clean("instruction") != "") & (clean("output") != "")).withColumn("doc_id", F.coalesce(given, made))


def first_filled(df: DataFrame, *names: str):
    """First non-empty of the columns that the table has."""
    have = [F.nullif(pystrip(F.col(n).cast("string")), F.lit("")) for n in names if n in df.columns]
    return F.coalesce(*have) if have else F.lit(None).cast("string")


def paraphrases(df: DataFrame) -> DataFrame:
    gold = F.coalesce(F.col("gold_doc_ids"), F.array(first_filled(df, "gold_doc_id", "doc_id"))) if "gold_doc_ids" in df.columns else F.array(first_filled(df, "gold_doc_id", "doc_id"))
    return df.select(first_filled(df, "query", "question").alias("query"), gold.alias("gold_doc_ids")).filter("query is not null")


def answers(df: DataFrame) -> DataFrame:
    return df.select(first_filled(df, "question", "query", "instruction").alias("question"), first_filled(df, "answer", "text", "prediction").alias("answer")).filter(
        "question is not null and answer is not null"
    )


def predictions(df: DataFrame) -> DataFrame:
    """The last prediction of each id."""
    rows = df.select("id", "ord", first_filled(df, "prediction", "text", "output").alias("prediction")).filter("prediction is not null")
    return rows.groupBy("id").agg(F.max_by("prediction", "ord").alias("prediction"))


def metric_history(spark: SparkSession, path: str) -> DataFrame:
    """CSV history of evaluations; rows without a readable step are left out."""
    rows = spark.read.option("header", True).csv(path)
    named = [c for c in rows.columns if c not in ("timestamp", "checkpoint_path")]
    return rows.withColumns({c: F.col(c).try_cast("double") for c in named}).withColumn("global_step", F.col("global_step").cast("long")).filter("global_step is not null")


def write_jsonl(df: DataFrame, path: str, mode: str = "error") -> None:
    """UTF-8 lines of JSON, null fields kept."""
    df.write.mode(mode).option("ignoreNullFields", False).json(path)


def export_json_array(df: DataFrame, path: str, most: int = 100_000, indent: int | None = None) -> int:
    """A small result as one JSON array; more than ``most`` rows raise an error."""
    rows = df.limit(most + 1).toJSON().collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} rows; write lines of JSON")
    Path(path).write_text(json.dumps([json.loads(r) for r in rows], ensure_ascii=False, indent=indent), encoding="utf-8")
    return len(rows)


def append_once(df: DataFrame, path: str, key: str) -> None:
    """Append the rows whose key the table at ``path`` doesn't have yet (a resumable sink)."""
    spark = df.sparkSession
    try:
        done = spark.read.parquet(path).select(key)
    except Exception as e:  # noqa: BLE001 - the table isn't there yet
        if "PATH_NOT_FOUND" not in str(e) and "does not exist" not in str(e):
            raise
        done = None
    (df if done is None else df.join(done.distinct(), key, "left_anti")).write.mode("append").parquet(path)


class ArrowShards(DataSource):
    """Shards of Arrow IPC files (file or stream format) in the order of ``state.json``, with a global ``row_id``.

    Options: path. One partition a shard; the first id of a shard is the sum of the rows before it.
    """

    @classmethod
    def name(cls) -> str:
        return "arrow_shards"

    def _files(self) -> list[Path]:
        root = Path(self.options["path"])
        state = root / "state.json"
        if state.exists():
            return [root / f["filename"] for f in json.loads(state.read_text())["_data_files"]]
        return sorted(root.glob("*.arrow"))

    @staticmethod
    def _open(path: Path):
        import pyarrow as pa

        source = pa.memory_map(str(path))
        try:
            return pa.ipc.open_file(source).read_all()
        except pa.ArrowInvalid:
            return pa.ipc.open_stream(pa.memory_map(str(path))).read_all()

    def schema(self) -> T.StructType:
        from pyspark.sql.pandas.types import from_arrow_schema

        files = self._files()
        if not files:
            raise ValueError("no shards")
        return T.StructType([T.StructField("row_id", T.LongType()), *from_arrow_schema(self._open(files[0]).schema).fields])

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return _ShardReader(self._files())


class _ShardReader(DataSourceReader):
    def __init__(self, files: list[Path]) -> None:
        self.files = files

    def partitions(self) -> list[InputPartition]:
        out, at = [], 0
        for f in self.files:
            out.append(InputPartition((str(f), at)))
            at += ArrowShards._open(f).num_rows
        return out

    def read(self, partition: InputPartition):
        import pyarrow as pa

        path, at = partition.value
        data = ArrowShards._open(Path(path))
        ids = pa.array(range(at, at + data.num_rows), pa.int64())
        yield from data.add_column(0, "row_id", ids).to_batches()
