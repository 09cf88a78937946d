"""Line-delimited JSON with an explicit schema: bad and torn lines are split off, not guessed at."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_CORRUPT = "_corrupt_record"


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """Good rows (with file_name and a sortable ordinal) and the lines that are no JSON of this kind; blank lines are skipped."""
    full = T.StructType([*schema.fields, T.StructField(_CORRUPT, T.StringType())])
    lines = spark.read.text(path).select("value", F.col("_metadata.file_name").alias("file_name"), F.struct(F.col("_metadata.file_name").alias("f"), F.col("_metadata.file_block_start").alias("b"), F.monotonically_increasing_id().alias("k")).alias("ordinal"))
    lines = lines.where(F.trim("value") != "")
    parsed = lines.select("file_name", "ordinal", F.from_json("value", full, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}).alias("r"))
    bad = F.col(f"r.{_CORRUPT}").isNotNull() | F.col("r").isNull()
    good = parsed.where(~bad).select("file_name", "ordinal", *[F.col("r")[f.name].alias(f.name) for f in schema.fields])
    return good, parsed.where(bad).select("file_name", F.col(f"r.{_CORRUPT}").alias("line"))


def judge_and_generator(file_name):
    """Judge and generator out of ``judge__on__generator.jsonl``."""
    stem = F.regexp_replace(file_name, r"\.jsonl$", "")
    parts = F.split(stem, "__on__", 2)
    return F.get(parts, F.lit(0)), F.get(parts, F.lit(1))


def read_json_arrays(spark: SparkSession, path: str, schema: T.StructType, name: str) -> DataFrame:
    """Files that each hold an array of {pid, text}, the language being the file's name; ids are name-pid-lang."""
    df = spark.read.schema(schema).option("multiLine", True).json(path)
    lang = F.regexp_extract(F.col("_metadata.file_name"), r"^(\w+)\.json$", 1)
    return df.select("*", lang.alias("lang")).withColumn("item_id", F.concat_ws("-", F.lit(name), "pid", "lang"))


def run_listing(spark: SparkSession, pattern: str) -> DataFrame:
    """One row per run directory: id, start to the second, status, number of candidates."""
    meta = spark.read.schema("run_id string, started_at string, status string, candidates array<string>").option("multiLine", True).json(pattern)
    return meta.select("run_id", F.substring("started_at", 1, 19).alias("started_at"), "status", F.size("candidates").alias("n_candidates"))


def scrape_logs(spark: SparkSession, path: str, patterns: dict[str, str]) -> DataFrame:
    """One row per log line that matches any of the patterns: file_name and the first group of each."""
    lines = spark.read.text(path).select(F.col("_metadata.file_name").alias("file_name"), "value")
    cols = {k: F.nullif(F.regexp_extract("value", p, 1), F.lit("")) for k, p in patterns.items()}
    hit = F.coalesce(*cols.values()).isNotNull()
    return lines.where(hit).select("file_name", *[c.alias(k) for k, c in cols.items()])


#: Where a benchmark's result file keeps each figure, and what stands in for it.
RESULT_FIELDS = (
    ("n_measured", "stats.n_measured", "0"), ("n_failed", "stats.n_failed", "0"), ("samples_per_sec", "stats.throughput.samples_per_sec", "0"), ("output_tok_per_sec", "stats.throughput.output_tok_per_sec", "0"),
    ("avg_input_tok", "stats.input_tokens.mean", "0"), ("avg_output_tok", "stats.output_tokens.mean", "0"), ("gpu_hours", "stats.extrapolation.gpu_hours", "0"), ("wall_time_s", "stats.wall_time_s", "0"),
)
_RESULT = """model_alias string, mode string, stats struct<error: string, n_measured: bigint, n_failed: bigint, wall_time_s: double, throughput: struct<samples_per_sec: double, output_tok_per_sec: double>,
 input_tokens: struct<mean: double>, output_tokens: struct<mean: double>, extrapolation: struct<gpu_hours: double>>"""


def read_results(spark: SparkSession, pattern: str) -> DataFrame:
    """Benchmark result files, one object each, as flat figures; those that hold an error are left out."""
    df = spark.read.schema(_RESULT).option("multiLine", True).json(pattern).where("stats.error is null")
    flat = [F.coalesce(F.col(path), F.lit(default).cast("double")).alias(name) for name, path, default in RESULT_FIELDS]
    return df.select(F.col("_metadata.file_name").alias("file_name"), F.coalesce("model_alias", F.lit("?")).alias("model"), F.coalesce("mode", F.lit("?")).alias("mode"), *flat)


#: What log lines begin with.
LOG_TEXT, LOG_OTHER, LOG_HEADING = "[text] ", r"^\[(tool|ok|FAIL|done)\]", "## Final Summary"


def log_summary(log):
    """The closing summary of a run's log: what its text blocks hold from the heading on; null without one."""
    lines = F.split(log, "\n")
    # a block of text goes on until a line of another kind
    kept = F.aggregate(
        lines,
        F.struct(F.array().cast("array<string>").alias("out"), F.lit(False).alias("inside")),
        lambda a, x: F.when(F.startswith(x, F.lit(LOG_TEXT)), F.struct(F.array_append(a["out"], F.substring(x, len(LOG_TEXT) + 1, 1 << 20)).alias("out"), F.lit(True).alias("inside")))
        .when(x.rlike(LOG_OTHER), F.struct(a["out"].alias("out"), F.lit(False).alias("inside")))
        .otherwise(F.struct(F.when(a["inside"], F.array_append(a["out"], x)).otherwise(a["out"]).alias("out"), a["inside"].alias("inside"))),
    )["out"]
    text = F.array_join(kept, "\n")
    return F.when(F.contains(text, F.lit(LOG_HEADING)), F.trim(F.substring(text, F.locate(LOG_HEADING, text), F.lit(1 << 20))))


def context_length(flags):
    """The number after ``--context-length``; null where it is absent."""
    return F.regexp_extract(F.coalesce(flags, F.lit("")), r"--context-length(?:[=\s]+)(\d+)", 1).try_cast("int")
