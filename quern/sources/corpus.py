"""Corpus scans: projected parquet, shard lists, strides and fingerprints."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quern.sources.fs import Folder


@dataclass(frozen=True)
class Corpus:
    """A corpus: its root, its layout, the directories of its languages, and the columns that are read."""

    name: str
    root: str
    layout: str = "flat"  # or "per_language_dir"
    languages: dict[str, str] = field(default_factory=dict)
    columns: tuple[str, ...] = ("text", "id", "safety_score", "safety_probs", "metadata.language")


def list_shards(spark: SparkSession, corpus: Corpus, languages: list[str] | None = None, cap: int | None = None) -> list[str]:
    """Sorted parquet shards of a corpus on any file system, of the wanted languages only, ``cap`` at most (smoke runs)."""
    folder, root = Folder(spark), corpus.root.rstrip("/")
    if corpus.layout == "flat":
        found = folder.glob(f"{root}/*.parquet")
    else:
        unknown = [lang for lang in languages or [] if lang not in corpus.languages]
        if unknown:
            raise ValueError(f"no directory for {unknown} in corpus {corpus.name}")
        wanted = languages if languages is not None else sorted(corpus.languages)
        found = sorted(p for lang in wanted for p in folder.glob(f"{root}/{corpus.languages[lang]}/*.parquet"))
    return found[:cap] if cap is not None else found


def assert_projection(df: DataFrame, columns: tuple[str, ...]) -> None:
    """Fails loudly if a column, or a field of a struct, is not there."""
    for name in columns:
        kind = df.schema
        for part in name.split("."):
            names = getattr(kind, "names", [])
            if part not in names:
                raise ValueError(f"column {name!r} is not in the data; it has {df.columns}")
            kind = kind[part].dataType


def read_corpus(spark: SparkSession, corpus: Corpus, languages: list[str] | None = None, cap: int | None = None, leftover: bool = False) -> DataFrame:
    """text, id, safety_score, safety_probs, language, source_shard (relative to the root); only these are decoded.

    With ``leftover`` all other columns are kept as well, as one JSON object in ``metadata``.
    """
    shards = list_shards(spark, corpus, languages, cap)
    if not shards:
        raise FileNotFoundError(f"corpus {corpus.name} has no shards under {corpus.root}")
    df = spark.read.parquet(*shards)
    assert_projection(df, corpus.columns)
    base = Folder(spark).qualified(corpus.root).rstrip("/")
    path = F.regexp_replace(F.col("_metadata.file_path"), r"^file:/+", "file:/")
    rel = F.substring(path, len(base) + 2, 1 << 20)
    rest = [c for c in df.columns if c not in {x.split(".")[0] for x in corpus.columns}]
    more = [F.to_json(F.struct(*rest)).alias("metadata")] if leftover and rest else []
    out = df.select(*[F.col(c).alias(c.rpartition(".")[2]) for c in corpus.columns], *more, rel.alias("source_shard"), F.col("_metadata.row_index").alias("row_index"))
    return out.withColumn("text", F.coalesce("text", F.lit("")))


def file_rows(spark: SparkSession, *paths: str) -> DataFrame:
    """Rows of each file; no column is decoded."""
    path = F.col("_metadata.file_path")
    return spark.read.parquet(*paths).groupBy(path.alias("file_path")).agg(F.count("*").alias("n_rows"))


def file_hashes(spark: SparkSession, path: str) -> DataFrame:
    """file_name and SHA-256 of each whole file (prompts and the like, whose drift is looked for)."""
    files = spark.read.format("binaryFile").load(path)
    return files.select(F.element_at(F.split("path", "/"), -1).alias("file_name"), F.sha2("content", 256).alias("sha256"))


def buffer_shuffle(df: DataFrame, position: str, size: int, seed: str) -> DataFrame:
    """An approximate shuffle: each row leaves within ``size`` places of its own, as from a buffer of so many rows; ``place`` sorts it."""
    from quern.functions.ids import uniform

    return df.withColumn("place", F.col(position) + F.floor(uniform(seed, F.col(position)) * size))


def stride(shards: DataFrame, n: int, name: str = "source_shard") -> DataFrame:
    """The task of each distinct shard: its place in the sorted list modulo ``n``."""
    place = F.row_number().over(Window.orderBy(name)) - 1  # one row a shard
    return shards.select(name).distinct().withColumn("task", F.pmod(place, F.lit(n)))


def first_texts(df: DataFrame, n: int) -> DataFrame:
    """The first ``n`` texts in order of shard and row; fails if there are fewer."""
    out = df.orderBy("source_shard", "row_index").limit(n)
    if out.count() < n:
        raise ValueError(f"fewer than {n} texts")
    return out.select("text")


def linspace_shards(shards: list[str], k: int) -> list[str]:
    """``k`` evenly spaced shards, first and last among them."""
    if k >= len(shards):
        return list(shards)
    if k == 1:
        return shards[:1]
    return [shards[int(i * (len(shards) - 1) / (k - 1))] for i in range(k)]


def list_files(names: list[str], prefix: str = "", ending: str = ".parquet") -> list[str]:
    """The names of a remote listing that begin and end so, sorted; without the prefix if none begins so."""
    some = [n for n in names if n.endswith(ending)]
    return sorted(n for n in some if n.startswith(prefix)) or sorted(some)


def cached(spark: SparkSession, path: str, build) -> DataFrame:
    """The table at ``path``, built and written once if it is not there."""
    if not Folder(spark).exists(path):
        build().write.mode("errorifexists").parquet(path)
    return spark.read.parquet(path)
