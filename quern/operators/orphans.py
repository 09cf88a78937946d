"""References to records that do not exist.

Problem 2. The distinct, non-null foreign keys of the referring table (pre-aggregated
on the map side, so a key that holds a third of all rows travels as one row per
task) meet the parent keys in a left anti join; keys that have a parent are
compared by time in a second join of distinct keys. Only keys with at least one
orphan row go back to the rows, in a join salted over the referring side.

Defined results: a row with a null in its reference is no case; an empty key is
a key like any other; a row without created_at can be `missing` but not `late`
or `deleted`; repeated rows are cases each; of several parent rows of a key the
earliest created_at and the earliest deleted_at count; empty tables give none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The copies of each orphan key that meet the salted rows.
SALT = 16


def orphan_rows(rows: DataFrame, parents: DataFrame, keys: list[str], seq: str) -> DataFrame:
    """The rows of ``rows`` (keys, ``seq``, created_at) that find no live parent (keys, created_at, deleted_at)."""
    refs = rows.select(*keys, F.col(seq).alias("row_seq"), F.col("created_at").alias("_at"))
    for k in keys:
        refs = refs.where(F.col(k).isNotNull())
    foreign = refs.groupBy(*keys).agg(F.min("_at").alias("_first"), F.max("_at").alias("_last"))
    live = parents.groupBy(*keys).agg(F.min("created_at").alias("_born"), F.min("deleted_at").alias("_gone"))
    missing = foreign.join(live, keys, "left_anti").select(*keys, F.lit(None).cast("timestamp_ntz").alias("_born"), F.lit(None).cast("timestamp_ntz").alias("_gone"), F.lit(True).alias("_missing"))
    in_time = (
        foreign.join(live, keys)
        .where((F.col("_born") > F.col("_first")) | (F.col("_gone") <= F.col("_last")))
        .select(*keys, "_born", "_gone", F.lit(False).alias("_missing"))
    )
    bad = missing.unionByName(in_time).withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))))
    salted = refs.withColumn("_salt", F.pmod(F.hash("row_seq"), F.lit(SALT)))
    kind = (
        F.when(F.col("_missing"), "missing")
        .when(F.col("_born") > F.col("_at"), "late")
        .when(F.col("_gone") <= F.col("_at"), "deleted")
    )
    return salted.join(bad, [*keys, "_salt"]).select("row_seq", F.col("_at").alias("created_at"), kind.alias("orphan_kind")).where(F.col("orphan_kind").isNotNull())


def _keyed(df: DataFrame, keys: dict[str, Column], *more: str) -> DataFrame:
    return df.select(*[c.alias(k) for k, c in keys.items()], *more)


def project_orphans(items: DataFrame, annotations: DataFrame, reviews: DataFrame, comments: DataFrame) -> DataFrame:
    """ref_table, row_seq, created_at and orphan_kind over the project's two references."""
    from quern.tables import clean_key as ck

    times = ("created_at", "deleted_at")
    version = {"_k1": ck("item_id"), "_k2": F.col("iteration")}
    of_reviews = orphan_rows(_keyed(reviews, version, "review_seq", "created_at"), _keyed(items, version, *times), ["_k1", "_k2"], "review_seq")
    of_comments = orphan_rows(
        _keyed(comments, {"_k1": ck("item_id"), "_k2": ck("target_annotator_id")}, "comment_id", "created_at"),
        _keyed(annotations, {"_k1": ck("item_id"), "_k2": ck("annotator_id")}, *times),
        ["_k1", "_k2"],
        "comment_id",
    )
    tag = lambda df, t: df.select(F.lit(t).alias("ref_table"), "row_seq", "created_at", "orphan_kind")
    return tag(of_reviews, "reviews").unionByName(tag(of_comments, "comments"))


def orphan_counts(orphans: DataFrame) -> DataFrame:
    """Orphan rows per table, month of the referring row's created_at, and kind."""
    return orphans.groupBy("ref_table", F.date_format("created_at", "yyyy-MM").alias("month"), "orphan_kind").agg(F.count("*").alias("n_rows"))
