"""Agreement and distribution statistics with the edge rules of each report.

Sums are kept as integers where the data are (scores in hundredths), so results
do not depend on the order in which partitions are added.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def pearson(x: Column, y: Column, least: int = 2) -> Column:
    """Aggregate: Pearson's r from sums; null below ``least`` pairs or without variance."""
    both = x.isNotNull() & y.isNotNull()
    n = F.count_if(both).cast("double")
    s = lambda c: F.sum(F.when(both, c)).cast("double")
    sx, sy, sxx, syy, sxy = s(x), s(y), s(x * x), s(y * y), s(x * y)
    vx, vy = n * sxx - sx * sx, n * syy - sy * sy
    return F.when((n >= least) & (vx > 0) & (vy > 0), (n * sxy - sx * sy) / (F.sqrt(vx) * F.sqrt(vy)))


def spearman(df: DataFrame, x: str, y: str, *group: str) -> DataFrame:
    """Per group: pairs and Spearman's rho with average ranks.

    All comes from the counts of distinct pairs of values: ranks from the margins'
    running counts, sums weighted by count. No group's rows are sorted.
    """
    both = df.where(F.col(x).isNotNull() & F.col(y).isNotNull())
    joint = both.groupBy(*group, x, y).agg(F.count("*").alias("_c"))
    w = Window.partitionBy(*group)
    for value, name in ((x, "_rx"), (y, "_ry")):
        margin = joint.groupBy(*group, value).agg(F.sum("_c").alias("_m"))
        upto = F.sum("_m").over(w.orderBy(value).rowsBetween(Window.unboundedPreceding, 0))
        # twice the average rank, a whole number: the last rank of a tie plus the first
        ranks = margin.select(*group, value, (2 * upto - F.col("_m") + 1).alias(name))
        joint = joint.join(ranks, [*group, value])
    n = F.sum("_c").cast("double")
    s = lambda e: F.sum(F.col("_c") * e).cast("double")
    a, b = F.col("_rx"), F.col("_ry")
    sx, sy, sxx, syy, sxy = s(a), s(b), s(a * a), s(b * b), s(a * b)
    vx, vy = n * sxx - sx * sx, n * syy - sy * sy
    rho = F.when((n >= 2) & (vx > 0) & (vy > 0), (n * sxy - sx * sy) / (F.sqrt(vx) * F.sqrt(vy)))
    return joint.groupBy(*group).agg(F.sum("_c").alias("n"), rho.alias("spearman"))


def kappa(a: Column, b: Column, flavour: str = "rank") -> Column:
    """Aggregate: Cohen's kappa of two accept/reject columns.

    ``rank``: null without pairs; 1 or null where chance agreement is complete.
    ``tools``: null below two pairs or two labels.
    """
    both = a.isNotNull() & b.isNotNull()
    n = F.count_if(both).cast("double")
    share = lambda c: F.count_if(both & c) / F.nullif(n, F.lit(0.0))
    po = share(a == b)
    a1, b1 = share(a == "accept"), share(b == "accept")
    pe = a1 * b1 + (1 - a1) * (1 - b1)
    k = (po - pe) / F.nullif(1 - pe, F.lit(0.0))
    if flavour == "rank":
        return F.when(n == 0, F.lit(None).cast("double")).when(pe >= 1, F.when(po >= 1, F.lit(1.0))).otherwise(k)
    labels = F.size(F.array_union(F.collect_set(F.when(both, a)), F.collect_set(F.when(both, b))))
    return F.when((n >= 2) & (labels >= 2), k)


def concordance(a: Column, b: Column) -> Column:
    """Aggregate: share of equal pairs; null without pairs."""
    both = a.isNotNull() & b.isNotNull()
    return F.count_if(both & (a == b)) / F.nullif(F.count_if(both).cast("double"), F.lit(0.0))


def index_percentile(df: DataFrame, value: str, shares: dict[str, float], *group: str, **more: Column) -> DataFrame:
    """Per group: the value at index min(n - 1, int(p n)) of the sorted values, from counts per value (``_c``), and ``more`` aggregates over these.

    The histogram of the values is what is sorted, not the values, so a hot
    group costs as many rows as it has distinct values.
    """
    hist = df.where(F.col(value).isNotNull()).groupBy(*group, value).agg(F.count("*").alias("_c"))
    w = Window.partitionBy(*group)
    run = hist.withColumn("_upto", F.sum("_c").over(w.orderBy(value).rowsBetween(Window.unboundedPreceding, 0))).withColumn("_n", F.sum("_c").over(w))
    at = lambda p: F.least(F.col("_n") - 1, F.floor(F.lit(p) * F.col("_n")))
    return run.groupBy(*group).agg(F.max("_n").alias("n"), *[F.min(F.when(F.col("_upto") > at(p), F.col(value))).alias(name) for name, p in shares.items()], *[c.alias(name) for name, c in more.items()])


def jaccard(a: Column, b: Column) -> Column:
    """Jaccard similarity of two arrays; 1 if both are empty."""
    union = F.size(F.array_union(a, b))
    return F.when(union == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / union.cast("double"))


def per_group_total(df: DataFrame, group: str, total: str, *aggregates: Column) -> DataFrame:
    """Aggregates per group and, in the same pass, over all: the row whose group is ``total``."""
    rolled = df.rollup(group).agg(F.grouping(group).alias("_g"), *aggregates)
    return rolled.withColumn(group, F.when(F.col("_g") == 1, F.lit(total)).otherwise(F.col(group).cast("string"))).drop("_g")


def linear_percentiles(df: DataFrame, value: str, ps: dict[str, float], *group: str) -> DataFrame:
    """Per group: percentiles by linear interpolation, from the counts of distinct values; no group's rows are sorted or gathered."""
    counts = df.where(F.col(value).isNotNull()).groupBy(*group, value).agg(F.count("*").alias("_c"))
    w = Window.partitionBy(*group)
    upto = F.sum("_c").over(w.orderBy(value).rowsBetween(Window.unboundedPreceding, 0))
    runs = counts.select(*group, value, (upto - F.col("_c")).alias("_from"), upto.alias("_to"), F.sum("_c").over(w).alias("_n"))
    v = F.col(value).cast("double")
    out = []
    for name, p in ps.items():
        place = F.lit(float(p)) * (F.col("_n") - 1)
        at = lambda k: F.max(F.when((F.col("_from") <= k) & (F.col("_to") > k), v))
        low, high = F.floor(place), F.ceil(place)
        out.append((at(low) + F.max(place - low) * (at(high) - at(low))).alias(name))
    return runs.groupBy(*group).agg(*out)
