"""Exact statistics of numeric features: global and by episode in one pass, and from histograms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..schemas import METRICS, QUANTILES


def _moments(x: str) -> list[Column]:
    return [F.min(x).alias("min"), F.max(x).alias("max"), F.avg(x).alias("mean"), F.stddev_pop(x).alias("std"), F.count(x).alias("count")]


def components(frames: DataFrame, features: list[str], keys: list[str]) -> DataFrame:
    """(keys, feature, component, x): numbers as single components, arrays one row for each element."""
    kinds = dict(frames.dtypes)
    parts = []
    for f in features:
        value = F.col(f).cast("array<double>") if kinds[f].startswith("array") else F.array(F.col(f).cast("double"))
        parts.append(F.struct(F.lit(f).alias("feature"), value.alias("values")))
    rows = frames.select(*keys, F.explode(F.array(*parts)).alias("p"))
    return rows.select(*keys, "p.feature", F.posexplode("p.values").alias("component", "x"))


def _wide(frames: DataFrame, features: list[str], by: list[str], quantiles: bool) -> DataFrame:
    """(by, feature, component, moments, quantiles if wanted) of features that are single numbers: aggregates side by side, no row for each value."""
    rows = frames.select(*by, *(F.col(f).cast("double").alias(f"_{i}") for i, f in enumerate(features)))
    q = f"array({', '.join(map(str, QUANTILES.values()))})"
    columns, structs = [], []
    for i, f in enumerate(features):
        own = _moments(f"_{i}") + ([F.expr(f"percentile(_{i}, {q})").alias("q")] if quantiles else [])
        columns.append(F.struct(*own).alias(f"s{i}"))
        fields = [F.col(f"s{i}.{m}").alias(m) for m in ("min", "max", "mean", "std", "count")]
        fields += [F.get(f"s{i}.q", F.lit(k)).alias(name) for k, name in enumerate(QUANTILES)] if quantiles else []
        structs.append(F.struct(F.lit(f).alias("feature"), F.lit(0).alias("component"), *fields))
    found = rows.groupBy(*by).agg(*columns) if by else rows.agg(*columns)
    return found.select(*by, F.explode(F.array(*structs)).alias("x")).select(*by, "x.*")


def _long(frames: DataFrame, features: list[str], by: list[str], quantiles: bool) -> DataFrame:
    """What ``_wide`` gives, of features that are arrays."""
    keys = [*by, "feature", "component"]
    q = [F.expr(f"percentile(x, array({', '.join(map(str, QUANTILES.values()))}))").alias("q")] if quantiles else []
    found = components(frames, features, by).groupBy(*keys).agg(*_moments("x"), *q)
    return found.select(*keys, "min", "max", "mean", "std", "count", *((F.get("q", F.lit(k)).alias(name) for k, name in enumerate(QUANTILES)) if quantiles else ()))


def _figures(frames: DataFrame, features: list[str], by: list[str], quantiles: bool) -> DataFrame:
    kinds = dict(frames.dtypes)
    arrays = [f for f in features if kinds[f].startswith("array")]
    single = [f for f in features if f not in arrays]
    parts = [make(frames, names, by, quantiles) for make, names in ((_wide, single), (_long, arrays)) if names]
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def feature_stats(frames: DataFrame, features: list[str], episode: str | None = None) -> DataFrame:
    """Minimum, maximum, mean, population deviation, count and exact quantiles (linear) of each feature's components.

    With episode there is a row for each episode too, the global rows having null for it. Moments are
    partial sums of columns side by side; an episode's quantiles hold a count for each of its distinct
    values, and the global ones come from ``rank_quantiles`` with the moments' extremes, so no task ever
    holds a feature's values. Nulls count for nothing, as empty cells of optional sensors do.
    """
    by = ["feature", "component"]
    columns = [*by, "min", "max", "mean", "std", "count", *QUANTILES]
    moments = _figures(frames, features, [], False).where("count > 0 OR component = 0")
    found = moments.where("count > 0").select(*by, F.col("min").alias("lo"), F.col("max").alias("hi"))
    out = moments.join(rank_quantiles(components(frames, features, []), by, extremes=found), by, "left").select(*columns)
    if not episode:
        return out
    kind = frames.schema[episode].dataType
    return _figures(frames, features, [episode], True).select(episode, *columns).unionByName(out.select(F.lit(None).cast(kind).alias(episode), *columns))


def rank_quantiles(rows: DataFrame, by: list[str], x: str = "x", ranges: int = 4096, extremes: DataFrame | None = None) -> DataFrame:
    """Exact linear quantiles of x for a few groups of any size, by selection of ranks.

    Each group's values fall into equal ranges between its extremes; counts of the ranges say which few
    of them hold wanted ranks; only those ranges' distinct values are counted and put in order, each
    range by itself. Where far outliers put most values into one range, that range's order is a sort
    that spills. Nulls count for nothing. extremes: (by, lo, hi) of the groups, where they are known.
    """
    rows = rows.where(F.col(x).isNotNull()).select(*by, F.col(x).cast("double").alias("v"))
    found = rows.groupBy(*by).agg(F.min("v").alias("lo"), F.max("v").alias("hi")) if extremes is None else extremes
    part = F.when(F.col("hi") > F.col("lo"), F.least(F.lit(ranges - 1), F.floor((F.col("v") / ranges - F.col("lo") / ranges) / (F.col("hi") / ranges - F.col("lo") / ranges) * ranges))).otherwise(0)
    dealt = rows.join(F.broadcast(found), by).select(*by, "v", part.cast("int").alias("r"))  # a row for each of a few groups
    sizes = dealt.groupBy(*by, "r").agg(F.count("*").alias("n"))
    order = Window.partitionBy(*by).orderBy("r")  # as many rows as ranges at most
    sizes = sizes.withColumn("high", F.sum("n").over(order)).withColumn("total", F.sum("n").over(Window.partitionBy(*by)))
    wanted = F.array(*(F.struct(F.lit(name).alias("q"), F.lit(p).alias("p")) for name, p in QUANTILES.items()))
    sizes = sizes.select(*by, "r", (F.col("high") - F.col("n")).alias("low"), "high", F.explode(wanted).alias("w"), ((F.col("total") - 1) * F.col("w.p")).alias("at"))
    held = F.array_compact(F.array(*(F.when((F.col("low") <= rank) & (rank < F.col("high")), rank) for rank in (F.floor("at"), F.ceil("at")))))
    sizes = sizes.select(*by, "r", "low", F.struct(F.col("w.q").alias("q"), F.col("at"), held.alias("ranks")).alias("w")).where(F.size("w.ranks") > 0)
    sizes = sizes.groupBy(*by, "r", "low").agg(F.collect_list("w").alias("ws"))  # five at most
    few = dealt.join(F.broadcast(sizes.select(*by, "r")), [*by, "r"], "left_semi").groupBy(*by, "r", "v").agg(F.count("*").alias("n"))
    inside = Window.partitionBy(*by, "r").orderBy("v")
    few = few.withColumn("last", F.sum("n").over(inside)).join(F.broadcast(sizes), [*by, "r"])
    few = few.select(*by, "v", (F.col("low") + F.col("last") - F.col("n")).alias("a"), (F.col("low") + F.col("last")).alias("b"), F.explode("ws").alias("w"))
    few = few.where(F.exists("w.ranks", lambda k: (k >= F.col("a")) & (k < F.col("b"))))
    ends = few.groupBy(*by, F.col("w.q").alias("q"), F.col("w.at").alias("at")).agg(F.min("v").alias("a"), F.max("v").alias("b"))
    value = F.col("a") + (F.col("b") - F.col("a")) * (F.col("at") - F.floor("at"))
    return ends.select(*by, "q", value.alias("v")).groupBy(*by).pivot("q", list(QUANTILES)).agg(F.first("v"))


def as_vectors(stats: DataFrame, by: list[str]) -> DataFrame:
    """Component rows as one row for each feature with an array for each metric, in component order."""
    rows = stats.groupBy(*by).agg(F.sort_array(F.collect_list(F.struct("component", *METRICS))).alias("c"))
    return rows.select(*by, *(F.col(f"c.{m}").alias(m) for m in METRICS))


def histogram(values: DataFrame, by: list[str], bin_column: str) -> DataFrame:
    """(by, bin, n): counts of whole numbers, added up in the tasks first."""
    return values.groupBy(*by, F.col(bin_column).cast("int").alias("bin")).agg(F.count("*").alias("n"))


def histogram_stats(bins: DataFrame, by: list[str], scale: float = 255.0) -> DataFrame:
    """The ten metrics from (by, bin, n) alone, values bin / scale."""
    order = Window.partitionBy(*by).orderBy("bin")
    rows = bins.withColumn("high", F.sum("n").over(order)).withColumn("total", F.sum("n").over(Window.partitionBy(*by)))
    total, x = F.sum("n"), F.col("bin") / scale
    mean = F.sum(x * F.col("n")) / total

    def at_rank(p: float) -> Column:
        at = (F.col("total") - 1) * p

        def pick(r: Column) -> Column:
            return F.min(F.when(F.col("high") > r, x))

        low, high = pick(F.floor(at)), pick(F.ceil(at))
        return low + (high - low) * F.max(at - F.floor(at))

    return rows.groupBy(*by).agg(
        F.min(x).alias("min"),
        F.max(x).alias("max"),
        mean.alias("mean"),
        F.sqrt(F.greatest(F.lit(0.0), F.sum(x * x * F.col("n")) / total - mean * mean)).alias("std"),
        total.alias("count"),
        *(at_rank(p).alias(name) for name, p in QUANTILES.items()),
    )


def nested(column: str) -> Column:
    """[v, …] as [[[v]], …], the shape of image statistics."""
    return F.transform(column, lambda v: F.array(F.array(v)))


def tolerance(metric, actual, legacy: bool = False) -> Column:
    """How far a published value may be from the recomputed one."""
    base = F.lit(1e-4) if legacy else F.when(F.col(metric).isin("mean", "std"), 5e-8).otherwise(1e-8)
    return base * F.greatest(F.lit(1.0), F.abs(F.col(actual)))


def long_form(stats: DataFrame, by: list[str]) -> DataFrame:
    """(by, metric, value)."""
    pairs = ", ".join(f"'{m}', CAST({m} AS DOUBLE)" for m in METRICS)
    return stats.select(*by, F.expr(f"stack({len(METRICS)}, {pairs}) AS (metric, value)"))


def compare_stats(published: DataFrame, actual: DataFrame, by: list[str], legacy: bool = False) -> DataFrame:
    """Values (by, metric) that are missing on a side or too far apart."""
    a = long_form(actual, by).withColumnRenamed("value", "actual")
    p = long_form(published, by).withColumnRenamed("value", "published")
    rows = a.join(p, [*by, "metric"], "full_outer")
    return rows.where(~F.coalesce(F.abs(F.col("published") - F.col("actual")) <= tolerance("metric", "actual", legacy), F.lit(False)))


def stats_issues(stats: DataFrame, by: list[str], image: bool = False) -> DataFrame:
    """Rows of component statistics with an array of what is wrong in them."""

    def slack(x: str) -> Column:
        return 1e-9 * F.greatest(F.lit(1.0), F.abs(F.col(x)))

    names = ["min", "q01", "q10", "q50", "q90", "q99", "max"]
    finite = [F.col(m).isNotNull() & ~F.isnan(F.col(m).cast("double")) & (F.abs(F.col(m)) < float("inf")) for m in METRICS]
    ordered = [F.col(a) <= F.col(b) + slack(b) for a, b in zip(names, names[1:], strict=False)]
    checks = [
        (~_all(finite), "not_finite"),
        (~_all(ordered), "quantile_order"),
        ((F.col("mean") < F.col("min") - slack("min")) | (F.col("mean") > F.col("max") + slack("max")), "mean_range"),
        (F.col("std") < 0, "negative_std"),
        (F.col("count") < 1, "count"),
    ]
    if image:
        checks.append(((F.col("min") < 0) | (F.col("max") > 1) | (F.col("std") > 0.5 + 1e-9), "image_range"))
    return stats.select(*by, F.array_compact(F.array(*(F.when(F.coalesce(t, F.lit(True)), F.lit(c)) for t, c in checks))).alias("issues"))


def _all(tests: list[Column]) -> Column:
    out = tests[0]
    for t in tests[1:]:
        out = out & t
    return out
