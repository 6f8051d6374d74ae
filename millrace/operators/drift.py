"""Distribution drift between two date windows.

Numerical features: Kolmogorov-Smirnov p-value ("ks"), population stability ("psi"), Jensen-Shannon distance
("jensenshannon") or normed Wasserstein distance ("wasserstein"). Categories: "psi", "jensenshannon" or the chi-square
p-value ("chisquare"). Every test reads the same stored counts: one pass sketches the numerical features, one
counts all features per value, bucket or category and side.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import date, timedelta
from functools import reduce

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.columns import finite, share_floor
from millrace.functions.significance import LIMIT, chi_square_pvalue, ks_pvalue
from millrace.schema import (
    CATEGORICAL,
    DATE,
    DRIFT_BEGIN_DAYS,
    DRIFT_MID_DAYS,
    DRIFT_THRESHOLD,
    NUMERICAL,
)
from millrace.workspace import stored

SIDE = "side"
BASELINE = "baseline"
CURRENT = "current"
INF = float("inf")
# Entries of a quantile sketch: about 0.15 % rank error in 20 KB.
SKETCH_SIZE = 1000
# Tasks of the first merging round.
SKETCH_GROUPS = 200
# Quantile cuts of a grid.
PARTS = 200
# Per feature; the bucket table of all features stays small enough to broadcast.
MOST_BUCKETS = 200_000
# Distinct values of a range when they are put in order.
RANGE_ROWS = 500_000
# A numerical feature with more distinct values than these in the baseline is compared in equal steps;
# the least deviation that a Wasserstein distance is divided by.
MOST_CATEGORIES, LEAST_DEVIATION = 20, 0.001
KS, PSI, JENSEN_SHANNON, WASSERSTEIN, CHI_SQUARE = "ks", "psi", "jensenshannon", "wasserstein", "chisquare"
NUMERICAL_TESTS = (KS, PSI, JENSEN_SHANNON, WASSERSTEIN)
CATEGORICAL_TESTS = (PSI, JENSEN_SHANNON, CHI_SQUARE)
P_VALUES = (KS, CHI_SQUARE)
# Before the names of categories in the counts, where a number may have the same name.
TEXT = "text "


def drift_windows(
    df: DataFrame,
    as_of: date,
    begin_days: int = DRIFT_BEGIN_DAYS,
    mid_days: int = DRIFT_MID_DAYS,
    column: str = DATE,
) -> DataFrame:
    """Rows of both windows with their side, from one scan.

    baseline is [as_of - begin_days, as_of - mid_days), current is everything from
    as_of - mid_days on.
    """
    begin = F.lit(as_of - timedelta(days=begin_days))
    mid = F.lit(as_of - timedelta(days=mid_days))
    day = F.col(column)
    return df.where(day >= begin).withColumn(SIDE, F.when(day < mid, BASELINE).otherwise(CURRENT))


def two_samples(baseline: DataFrame, current: DataFrame) -> DataFrame:
    """The same shape from two frames."""
    return baseline.withColumn(SIDE, F.lit(BASELINE)).unionByName(
        current.withColumn(SIDE, F.lit(CURRENT))
    )


def _long(df: DataFrame, entries: Mapping[str, Sequence[Column]], names: Sequence[str]) -> DataFrame:
    """One row per (side, feature): the entries of each feature stacked."""
    flat = [c for feature, columns in entries.items() for c in (F.lit(feature), *columns)]
    return df.select(SIDE, F.stack(F.lit(len(entries)), *flat).alias("feature", *names))


def _side_counts() -> list[Column]:
    return [
        F.count_if(F.col(SIDE) == BASELINE).alias("n1"),
        F.count_if(F.col(SIDE) == CURRENT).alias("n2"),
    ]


def _gap(c1: Column, c2: Column) -> Column:
    """c1/total1 - c2/total2 as the whole number c1*total2 - c2*total1."""
    wide = "decimal(19,0)"
    left = c1.cast(wide) * F.col("total2").cast(wide)
    right = c2.cast(wide) * F.col("total1").cast(wide)
    return left.cast("decimal(38,0)") - right.cast("decimal(38,0)")


@dataclass
class _Grid:
    """Buckets of one feature: ``ends`` cut the range, each part is cut into ``steps`` equal steps."""

    ends: list[float]
    steps: int

    def part(self) -> list[float]:
        """Splits for the search of the part a value is in; no value falls outside."""
        return [-INF, *self.ends[1:-1], INF]

    def bucket(self, value: Column, part: Column) -> Column:
        """Number of the bucket, never smaller for a greater value."""
        start = F.get(_constants(self.ends[:-1]), part)
        width = F.get(_constants([b - a for a, b in zip(self.ends, self.ends[1:])]), part)
        step = F.when(width > 0, F.floor((value - start) / width * self.steps)).otherwise(0)
        inside = F.greatest(F.lit(0), F.least(F.lit(self.steps - 1), step))
        return (part * self.steps + inside).cast("double")


def _constants(values: Sequence[float]) -> Column:
    # One string literal: an array of many number literals is slow to build and analyse.
    return F.expr(f"CAST(split('{','.join(map(repr, values))}', ',') AS ARRAY<DOUBLE>)")


@dataclass
class _Steps:
    """Equal steps between the least and the greatest value of both windows."""

    low: float
    high: float
    number: int

    def bucket(self, value: Column) -> Column:
        step = F.floor((value - F.lit(self.low)) * F.lit(float(self.number)) / F.lit(self.high - self.low))
        return F.least(F.lit(float(self.number - 1)), step.cast("double"))


@dataclass
class _Plan:
    """How each numerical feature is counted: by grid ("ks"), by steps, or by value where it is in neither."""

    tests: Mapping[str, str]
    grids: dict[str, _Grid]
    steps: dict[str, _Steps]


def _plan(values: DataFrame, tests: Mapping[str, str], most_buckets: int = MOST_BUCKETS) -> _Plan:
    """Grids for the "ks" features with too many distinct values to count each of them, steps for the binned ones.

    Sketches of a few KB per task are merged in two rounds, so no task receives the sketches
    of all others. Buckets of a grid are quantiles first, equal steps between them, and only decide how
    the work is divided, not its result. About 4 * sqrt(rows) of them make a bucket lighter
    than the gap two samples of one distribution show by chance. Steps are as many as
    log2(rows) + 1, rounded up (Sturges).
    """
    ks = [c for c, t in tests.items() if t == KS]
    binned = [c for c, t in tests.items() if t in (PSI, JENSEN_SHANNON)]
    if not ks and not binned:
        return _Plan(tests, {}, {})
    baseline = F.col(SIDE) == BASELINE

    def distinct(c: str) -> Column:
        counted = F.col(c).isNotNull() if c in ks else F.col(c).isNotNull() & baseline
        return F.hll_sketch_agg(F.when(counted, F.xxhash64(c))).alias(f"d_{c}")

    one_round = values.withColumn("_group", F.pmod(F.spark_partition_id(), F.lit(SKETCH_GROUPS))).groupBy("_group")
    sketches = one_round.agg(
        *[F.expr(f"kll_sketch_agg_double(`{c}`, {SKETCH_SIZE})").alias(f"q_{c}") for c in ks],
        *[distinct(c) for c in (*ks, *binned)],
        *[f(c).alias(f"{k}_{c}") for c in binned for k, f in (("n", F.count), ("low", F.min), ("high", F.max))],
    ).agg(
        *[F.expr(f"kll_merge_agg_double(`q_{c}`)").alias(f"q_{c}") for c in ks],
        *[F.hll_union_agg(f"d_{c}").alias(f"d_{c}") for c in (*ks, *binned)],
        *[f(f"{k}_{c}").alias(f"{k}_{c}") for c in binned for k, f in (("n", F.sum), ("low", F.min), ("high", F.max))],
    )
    ranks = _constants([i / PARTS for i in range(PARTS + 1)])
    counts = [F.expr(f"kll_sketch_get_n_double(`q_{c}`)") for c in ks]
    found = sketches.select(
        *[n.alias(f"n_{c}") for c, n in zip(ks, counts)],
        *[F.hll_sketch_estimate(f"d_{c}").alias(f"d_{c}") for c in (*ks, *binned)],
        *[F.when(n > 0, F.kll_sketch_get_quantile_double(f"q_{c}", ranks)).alias(f"q_{c}") for c, n in zip(ks, counts)],
        *[f"{k}_{c}" for c in binned for k in ("n", "low", "high")],
    ).first()
    grids, steps = {}, {}
    for c in ks:
        rows = found[f"n_{c}"] or 0
        if min(rows, found[f"d_{c}"] or 0) <= most_buckets:
            continue
        low, *inner, high = found[f"q_{c}"]
        inner = sorted({*inner})
        number = min(most_buckets, 4 * math.isqrt(rows)) // (len(inner) + 1)
        grids[c] = _Grid([low, *inner, high], max(1, number))
    for c in binned:
        if (found[f"d_{c}"] or 0) > MOST_CATEGORIES:
            steps[c] = _Steps(found[f"low_{c}"], found[f"high_{c}"], math.ceil(math.log2(found[f"n_{c}"]) + 1))
    return _Plan(tests, grids, steps)


def _numbers(df: DataFrame, features: Sequence[str]) -> list[Column]:
    return [finite(c).alias(c) for c in features]


def _entries(df: DataFrame, plan: _Plan, categorical: Sequence[str] = ()) -> DataFrame:
    """Rows (side, feature, value, bucket, category) of all features, from one scan; NULLs are left out."""
    # The same column may be a number and a category, so each kind has names of its own.
    df = df.select(SIDE, *_numbers(df, plan.tests), *[F.col(c).cast("string").alias(f"{c}_text") for c in categorical])
    if plan.grids:
        df = Bucketizer(
            splitsArray=[g.part() for g in plan.grids.values()],
            inputCols=list(plan.grids),
            outputCols=[f"{c}_part" for c in plan.grids],
            handleInvalid="keep",
        ).transform(df)

    def bucket(c: str) -> Column:
        if c in plan.grids:
            return plan.grids[c].bucket(F.col(c), F.col(f"{c}_part").cast("int"))
        return plan.steps[c].bucket(F.col(c)) if c in plan.steps else F.col(c)

    none, no_text = F.lit(None).cast("double"), F.lit(None).cast("string")
    flat = {c: (F.col(c), bucket(c), no_text) for c in plan.tests}
    flat |= {f"{TEXT}{c}": (none, none, F.col(f"{c}_text")) for c in categorical}
    return _long(df, flat, ["value", "bucket", "category"]).where("value IS NOT NULL OR category IS NOT NULL")


def _counts(rows: DataFrame) -> DataFrame:
    """Rows (feature, bucket, category, n1, n2, several), stored: what all tests are reckoned from."""
    counted = rows.groupBy("feature", "bucket", "category").agg(
        *_side_counts(), (F.min("value") < F.max("value")).alias("several")
    )
    return stored(counted, "drift")[0]


def _names(df: DataFrame, features: Sequence[str]) -> DataFrame:
    # One row per configured feature, so that a feature without values is still reported.
    return df.sparkSession.createDataFrame([(c,) for c in features], "feature string")


def in_order(counted: DataFrame, key: str, extra: Sequence[str] = (), range_rows: int = RANGE_ROWS) -> DataFrame:
    """Adds to rows (feature, ``key``, n1, n2, ...) the counts up to each row and the next key of its feature.

    Keys are distinct within a feature. They are put in order by ranges of about ``range_rows`` rows, whatever their
    distribution; counts are running sums inside a range, on top of those of the ranges before, which a pass over one
    row per range gives. So no task holds more than a range, however the values are spread.
    """
    columns = ["feature", key, "n1", "n2", *extra]
    counted, _ = stored(counted.select(*columns), "values")
    ranges = max(1, math.ceil(counted.count() / range_rows))
    placed, _ = stored(
        counted.repartitionByRange(ranges, "feature", key).withColumn("range", F.spark_partition_id()), "ranges"
    )
    sums = placed.groupBy("feature", "range").agg(
        F.sum("n1").alias("in1"), F.sum("n2").alias("in2"), F.min(key).alias("first")
    )
    # A row per range (and one more per feature).
    over = Window.partitionBy("feature").orderBy("range")
    before = sums.select(
        "feature", "range",
        (F.sum("in1").over(over) - F.col("in1")).alias("before1"),
        (F.sum("in2").over(over) - F.col("in2")).alias("before2"),
        F.lead("first").over(over).alias("following"),
    )
    inside = Window.partitionBy("feature", "range").orderBy(key)
    return (
        placed.withColumn("in1", F.sum("n1").over(inside)).withColumn("in2", F.sum("n2").over(inside))
        .withColumn("after", F.lead(key).over(inside))
        .join(before, ["feature", "range"])
        .select(
            *columns,
            (F.col("before1") + F.col("in1")).alias("upto1"),
            (F.col("before2") + F.col("in2")).alias("upto2"),
            F.coalesce("after", "following").alias("next"),
        )
    )


def _gaps_inside(rows: DataFrame, ends: DataFrame, range_rows: int = RANGE_ROWS) -> DataFrame:
    """Gap at every value of the unsettled buckets, their values ordered by ranges."""
    # At most most_buckets rows per feature. What is counted before a bucket, less what of it lies in unsettled ones.
    upto = Window.partitionBy("feature").orderBy("bucket")
    unsettled = ends.where("unsettled").select(
        "feature", "bucket", "total1", "total2",
        *[(F.col(f"before{k}") - F.sum(F.col(f"after{k}") - F.col(f"before{k}")).over(upto)
           + F.col(f"after{k}") - F.col(f"before{k}")).alias(f"shift{k}") for k in (1, 2)],
    )
    known = ["total1", "total2", "shift1", "shift2"]
    counted = (
        rows.select(SIDE, "feature", "bucket", "value").join(unsettled, ["feature", "bucket"])
        .groupBy("feature", "value", *known).agg(*_side_counts())
    )
    return in_order(counted, "value", known, range_rows).select(
        "feature", "total1", "total2",
        F.abs(_gap(F.col("shift1") + F.col("upto1"), F.col("shift2") + F.col("upto2"))).alias("gap"),
    )


def _ks(rows: DataFrame, counts: DataFrame, plan: _Plan, range_rows: int = RANGE_ROWS) -> DataFrame:
    """(feature, n1, n2, gap, d) of the "ks" features from their counts."""
    features = [c for c, t in plan.tests.items() if t == KS]
    counts = counts.where(F.col("feature").isin(features))
    # About features x most_buckets rows at most, so a window over a feature is bounded.
    whole = Window.partitionBy("feature")
    upto = whole.orderBy("bucket")
    ends = counts.select(
        "feature",
        "bucket",
        "several",
        F.sum("n1").over(whole).alias("total1"),
        F.sum("n2").over(whole).alias("total2"),
        (F.sum("n1").over(upto) - F.col("n1")).alias("before1"),
        (F.sum("n2").over(upto) - F.col("n2")).alias("before2"),
        F.sum("n1").over(upto).alias("after1"),
        F.sum("n2").over(upto).alias("after2"),
    ).withColumn("gap", F.abs(_gap(F.col("after1"), F.col("after2"))))
    gaps = ends.select("feature", "total1", "total2", "gap")
    if plan.grids:
        at_most = F.greatest(
            _gap(F.col("after1"), F.col("before2")), -_gap(F.col("before1"), F.col("after2"))
        )
        ends = ends.withColumn("unsettled", F.col("several") & (at_most > F.max("gap").over(whole)))
        gaps = gaps.unionByName(_gaps_inside(rows, ends, range_rows))
    none = _names(counts, features).select(
        "feature", F.lit(0).alias("total1"), F.lit(0).alias("total2"), F.lit(None).alias("gap")
    )
    best = (
        gaps.unionByName(none)
        .groupBy("feature")
        .agg(F.max("total1").alias("n1"), F.max("total2").alias("n2"), F.max("gap").alias("gap"))
    )
    pairs = F.col("n1").cast("double") * F.col("n2").cast("double")
    return best.withColumn("d", F.when(pairs > 0, F.col("gap").cast("double") / pairs))


def ks_distance(
    df: DataFrame, features: Sequence[str] = NUMERICAL, most_buckets: int = MOST_BUCKETS, range_rows: int = RANGE_ROWS
) -> DataFrame:
    """Exact two-sample distance per feature: (feature, n1, n2, gap, d) with d = gap / (n1 * n2).

    Rows are counted per bucket and side; a bucket is a single value where a feature has few of
    them. The cumulative counts at the bucket ends give exact values of the gap there, and
    bounds for the gap inside each bucket. Only buckets of several values whose bound exceeds
    the greatest exact gap are looked into value by value: usually a small part of the rows,
    so the values themselves are hardly shuffled. Those values are put in order by ranges of equal
    size, so a bucket may hold any share of the rows. A value that repeats is one row after counting, however
    often it occurs.
    """
    tests = {c: KS for c in features}
    plan = _plan(df.select(SIDE, *_numbers(df, features)), tests, most_buckets)
    rows = _entries(df, plan)
    return _ks(rows, _counts(rows), plan, range_rows)


def ks_scores(
    df: DataFrame, features: Sequence[str] = NUMERICAL, most_buckets: int = MOST_BUCKETS, method: str = LIMIT
) -> DataFrame:
    """``ks_distance`` with the two-sided p-value by the limit distribution or the exact one."""
    scored = ks_distance(df, features, most_buckets)
    return scored.withColumn("p_value", ks_pvalue(F.col("n1"), F.col("n2"), F.col("gap"), method))


def _totals(counts: DataFrame) -> DataFrame:
    return counts.groupBy("feature").agg(
        F.sum("n1").alias("total1"),
        F.sum("n2").alias("total2"),
        F.count("*").alias("kinds"),
        F.min(F.when(F.col("n1") > 0, F.col("n1"))).alias("least1"),
        F.min(F.when(F.col("n2") > 0, F.col("n2"))).alias("least2"),
    )


def _scored(counts: DataFrame, features: Sequence[str], score: Column, *parts: Column) -> DataFrame:
    """(feature, n1, n2, score): ``score`` is an aggregate over the ``parts`` of each bucket or category."""
    counts = counts.where(F.col("feature").isin(*features))
    # ``totals`` is one row per configured feature.
    scored = (
        counts.join(F.broadcast(_totals(counts)), "feature").select("*", *parts).groupBy("feature")
        .agg(F.max("total1").alias("n1"), F.max("total2").alias("n2"), score.alias("score"))
    )
    return (
        _names(counts, features)
        .join(F.broadcast(scored), "feature", "left")
        .fillna(0, ["n1", "n2"])
        .withColumn("score", F.when((F.col("n1") > 0) & (F.col("n2") > 0), F.col("score")))
    )


def _share(k: int, floor: bool) -> Column:
    n, size, least = F.col(f"n{k}"), F.col(f"total{k}"), F.col(f"least{k}")
    return F.when(n > 0, n / size).otherwise(share_floor(least / size) if floor else F.lit(0.0))


def _psi(counts: DataFrame, features: Sequence[str]) -> DataFrame:
    index = F.sum((F.col("r") - F.col("c")) * F.log(F.col("r") / F.col("c")))
    return _scored(counts, features, index, _share(1, True).alias("r"), _share(2, True).alias("c"))


def _jensen_shannon(counts: DataFrame, features: Sequence[str]) -> DataFrame:
    """The distance: root of the divergence, in natural units."""
    middle = (F.col("r") + F.col("c")) / 2
    # A share of nothing adds nothing.
    part = [F.when(F.col(x) > 0, F.col(x) * F.log(F.col(x) / middle)).otherwise(0.0) for x in ("r", "c")]
    divergence = F.sum(part[0] + part[1]) / 2
    return _scored(
        counts, features, F.sqrt(F.greatest(divergence, F.lit(0.0))), _share(1, False).alias("r"), _share(2, False).alias("c")
    )


def _chi_square(counts: DataFrame, features: Sequence[str]) -> DataFrame:
    """p-value of the current counts against the baseline's shares; 0 if a category is new, 1 if there is only one."""
    expected = F.col("n1") * F.col("total2") / F.col("total1")
    part = F.when(F.col("n1") > 0, (F.col("n2") - expected) * (F.col("n2") - expected) / expected)
    of_all = F.struct(F.sum("part").alias("statistic"), F.max("kinds").alias("kinds"), F.min("n1").alias("least"))
    p = chi_square_pvalue(F.col("score.kinds") - 1, F.col("score.statistic"))
    return _scored(counts, features, of_all, part.alias("part")).withColumn(
        "score", F.when(F.col("score.least") == 0, 0.0).when(F.col("score").isNotNull(), p)
    )


def psi_scores(df: DataFrame, features: Sequence[str] = CATEGORICAL) -> DataFrame:
    """Population stability index per feature: (feature, n1, n2, psi).

    sum((r - c) * ln(r / c)) over the categories of either window, with r and c the shares
    of a category. NULL is not a category.
    """
    return categorical_scores(df, features, PSI).withColumnRenamed("score", "psi")


def categorical_scores(df: DataFrame, features: Sequence[str] = CATEGORICAL, test: str = CHI_SQUARE) -> DataFrame:
    """(feature, n1, n2, score) of categories by "psi", "jensenshannon" or "chisquare"."""
    counts = _counts(_entries(df, _Plan({}, {}, {}), features))
    return _plain(_CATEGORICAL[test](counts, [f"{TEXT}{c}" for c in features]))


def binned_scores(df: DataFrame, features: Sequence[str] = NUMERICAL, test: str = PSI) -> DataFrame:
    """(feature, n1, n2, score) of numerical features by "psi" or "jensenshannon".

    Buckets are equal steps over the values of both windows, log2(rows) + 1 of them rounded up; where the baseline has no
    more than ``MOST_CATEGORIES`` distinct values, each value is a bucket. Buckets that both windows lack count nothing.
    """
    tests = {c: test for c in features}
    plan = _plan(df.select(SIDE, *_numbers(df, features)), tests)
    return _CATEGORICAL[test](_counts(_entries(df, plan)), features)


def _wasserstein(counts: DataFrame, features: Sequence[str], range_rows: int = RANGE_ROWS) -> DataFrame:
    counts = counts.where(F.col("feature").isin(*features))
    totals = counts.groupBy("feature").agg(
        F.sum("n1").alias("total1"), F.sum("n2").alias("total2"),
        F.try_divide(F.sum(F.col("n1") * F.col("bucket")), F.sum("n1")).alias("mean"),
    )
    # ``totals`` is one row per configured feature.
    steps = in_order(counts, "bucket", range_rows=range_rows).join(F.broadcast(totals), "feature")
    apart = F.abs(F.try_divide("upto1", "total1") - F.try_divide("upto2", "total2"))
    off = F.col("bucket") - F.col("mean")
    found = steps.groupBy("feature").agg(
        F.max("total1").alias("n1"), F.max("total2").alias("n2"),
        F.sum(F.coalesce((F.col("next") - F.col("bucket")) * apart, F.lit(0.0))).alias("distance"),
        F.sqrt(F.try_divide(F.sum(F.col("n1") * off * off), F.max("total1"))).alias("deviation"),
    )
    usable = (F.col("n1") > 0) & (F.col("n2") > 0)
    return (
        _names(counts, features).join(F.broadcast(found), "feature", "left").fillna(0, ["n1", "n2"])
        .withColumn("distance", F.when(usable, F.col("distance")))
        .withColumn("score", F.col("distance") / F.greatest(F.col("deviation"), F.lit(LEAST_DEVIATION)))
        .select("feature", "n1", "n2", "distance", "score")
    )


def wasserstein_scores(df: DataFrame, features: Sequence[str] = NUMERICAL, range_rows: int = RANGE_ROWS) -> DataFrame:
    """(feature, n1, n2, distance, score): the integral of |F1 - F2|, and that over the deviation of the baseline.

    Exact: a running sum over the distinct values of both windows, in order over ranges.
    """
    plan = _plan(df, {c: WASSERSTEIN for c in features})
    return _wasserstein(_counts(_entries(df, plan)), features, range_rows)


def _plain(scores: DataFrame) -> DataFrame:
    return scores.withColumn("feature", F.expr(f"substring(feature, {len(TEXT) + 1})"))


_CATEGORICAL = {PSI: _psi, JENSEN_SHANNON: _jensen_shannon, CHI_SQUARE: _chi_square}


def drift_report(
    df: DataFrame,
    numerical: Sequence[str] = NUMERICAL,
    categorical: Sequence[str] = CATEGORICAL,
    thresholds: Mapping[str, float] | None = None,
    default_threshold: float = DRIFT_THRESHOLD,
    most_buckets: int = MOST_BUCKETS,
    categorical_threshold: float | None = None,
    method: str = LIMIT,
    num_stattest: str = KS,
    cat_stattest: str = PSI,
    stattests: Mapping[str, str] | None = None,
) -> DataFrame:
    """One row per feature: (feature, stattest, n1, n2, score, threshold, detected).

    ``num_stattest`` and ``cat_stattest`` name the test of each kind, ``stattests`` that of single features. ``score`` is
    the p-value of "ks" and "chisquare" (drift when at or below the threshold), the index of "psi" or the distance of
    "jensenshannon" and "wasserstein" (drift when at or above). Score and flag are NULL when a window has no value
    of the feature. A feature's own threshold comes first, then that of categorical features, then
    the default. ``method`` is how the p-value of "ks" is reckoned.

    All features are counted in one pass over the rows, after one for the sketches if a test needs them; where
    buckets of "ks" stay undecided their values are read again.
    """
    of_kind = default_threshold if categorical_threshold is None else categorical_threshold
    limits = {c: default_threshold for c in numerical} | {c: of_kind for c in categorical} | dict(thresholds or {})
    own = dict(stattests or {})
    tests = {c: own.get(c, num_stattest) for c in numerical}
    kinds = {c: own.get(c, cat_stattest) for c in categorical}
    for names, allowed in ((tests, NUMERICAL_TESTS), (kinds, CATEGORICAL_TESTS)):
        if wrong := {c: t for c, t in names.items() if t not in allowed}:
            raise ValueError(f"tests are {allowed}, not {wrong}")
    plan = _plan(df.select(SIDE, *_numbers(df, tests)), tests, most_buckets)
    rows = _entries(df, plan, categorical)
    counts = _counts(rows)

    def of(names: Mapping[str, str], test: str) -> list[str]:
        return [c for c, t in names.items() if t == test]

    def reported(scores: DataFrame, names: Sequence[str], test: str, score: str = "score") -> DataFrame:
        limit = F.coalesce(*[F.when(F.col("feature") == c, F.lit(float(limits[c]))) for c in names])
        drifted = F.col("score") <= F.col("threshold") if test in P_VALUES else F.col("score") >= F.col("threshold")
        return scores.select(
            "feature", F.lit(test).alias("stattest"), "n1", "n2", F.col(score).alias("score"), limit.alias("threshold")
        ).withColumn("detected", drifted)

    parts = []
    if names := of(tests, KS):
        p_value = ks_pvalue(F.col("n1"), F.col("n2"), F.col("gap"), method)
        parts.append(reported(_ks(rows, counts, plan).withColumn("score", p_value), names, KS))
    for test in (PSI, JENSEN_SHANNON):
        if names := of(tests, test):
            parts.append(reported(_CATEGORICAL[test](counts, names), names, test))
    if names := of(tests, WASSERSTEIN):
        parts.append(reported(_wasserstein(counts, names), names, WASSERSTEIN))
    for test in CATEGORICAL_TESTS:
        if names := of(kinds, test):
            parts.append(reported(_plain(_CATEGORICAL[test](counts, [f"{TEXT}{c}" for c in names])), names, test))
    return reduce(DataFrame.unionByName, parts)


def any_drift(report: DataFrame) -> DataFrame:
    """(any_drift): true when at least one feature drifted; an undecided feature did not."""
    return report.agg(F.coalesce(F.bool_or("detected"), F.lit(False)).alias("any_drift"))
