import itertools
import math
import random
from datetime import date
from fractions import Fraction

import pytest

from pyspark.sql import functions as F

import __spark_entry__ as contract
from conftest import rows
from millrace.functions.significance import chi_square_pvalue
from millrace.operators import drift


def two(spark, first, second, schema):
    return drift.two_samples(spark.createDataFrame(first, schema), spark.createDataFrame(second, schema))


def flags(df, **options):
    report = drift.drift_report(df, **options)
    found = {r["feature"]: r["detected"] for r in report.collect()}
    found["any_drift"] = drift.any_drift(report).first()[0]
    return found


def test_report_of_two_small_frames(spark):
    schema = "feature1 bigint, feature2 bigint"
    names = dict(numerical=["feature1", "feature2"], categorical=[])
    moved = two(spark, [(8, 40), (6, 41), (7, 43)], [(7, 90), (8, 70), (6, 55)], schema)
    assert flags(moved, **names) == {"feature1": False, "feature2": True, "any_drift": True}
    scores = {r["feature"]: r for r in drift.ks_scores(moved, names["numerical"], method="exact").collect()}
    assert scores["feature2"]["d"] == 1.0 and scores["feature2"]["p_value"] == pytest.approx(0.1)
    assert scores["feature1"]["d"] == 0.0 and scores["feature1"]["p_value"] == 1.0
    same = two(spark, [(-2, 17)] * 4, [(-2, 17)] * 5, schema)
    assert flags(same, **names) == {"feature1": False, "feature2": False, "any_drift": False}


def brute_distance(a, b):
    points = sorted({*a, *b})
    return max(
        abs(sum(x <= p for x in a) * len(b) - sum(x <= p for x in b) * len(a)) for p in points
    )


SHAPES = {
    "few values": lambda r, shift: float(r.randint(0, 5) + shift),
    "one hot value": lambda r, shift: 0.0 if r.random() < 0.4 else r.gauss(shift, 1),
    "continuous": lambda r, shift: r.gauss(shift, 3),
    "same distribution": lambda r, shift: r.random(),
    "far outliers": lambda r, shift: (
        r.choice([1e300, -1e300, 1e-300, r.random()]) if r.random() < 0.1 else r.random() + shift
    ),
    "one value": lambda r, shift: 7.0,
}


@pytest.mark.parametrize("shape", SHAPES)
@pytest.mark.parametrize("most_buckets", [3, 40, 200_000])
def test_distance_equals_brute_force(spark, shape, most_buckets):
    # A small bucket limit forces the grid and the second pass on few rows.
    rng = random.Random(len(shape))
    a = [SHAPES[shape](rng, 0.0) for _ in range(300)]
    b = [SHAPES[shape](rng, 0.3) for _ in range(250)]
    df = two(spark, [(x,) for x in a], [(x,) for x in b], "x double").repartition(5)
    r = drift.ks_distance(df, ["x"], most_buckets).first()
    assert (r["n1"], r["n2"], int(r["gap"])) == (300, 250, brute_distance(a, b))


def test_unusable_values_and_empty_windows(spark):
    nan, inf = float("nan"), float("inf")
    df = two(spark, [(1.0, 1.0), (nan, 2.0), (None, 3.0)], [(2.0, None), (inf, None)], "x double, y double")
    found = {r["feature"]: r for r in drift.ks_scores(df, ["x", "y"]).collect()}
    assert (found["x"]["n1"], found["x"]["n2"], found["x"]["d"]) == (1, 1, 1.0)
    assert (found["y"]["n1"], found["y"]["n2"]) == (3, 0)
    assert found["y"]["d"] is None and found["y"]["p_value"] is None
    assert flags(df.select("side", "x", "y"), numerical=["y"], categorical=[]) == {"y": None, "any_drift": False}


def test_small_pvalues_equal_path_counts(spark):
    def brute(a, b, h):
        hits = total = 0
        for steps in itertools.combinations(range(a + b), a):
            i = j = most = 0
            for k in range(a + b):
                i, j = (i + 1, j) if k in steps else (i, j + 1)
                most = max(most, abs(i * b - j * a))
            total, hits = total + 1, hits + (most >= h)
        return hits / total

    from pyspark.sql import functions as F

    from millrace.functions.significance import ks_pvalue

    cases = [(a, b, h) for a, b in [(3, 3), (4, 6), (2, 9), (1, 5)] for h in range(0, a * b + 1)]
    df = spark.createDataFrame(cases, "n1 bigint, n2 bigint, gap bigint")
    got = df.withColumn("p", ks_pvalue(F.col("n1"), F.col("n2"), F.col("gap"), "exact")).collect()
    for r in got:
        assert r["p"] == pytest.approx(brute(r["n1"], r["n2"], r["gap"]), abs=1e-12)


def test_exact_pvalue_with_far_rims_let_go(spark):
    from pyspark.sql import functions as F

    from millrace.functions.significance import ks_pvalue

    # Two samples of n: 2 * sum (-1)^(j+1) C(2n, n+jc) / C(2n, n), c the gap over n.
    def plain(n, c):
        of_all = math.comb(2 * n, n)
        return 2 * float(sum((-1) ** (j + 1) * Fraction(math.comb(2 * n, n + j * c), of_all) for j in range(1, n // c + 1)))

    cases = [(n, c) for n in (40, 3000) for c in (n // 40, n // 10, n // 3, n // 2)]
    df = spark.createDataFrame([(n, n, c * n) for n, c in cases], "n1 bigint, n2 bigint, gap bigint")
    got = df.withColumn("p", ks_pvalue(F.col("n1"), F.col("n2"), F.col("gap"), "exact")).collect()
    assert [r["p"] for r in got] == pytest.approx([plain(n, c) for n, c in cases], rel=1e-9, abs=1e-280)


def test_drift_ks_orders_takes_the_exact_pvalue(spark, tmp_path):
    days = [date(2001, 7, 20)] * 3 + [date(2001, 7, 27)] * 3
    orders = [(30 * i + 1, i, 100.0 + i, "1-URGENT", day, "F") for i, day in enumerate(days)]
    spark.createDataFrame(
        orders, "o_orderkey bigint, o_custkey bigint, o_totalprice double, o_orderpriority string, o_orderdate date, o_orderstatus string"
    ).write.parquet(f"{tmp_path}/orders.parquet")
    got = {r["feature"]: r["p_value"] for r in contract.queries()["drift_ks_orders"](spark, str(tmp_path)).collect()}
    # 2 of the 20 orders of 3 and 3 values are apart.
    assert got == {"feature1": 0.1, "feature2": 1.0, "feature3": 0.1}


def test_large_sample_pvalue_is_close_to_the_exact_one(spark):
    from pyspark.sql import functions as F

    from millrace.functions.significance import ks_pvalue, large_sample_pvalue

    df = spark.createDataFrame([(9000, 8000, 1_000_000), (9999, 300, 150_000)], "n1 bigint, n2 bigint, gap bigint")
    n1, n2, gap = F.col("n1"), F.col("n2"), F.col("gap")
    for r in df.select(
        ks_pvalue(n1, n2, gap, "exact").alias("exact"), large_sample_pvalue(n1, n2, gap / (n1 * n2)).alias("limit")
    ).collect():
        assert r["limit"] == pytest.approx(r["exact"], abs=0.01)


def psi(spark, first, second):
    df = two(spark, [(x,) for x in first], [(x,) for x in second], "c string")
    return drift.psi_scores(df, ["c"]).first()["psi"]


def test_psi_of_equal_shares_is_zero(spark):
    assert psi(spark, ["a", "b"] * 5, ["a", "b"] * 9) == 0.0


def test_psi_of_a_category_missing_on_one_side(spark):
    expected = (0.5 - 1.0) * math.log(0.5 / 1.0) + (0.5 - 1e-4) * math.log(0.5 / 1e-4)
    assert psi(spark, ["a", "b"], ["a", "a"]) == pytest.approx(expected)
    assert psi(spark, ["a", "a"], ["a", "b"]) == pytest.approx(expected)


def test_psi_threshold_and_null_category(spark):
    first, second = ["a"] * 50 + ["b"] * 50, ["a"] * 69 + ["b"] * 31
    value = sum((r - c) * math.log(r / c) for r, c in [(0.5, 0.69), (0.5, 0.31)])
    assert psi(spark, first + [None], second) == pytest.approx(value) and value > 0.15
    df = two(spark, [(x,) for x in first], [(x,) for x in second], "c string")
    assert flags(df, numerical=[], categorical=["c"]) == {"c": True, "any_drift": True}
    assert flags(df, numerical=[], categorical=["c"], thresholds={"c": 0.2}) == {"c": False, "any_drift": False}


def test_windows_of_one_scan(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(
        [("2024-01-01", 1), ("2024-01-10", 2), ("2024-01-20", 3), ("2023-12-31", 4)], "date string, feature1 int"
    ).withColumn("date", F.to_date("date"))
    out = drift.drift_windows(df, date(2024, 1, 22), begin_days=21, mid_days=7)
    assert rows(out, "feature1", "side") == [(1, "baseline"), (2, "baseline"), (3, "current")]


# Published table of the chi-square distribution, (degrees of freedom, value, upper tail).
CHI_TABLE = [
    (1, 3.841, 0.05), (1, 6.635, 0.01), (2, 5.991, 0.05), (3, 11.345, 0.01), (4, 1.064, 0.9), (5, 9.236, 0.1),
    (10, 18.307, 0.05), (10, 4.865, 0.9), (30, 43.773, 0.05), (100, 124.342, 0.05), (100, 77.929, 0.95),
]


def test_chi_square_pvalues_equal_a_table(spark):
    got = spark.createDataFrame(CHI_TABLE, "k int, x double, p double").select(
        "p", chi_square_pvalue(F.col("k"), F.col("x")).alias("own")
    ).collect()
    assert all(r["own"] == pytest.approx(r["p"], rel=2e-3) for r in got)
    # Two degrees of freedom have a closed form; so has the sum over a Poisson distribution for even ones.
    exact = [(2, x, math.exp(-x / 2)) for x in (1e-9, 0.3, 2.0, 3.999, 4.0, 50.0, 700.0)]
    for k, x in ((40, 25.0), (40, 90.0), (4000, 3900.0), (4000, 4200.0), (100_000, 100_500.0)):
        logs = [j * math.log(x / 2) - x / 2 - math.lgamma(j + 1) for j in range(k // 2)]
        exact.append((k, x, sum(map(math.exp, logs))))
    got = spark.createDataFrame(exact, "k int, x double, p double").select(
        "p", chi_square_pvalue(F.col("k"), F.col("x")).alias("own")
    ).collect()
    assert all(r["own"] == pytest.approx(r["p"], rel=1e-6, abs=1e-12) for r in got)
    odd = spark.sql("SELECT 0 AS k, 5D AS x UNION ALL SELECT 3, 0D").select(chi_square_pvalue(F.col("k"), F.col("x"))).collect()
    assert [r[0] for r in odd] == [1.0, 1.0]


def plain_wasserstein(a, b):
    points = sorted({*a, *b})
    return sum(
        (y - x) * abs(sum(v <= x for v in a) / len(a) - sum(v <= x for v in b) / len(b)) for x, y in itertools.pairwise(points)
    )


@pytest.mark.parametrize("shape", ["few values", "one hot value", "continuous", "one value"])
@pytest.mark.parametrize("range_rows", [7, 500_000])
def test_wasserstein_equals_brute_force(spark, shape, range_rows):
    rng = random.Random(len(shape))
    a = [SHAPES[shape](rng, 0.0) for _ in range(200)]
    b = [SHAPES[shape](rng, 0.7) for _ in range(150)]
    df = two(spark, [(x, -x) for x in a], [(x, None) for x in b], "x double, y double")
    x, y = drift.wasserstein_scores(df, ["x", "y"], range_rows).orderBy("feature").collect()
    mean = sum(a) / len(a)
    deviation = max(math.sqrt(sum((v - mean) ** 2 for v in a) / len(a)), 0.001)
    assert x["distance"] == pytest.approx(plain_wasserstein(a, b), abs=1e-9)
    assert x["score"] == pytest.approx(plain_wasserstein(a, b) / deviation, abs=1e-7)
    assert (y["n1"], y["n2"], y["distance"], y["score"]) == (200, 0, None, None)


def plain_shares(a, b, steps):
    if steps:
        low, high = min(a + b), max(a + b)
        k = math.ceil(math.log2(len(a + b)) + 1)
        a, b = ([min(k - 1, math.floor((x - low) * k / (high - low))) for x in side] for side in (a, b))
    return [(a.count(v) / len(a), b.count(v) / len(b)) for v in sorted({*a, *b}, key=str)]


def plain_jensen_shannon(shares):
    return math.sqrt(max(sum(x * math.log(2 * x / (r + c)) for r, c in shares for x in (r, c) if x) / 2, 0))


def plain_psi(shares):
    floors = [min(s[i] for s in shares if s[i]) for i in (0, 1)]
    filled = [[x or (floors[i] / 1e6 if floors[i] <= 1e-4 else 1e-4) for i, x in enumerate(s)] for s in shares]
    return sum((r - c) * math.log(r / c) for r, c in filled)


@pytest.mark.parametrize("shape, steps", [("continuous", True), ("few values", False), ("same distribution", True)])
def test_binned_scores_equal_plain_reckoning(spark, shape, steps):
    rng = random.Random(11)
    a = [SHAPES[shape](rng, 0.0) for _ in range(300)]
    b = [SHAPES[shape](rng, 1.0) for _ in range(200)]
    df = two(spark, [(x,) for x in a], [(x,) for x in b] + [(None,), (float("nan"),), (float("inf"),)], "x double")
    shares = plain_shares(a, b, steps)
    for test, plain in (("psi", plain_psi), ("jensenshannon", plain_jensen_shannon)):
        row = drift.binned_scores(df, ["x"], test).first()
        assert (row["n1"], row["n2"]) == (300, 200) and row["score"] == pytest.approx(plain(shares), abs=1e-9)


def test_categorical_tests(spark):
    a, b = ["p"] * 60 + ["q"] * 30 + ["r"] * 10, ["p"] * 25 + ["q"] * 20 + ["r"] * 5
    df = two(spark, [(x, "s", x, None) for x in a], [(x, "s", "new", "t") for x in b], "c string, one string, d string, none string")
    found = {r["feature"]: r["score"] for r in drift.categorical_scores(df, ["c", "one", "d", "none"]).collect()}
    statistic = (25 - 30) ** 2 / 30 + (20 - 15) ** 2 / 15 + 0
    assert found["c"] == pytest.approx(math.exp(-statistic / 2), abs=1e-9)
    assert (found["one"], found["d"], found["none"]) == (1.0, 0.0, None)
    js = {r["feature"]: r["score"] for r in drift.categorical_scores(df, ["c", "one"], "jensenshannon").collect()}
    assert js["c"] == pytest.approx(plain_jensen_shannon(plain_shares(a, b, False))) and js["one"] == 0.0


def test_report_with_tests_of_choice_reads_the_rows_twice(spark, tmp_path):
    """A sketch pass and a counting pass, whatever the tests; names may be numbers and categories at once."""
    rng = random.Random(3)
    rows_ = [(i % 2, rng.gauss(0, 1), rng.randint(0, 90), rng.choice("ab")) for i in range(600)]
    path = str(tmp_path / "rows")
    spark.createDataFrame(rows_, "s int, x double, y int, c string").write.parquet(path)
    read = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    source = spark.read.parquet(path).mapInArrow(seen, "s int, x double, y int, c string")
    df = source.select(F.when(F.col("s") == 0, drift.BASELINE).otherwise(drift.CURRENT).alias("side"), "x", "y", "c")
    report = drift.drift_report(
        df, ["x", "y"], ["c", "y"], stattests={"c": "chisquare"}, num_stattest="psi", cat_stattest="jensenshannon",
        thresholds={"x": 0.5, "y": 0.9},
    )
    found = {(r["feature"], r["stattest"]): r for r in report.collect()}
    assert read.value == 2 * 600
    assert set(found) == {("x", "psi"), ("y", "psi"), ("c", "chisquare"), ("y", "jensenshannon")}
    with pytest.raises(ValueError, match="tests are"):
        drift.drift_report(df, ["x"], [], num_stattest="chisquare")


def test_heavy_tails_are_dealt_over_ranges_of_like_size(spark, monkeypatch):
    """exp(4 * normal): one bucket of a grid may hold nearly all values, no range does."""
    rng = random.Random(9)
    a = [math.exp(4 * rng.gauss(0, 1)) for _ in range(3000)]
    b = [math.exp(4 * rng.gauss(0.02, 1)) for _ in range(3000)]
    df = two(spark, [(x,) for x in a], [(x,) for x in b], "x double")
    sizes = []
    plain = drift.stored

    def kept(frame, purpose):
        out = plain(frame, purpose)
        if purpose == "ranges":
            sizes.extend(r["count"] for r in out[0].groupBy("range").count().collect())
        return out

    monkeypatch.setattr(drift, "stored", kept)
    row = drift.ks_distance(df, ["x"], most_buckets=4, range_rows=50).first()
    assert row["gap"] == brute_distance(a, b)
    assert len(sizes) > 3 and max(sizes) < 150


@pytest.mark.parametrize("range_rows", [1, 3, 100])
def test_running_counts_over_ranges(spark, range_rows):
    rows_ = [("f", float(i), i % 3, (i * 7) % 4) for i in range(40)] + [("g", float(-i), 1, 0) for i in range(5)]
    counted = spark.createDataFrame(rows_, "feature string, v double, n1 bigint, n2 bigint").repartition(4)
    got = {(r["feature"], r["v"]): (r["upto1"], r["upto2"], r["next"]) for r in drift.in_order(counted, "v", range_rows=range_rows).collect()}
    for name in "fg":
        own = sorted(r[1:] for r in rows_ if r[0] == name)
        for i, (v, _, _) in enumerate(own):
            after = own[i + 1][0] if i + 1 < len(own) else None
            assert got[name, v] == (sum(r[1] for r in own[: i + 1]), sum(r[2] for r in own[: i + 1]), after)
