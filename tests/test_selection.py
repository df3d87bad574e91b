import math
import random

import pytest
from pyspark.sql import functions as F

from ringwatch.operators import selection
from ringwatch.operators.selection import SLACK, bracket_counts, brackets, select_quantiles

SPEC = {"median": ("linear", 0.5), "p10": ("linear", 0.1), "p99": ("nearest", 0.99), "max": ("nearest", 1.0)}


def exact(values, method, q):
    v = sorted(values)
    if method == "nearest":
        return v[math.floor((len(v) - 1) * q + 0.5)]
    at = (len(v) - 1) * q
    lo = math.floor(at)
    return v[lo] + (v[min(lo + 1, len(v) - 1)] - v[lo]) * (at - lo)


def compare(spark, rows, groups=("g",), **kw):
    df = spark.createDataFrame(rows, "g string, a double, b double").repartition(5)
    out = {(r.g, r.feature): r for r in select_quantiles(df, ["a", "b"], SPEC, list(groups), **kw).collect()}
    want = {}
    for g, a, b in rows:
        for f, v in (("a", a), ("b", b)):
            if v is not None and not math.isnan(v):
                want.setdefault((g, f), []).append(v)
    assert set(out) == set(want)
    for key, values in want.items():
        assert out[key].n == len(values)
        for name, (method, q) in SPEC.items():
            assert out[key][name] == pytest.approx(exact(values, method, q), rel=1e-12, abs=1e-12), (key, name)


def test_equals_sorting(spark):
    """Continuous, heavily tied, null and NaN values, a null group, groups of one and two rows."""
    rng = random.Random(3)
    rows = [("x", rng.gauss(0, 1e6), float(rng.randrange(3))) for _ in range(3000)]
    rows += [(None, rng.random(), None) for _ in range(501)]
    rows += [("one", 7.5, float("nan")), ("two", 1.0, -0.5), ("two", 4.0, -0.25)]
    compare(spark, rows)


def test_wrong_brackets_are_widened(spark, monkeypatch):
    """Brackets that miss their ranks are found out by their counts and replaced, the result is exact."""
    true, rounds = selection.brackets, []

    def off(sketches, cols, spec, slack):
        rounds.append(slack)
        t = true(sketches, cols, spec, slack)
        return t.withColumns({"_low": F.col("_low") + 1e9, "_high": F.col("_high") + 1e9}) if slack < 0.1 else t

    monkeypatch.setattr(selection, "brackets", off)
    rng = random.Random(4)
    compare(spark, [("x", rng.random(), rng.random()) for _ in range(400)])
    assert len(rounds) > 1 and rounds[-1] >= 0.1


def test_bracket_holds_a_small_share(spark):
    df = spark.range(200_000).select(((F.col("id") * 7919) % 200_003).cast("double").alias("v"))
    sketches = df.agg(F.kll_sketch_agg_double("v", F.lit(4096)).alias("_s_v"), F.count("v").alias("_n_v"))
    table = brackets(sketches, ["v"], {"median": ("linear", 0.5)}, SLACK).withColumn("_bracket", F.lit(0))
    counts = bracket_counts(df, table, [], ["v"], True)
    assert counts.count() <= 200_000 * 4 * SLACK
    assert counts.filter("value IS NULL").first().n < 100_000
    row = select_quantiles(df, ["v"], {"median": ("linear", 0.5)}).first()
    assert row["median"] == df.selectExpr("percentile(v, 0.5)").first()[0]


def test_without_rows(spark):
    df = spark.createDataFrame([], "g string, a double")
    assert select_quantiles(df, ["a"], SPEC, ["g"]).count() == 0
    assert select_quantiles(df, ["a"], SPEC).count() == 0


def test_extra_aggregates(spark):
    df = spark.createDataFrame([("x", 1.0, 1), ("x", 3.0, 0), ("y", 5.0, 1)], "g string, a double, f int")
    out = {r.g: (r.median, r.rate) for r in select_quantiles(df, ["a"], {"median": ("linear", 0.5)}, ["g"],
                                                             [F.avg("f").alias("rate"), F.max("f").alias("rows")]).collect()}
    assert out == {"x": (2.0, 0.5), "y": (5.0, 1.0)}
