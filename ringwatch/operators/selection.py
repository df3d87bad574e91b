"""Exact quantiles of continuous columns in two passes, without a table of distinct values.

:func:`ringwatch.operators.quantiles.quantiles` counts every distinct value; for a
continuous column that table is as long as the data. Here the first pass builds one
mergeable KLL sketch per group and column (map-side combine, a few tens of KB each) and reads
from it a bracket of two data values around each wanted rank. The second pass counts what lies
below each bracket and keeps only the values inside it, about ``2 * slack`` of the rows;
running counts over those (:func:`prefix_sum`, skew-safe) select the value.

A sketch is right with high probability only, so the counts tell whether a rank did fall into its
bracket. If one did not, the brackets are widened eightfold and counted again, in the end from the
exact minimum to the exact maximum, so the result never depends on the sketch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ringwatch.operators.prefix import prefix_sum
from ringwatch.operators.quantiles import nearest_rank_col
from ringwatch.session import ensure_checkpoint_dir

#: Sketch size: a normalised rank error of about 0.08 % at 99 % confidence.
SKETCH_K = 4096
#: Half the width of a bracket, as a share of a column's rows.
SLACK = 0.002
#: The bracket table is broadcast up to this many rows (under 100 bytes each), else joined.
BROADCAST_BRACKETS = 100_000


def _ranks(n: Column, method: str, q: float) -> tuple[Column, Column, Column]:
    """(lower rank, upper rank, weight of the upper one), 1-based."""
    if method == "nearest":
        r = nearest_rank_col(n, q)
        return r, r, F.lit(0.0)
    if method == "linear":
        pos = (n - 1).cast("double") * F.lit(q)
        lo = F.floor(pos).cast("bigint") + 1
        return lo, F.least(lo + 1, n), pos - F.floor(pos)
    raise ValueError(method)


def brackets(sketches: DataFrame, cols: list[str], spec: dict[str, tuple[str, float]],
             slack: float) -> DataFrame:
    """(groups, feature, _name, _rank_lo, _rank_hi, _weight, _low, _high, _rows): two data values around each wanted rank."""
    def at(sketch: Column, rank: float) -> Column:
        return F.kll_sketch_get_quantile_double(sketch, F.lit(rank))

    one = []
    for c in cols:
        n, s = F.col(f"_n_{c}"), F.col(f"_s_{c}")
        for name, (method, q) in spec.items():
            r_lo, r_hi, w = _ranks(n, method, q)
            few = n * slack < 4  # rank / n may be off by 1 / n: keep the bracket clear of it, or take everything
            low = F.when(few, at(s, 0.0)).otherwise(at(s, max(q - slack, 0.0)))
            high = F.when(few, at(s, 1.0)).otherwise(at(s, min(q + slack, 1.0)))
            one.append(F.struct(F.lit(c).alias("feature"), F.lit(name).alias("_name"), r_lo.alias("_rank_lo"),
                                r_hi.alias("_rank_hi"), w.alias("_weight"),
                                F.when(n > 0, low).alias("_low"), F.when(n > 0, high).alias("_high"), n.alias("_rows")))
    kept = [c for c in sketches.columns if not c.startswith(("_s_", "_n_"))]
    return sketches.select(*kept, F.explode(F.array(*one)).alias("_b")).select(*kept, "_b.*").filter("_rows > 0")


def bracket_counts(df: DataFrame, table: DataFrame, groups: list[str], cols: list[str], broadcast: bool) -> DataFrame:
    """(_bracket, value, n): how often each value inside a bracket occurs; ``value`` is null in the
    one row that counts everything below the bracket."""
    stacked = df.select(*groups, F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("_v")) for c in cols])).alias("_c"))
    stacked = stacked.select(*groups, "_c.feature", "_c._v").filter(F.col("_v").isNotNull() & ~F.isnan("_v"))
    narrow = table.select(*[F.col(g).alias(f"_g{i}") for i, g in enumerate(groups)], F.col("feature").alias("_f"),
                          "_bracket", "_low", "_high")
    same = (F.col("feature") == F.col("_f"))
    for i, g in enumerate(groups):
        same = same & F.col(g).eqNullSafe(F.col(f"_g{i}"))
    j = stacked.join(F.broadcast(narrow) if broadcast else narrow, same).filter(F.col("_v") <= F.col("_high"))
    inside = F.when(F.col("_v") >= F.col("_low"), F.col("_v"))
    return j.groupBy("_bracket", inside.alias("value")).agg(F.count(F.lit(1)).alias("n"))


def select_quantiles(df: DataFrame, cols: list[str], spec: dict[str, tuple[str, float]],
                     groups: list[str] | None = None, extra: list[Column] | None = None,
                     slack: float = SLACK, k: int = SKETCH_K) -> DataFrame:
    """One row per (groups, feature): ``feature``, ``n``, the ``spec`` columns, and the ``extra``
    aggregates of the group (from the first pass).

    ``spec``: output name -> (method, q) as in :func:`quantiles`. Nulls and NaN are no values and are
    not counted; a column without values has no row. Null group keys form a group. ``df`` is read
    once for the sketches and once per round of counting (one, unless a sketch was off), so hand in a
    stored or checkpointed table when it is costly to compute.
    """
    g, extra = list(groups or []), list(extra or [])
    ensure_checkpoint_dir(df.sparkSession)
    aggs = []
    for c in cols:
        v = F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double"))
        aggs += [F.kll_sketch_agg_double(v, F.lit(k)).alias(f"_s_{c}"), F.count(v).alias(f"_n_{c}")]
    sketches = (df.groupBy(*g) if g else df).agg(*aggs, *extra)
    names = [c for c in sketches.columns if c not in g and not c.startswith(("_s_", "_n_"))]
    sketches = sketches.checkpoint()
    while True:
        table = (brackets(sketches, cols, spec, slack).withColumn("_bracket", F.monotonically_increasing_id())
                 .checkpoint())
        small = table.limit(BROADCAST_BRACKETS + 1).count() <= BROADCAST_BRACKETS
        counts = bracket_counts(df, table, g, cols, small).checkpoint()
        if slack >= 1 or not _missed(table, counts):
            break
        slack *= 8
    cum = prefix_sum(counts, ["value"], ["n"], ["cum"], partition_cols=["_bracket"])
    wanted = table.select("_bracket", "_rank_lo", "_rank_hi")
    hit = cum.filter("value IS NOT NULL").join(F.broadcast(wanted) if small else wanted, "_bracket")
    picked = hit.groupBy("_bracket").agg(F.min(F.when(F.col("cum") >= F.col("_rank_lo"), F.col("value"))).alias("_at_lo"),
                                        F.min(F.when(F.col("cum") >= F.col("_rank_hi"), F.col("value"))).alias("_at_hi"))
    value = F.when(F.col("_weight") > 0, F.col("_at_lo") + (F.col("_at_hi") - F.col("_at_lo")) * F.col("_weight")).otherwise(F.col("_at_lo"))
    return table.join(picked, "_bracket").groupBy(*g, "feature").agg(
        F.first("_rows").alias("n"), *[F.max(F.when(F.col("_name") == n, value)).alias(n) for n in spec],
        *[F.first(c).alias(c) for c in names])


def _missed(table: DataFrame, counts: DataFrame) -> bool:
    """Whether some wanted rank lies outside its bracket."""
    seen = counts.groupBy("_bracket").agg(F.sum(F.when(F.col("value").isNull(), F.col("n")).otherwise(0)).alias("below"),
                                         F.sum("n").alias("upto"))
    off = F.col("upto").isNull() | (F.col("_rank_lo") <= F.col("below")) | (F.col("_rank_hi") > F.col("upto"))
    return not table.join(seen, "_bracket", "left").filter(off).isEmpty()
