"""Ranking metrics over a scored DataFrame.

Input: ``scored(txn_id, y, score, pattern_id, amount)``. Rows are joined to
scores by ``txn_id``, never by position. Total order for top-k flags is
(score desc, txn_id asc).

Plan for :func:`evaluate`: one ``TakeOrderedAndProject`` finds the k-th row
(score, txn_id) for every k (a handful of scalars reach the driver); then one
aggregate pass computes, for every k at once, rows and positives above and
tied at the cutoff (tie-safe precision), laundering value caught, and the
totals; one grouped pass over ring rows gives ring recall for every k; PR-AUC
is a group-by-score plus a distributed prefix sum. Everything else is
projection. No global sort, no single-partition window over the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ringwatch.functions.hashing import uniform_from_key
from ringwatch.functions.money import UNIT, unit_part, whole_part
from ringwatch.operators.prefix import prefix_sum
from ringwatch.session import ensure_checkpoint_dir

# The k of the reports, the mark of rows outside rings, hours per alert.
DEFAULT_K_VALUES = (50, 100, 500, 1000, 5000)
NO_PATTERN = -1
HOURS_PER_ALERT = 0.5


# ----------------------------------------------------------- scores

def rank_randomly(df: DataFrame, seed: int, key: str = "txn_id") -> Column:
    """seeded uniform score, independent of partitioning."""
    return uniform_from_key(seed, key)


def rank_by_amount(amount: str = "amount_paid") -> Column:
    """score = amount."""
    return F.col(amount).cast("double")


def to_scored(df: DataFrame, score: Column, y: str = "is_laundering", amount: str = "amount_paid",
              pattern: str = "pattern_id") -> DataFrame:
    pid = F.col(pattern) if pattern in df.columns else F.lit(NO_PATTERN)
    return df.select("txn_id", F.col(y).cast("int").alias("y"), score.cast("double").alias("score"),
                     pid.cast("int").alias("pattern_id"), F.col(amount).cast("double").alias("amount"))


# ------------------------------------------------------------- top-k (F2)

def top_k(scored: DataFrame, k: int) -> DataFrame:
    """F2: the first ``k`` rows in (score desc, txn_id) order with their 1-based rank.

    ``orderBy(...).limit(k)`` plans as TakeOrderedAndProject: each task keeps
    its own top k, only k rows per task move. The rank window runs on those
    k rows only.
    """
    top = scored.orderBy(F.col("score").desc(), F.col("txn_id")).limit(k)
    return top.withColumn("rank", F.row_number().over(Window.orderBy(F.col("score").desc(), F.col("txn_id"))))


def _cutoffs(scored: DataFrame, k_eff: list[int]) -> dict[int, tuple[float, int]]:
    kmax = max(k_eff)
    rows = top_k(scored, kmax).filter(F.col("rank").isin(*sorted(set(k_eff)))).select("rank", "score", "txn_id").collect()
    return {r["rank"]: (r["score"], r["txn_id"]) for r in rows}


def _dbl(x: float) -> str:
    return f"CAST('{x!r}' AS DOUBLE)"


def _in_top(cut: tuple[float, int]) -> str:
    """SQL: the row is at or before the k-th row in (score desc, txn_id) order."""
    s, i = cut
    return f"(score > {_dbl(s)} OR (score = {_dbl(s)} AND txn_id <= {int(i)}))"


def _totals(scored: DataFrame) -> tuple[int, int]:
    bad = F.col("score").isNull() | F.isnan("score")
    r = scored.agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("p"),
                   F.sum(F.when(bad, 1).otherwise(0)).alias("bad"),
                   F.sum(F.when(~F.col("y").isin(0, 1) | F.col("y").isNull(), 1).otherwise(0)).alias("bady")).first()
    if r["n"] == 0:
        raise ValueError("empty input")
    if r["bad"]:
        raise ValueError(f"{r['bad']} null or NaN scores")
    if r["bady"]:
        raise ValueError(f"{r['bady']} labels outside {{0, 1}}")
    return int(r["n"]), int(r["p"] or 0)


# ----------------------------------------------------------- metrics (H1-H5)

def _precision_exprs(k: int, ke: int, cut: tuple[float, int]) -> list[str]:
    """SQL aggregates for one k: rows and positives above / tied at the cutoff, value caught."""
    s = _dbl(cut[0])
    return [f"sum(CASE WHEN score > {s} THEN 1 ELSE 0 END) AS a{k}",
            f"sum(CASE WHEN score > {s} THEN y ELSE 0 END) AS pa{k}",
            f"sum(CASE WHEN score = {s} THEN 1 ELSE 0 END) AS t{k}",
            f"sum(CASE WHEN score = {s} THEN y ELSE 0 END) AS pt{k}",
            f"sum(CASE WHEN {_in_top(cut)} AND y = 1 THEN _w ELSE 0 END) AS cw{k}",
            f"sum(CASE WHEN {_in_top(cut)} AND y = 1 THEN _u ELSE 0 END) AS cu{k}"]


def _precision_value(k: int, ke: int) -> str:
    slots = f"({ke} - a{k})"
    tied = f"CASE WHEN t{k} > 0 AND {slots} > 0 THEN (pt{k} * {slots}) / t{k} ELSE 0.0D END"
    return f"((pa{k} + {tied}) / {ke})"


def precision_at_k(scored: DataFrame, k_values=DEFAULT_K_VALUES) -> DataFrame:
    """H1: tie-safe precision for every k: ``(k, precision)``."""
    return evaluate(scored, k_values, patterns=False, cost=False, average_precision=False).filter(
        F.col("metric") == "precision_at_k").select("k", F.col("value").alias("precision"))


def lift_at_k(scored: DataFrame, k_values=DEFAULT_K_VALUES) -> DataFrame:
    """H4: precision over the base rate for every k: ``(k, lift)``."""
    return evaluate(scored, k_values, patterns=False, cost=False, average_precision=False).filter(
        F.col("metric") == "lift_at_k").select("k", F.col("value").alias("lift"))


def cost_at_k(scored: DataFrame, k_values=DEFAULT_K_VALUES) -> DataFrame:
    """H5: hours, value caught and value missed for every k, as metric rows."""
    return evaluate(scored, k_values, patterns=False, cost=True, average_precision=False).filter(
        F.col("metric").startswith("cost_"))


def pr_auc_frame(scored: DataFrame) -> DataFrame:
    """H2: average precision, tied scores as one step. One row ``pr_auc``."""
    groups = scored.groupBy("score").agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("pos"))
    groups = groups.withColumn("_neg", -F.col("score"))
    cum = prefix_sum(groups, ["_neg"], ["n", "pos"], ["cn", "cp"])
    return cum.agg((F.sum(F.col("pos") * F.col("cp") / F.col("cn")) / F.sum("pos")).alias("pr_auc"))


def pr_auc_by(scored: DataFrame, group: str) -> DataFrame:
    """H2 for many rankings in one job: ``(group, pr_auc)``. One running sum over (group, score), less what lies before
    each group; the rows of a large group stay spread over tasks."""
    steps = (scored.groupBy(group, "score").agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("pos"))
             .withColumn("_neg", -F.col("score")))
    cum = prefix_sum(steps, [group, "_neg"], ["n", "pos"], ["cn", "cp"])
    start = cum.groupBy(group).agg(F.min(F.col("cn") - F.col("n")).alias("_n0"), F.min(F.col("cp") - F.col("pos")).alias("_p0"))
    part = F.col("pos") * (F.col("cp") - F.col("_p0")) / (F.col("cn") - F.col("_n0"))
    return cum.join(start, group).groupBy(group).agg((F.sum(part) / F.sum("pos")).alias("pr_auc"))


def pr_auc(scored: DataFrame) -> float:
    n, p = _totals(scored)
    if p == 0:
        raise ValueError("average precision needs at least one positive row")
    return float(pr_auc_frame(scored).first()[0])


def _ring_frame(scored: DataFrame, ks: list[int], cuts: dict[int, tuple[float, int]], kes: dict[int, int],
                threshold: float) -> DataFrame:
    """H3 for every k: per ring flagged share, then caught / hit counts."""
    ring = scored.filter(F.col("pattern_id") != NO_PATTERN)
    per = ring.groupBy("pattern_id").agg(
        F.count(F.lit(1)).alias("members"),
        *[F.expr(f"sum(CASE WHEN {_in_top(cuts[kes[k]])} THEN 1 ELSE 0 END)").alias(f"f{k}") for k in ks])
    aggs = ["count(1) AS n_patterns"]
    for k in ks:
        aggs += [f"sum(CASE WHEN f{k} / members >= {_dbl(threshold)} THEN 1 ELSE 0 END) AS cau{k}",
                 f"sum(CASE WHEN f{k} > 0 THEN 1 ELSE 0 END) AS hit{k}"]
    one = per.selectExpr(*aggs)
    rows = []
    for k in ks:
        cau, hit = f"coalesce(cau{k}, 0)", f"coalesce(hit{k}, 0)"
        rows += [(k, "pattern_n_patterns", "n_patterns"),
                 (k, "pattern_n_caught", cau),
                 (k, "pattern_recall", f"CASE WHEN n_patterns > 0 THEN {cau} / n_patterns ELSE 0.0D END"),
                 (k, "pattern_hit_rate", f"CASE WHEN n_patterns > 0 THEN {hit} / n_patterns ELSE 0.0D END"),
                 (k, "pattern_threshold", _dbl(threshold))]
    return _explode_rows(one, rows)


def _explode_rows(one_row: DataFrame, rows: list[tuple[int | None, str, str]]) -> DataFrame:
    """One-row frame -> tidy ``(metric, k, value)`` rows with one ``stack``."""
    parts = [f"'{m}', CAST({'NULL' if k is None else int(k)} AS BIGINT), CAST({v} AS DOUBLE)" for k, m, v in rows]
    return one_row.selectExpr(f"stack({len(rows)}, {', '.join(parts)}) AS (metric, k, value)")


def pattern_recall(scored: DataFrame, k_values=DEFAULT_K_VALUES, threshold: float = 0.5) -> DataFrame:
    """H3 for every k: ``n_patterns, n_caught, recall, hit_rate, threshold`` as metric rows."""
    return evaluate(scored, k_values, patterns=True, cost=False, average_precision=False, pattern_threshold=threshold).filter(
        F.col("metric").startswith("pattern_"))


def evaluate(scored: DataFrame, k_values=DEFAULT_K_VALUES, patterns: bool = True, cost: bool = True,
             hours_per_alert: float = HOURS_PER_ALERT, pattern_threshold: float = 0.5,
             materialize: bool = True, average_precision: bool = True) -> DataFrame:
    """H6: every metric as tidy rows ``(metric, k, value)``; ``k`` is null for global metrics."""
    if not 0 < pattern_threshold <= 1:
        raise ValueError(f"a ring counts as caught from a share above 0 up to 1, not {pattern_threshold}")
    ks = list(dict.fromkeys(int(k) for k in k_values))
    if any(k <= 0 for k in ks):
        raise ValueError("every k is 1 or more")
    if materialize:
        # Several passes follow (totals, cutoffs, PR-AUC sample, final). Cut the
        # lineage once with a reliable checkpoint in the session's checkpoint
        # folder: the scored rows are computed once and survive executor loss.
        ensure_checkpoint_dir(scored.sparkSession)
        scored = scored.checkpoint(eager=True)
    n, p = _totals(scored)
    if p == 0:
        raise ValueError("average precision needs at least one positive row")
    kes = {k: min(k, n) for k in ks}
    cuts = _cutoffs(scored, list(kes.values()))
    aggs = ["count(1) AS n", "sum(y) AS p",
            "sum(CASE WHEN y = 1 THEN _w ELSE 0 END) AS pw", "sum(CASE WHEN y = 1 THEN _u ELSE 0 END) AS pu"]
    for k in ks:
        aggs += _precision_exprs(k, kes[k], cuts[kes[k]])
    one = scored.withColumns({"_w": whole_part("amount"), "_u": unit_part("amount")}).selectExpr(*aggs)
    base = "(p / n)"
    rows: list = [(None, "base_rate", base), (None, "n_rows", "n"), (None, "n_positives", "p")]
    for k in ks:
        prec = _precision_value(k, kes[k])
        rows += [(k, "precision_at_k", prec), (k, "lift_at_k", f"CASE WHEN {base} > 0 THEN {prec} / {base} END")]
        if cost:
            rows += [(k, "cost_investigator_hours", _dbl(kes[k] * hours_per_alert)),
                     (k, "cost_laundering_value_caught", f"cw{k} + cu{k} / {UNIT}.0D"),
                     (k, "cost_laundering_value_missed", f"(pw - cw{k}) + (pu - cu{k}) / {UNIT}.0D")]
    out = _explode_rows(one, rows)
    if average_precision:
        out = pr_auc_frame(scored).selectExpr("'pr_auc' AS metric", "CAST(NULL AS BIGINT) AS k",
                                              "CAST(pr_auc AS DOUBLE) AS value").unionByName(out)
    if patterns:
        out = out.unionByName(_ring_frame(scored, ks, cuts, kes, pattern_threshold))
    return out


def flatten_metrics(tidy: DataFrame) -> DataFrame:
    """``(name, value)`` with names ``pr_auc, base_rate, n_rows, n_positives,
    precision_at_{k}, lift_at_{k}, pattern_recall_at_{k}, pattern_hit_rate_at_{k}, value_missed_at_{k}``."""
    rename = {"precision_at_k": "precision_at_", "lift_at_k": "lift_at_", "pattern_recall": "pattern_recall_at_",
              "pattern_hit_rate": "pattern_hit_rate_at_", "cost_laundering_value_missed": "value_missed_at_"}
    m = F.col("metric")
    name = F.lit(None).cast("string")
    for src, dst in rename.items():
        name = F.when(m == src, F.concat(F.lit(dst), F.col("k").cast("string"))).otherwise(name)
    name = F.when(F.col("k").isNull(), m).otherwise(name)
    return tidy.select(name.alias("name"), "value").filter(F.col("name").isNotNull())
