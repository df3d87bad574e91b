"""Parity, alert queue, ego network, capacity curve, drift, champion /
challenger, alert forecast, staleness, future-invariance audit."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ringwatch.operators.history import HISTORY_FEATURES, build_account_history_features
from ringwatch.operators.metrics import evaluate
from ringwatch.operators.sampling import fanout_sample
from ringwatch.operators.scaler import EdgeScaler
from ringwatch.session import ensure_checkpoint_dir
from ringwatch.sources.transfers import ntz_lit, seconds_between


def parity(a: DataFrame, b: DataFrame, key: str, cols: list[str], tolerance: float = 0.0) -> DataFrame:
    """Full outer join of two feature tables on ``key``; per column the number
    of rows whose values differ (null-safe), plus rows present on one side only.
    Floating-point columns may differ by ``tolerance`` (relative above 1), since sums
    and means of doubles depend on the order in which a shuffle brings the rows."""
    j = a.select(key, F.lit(True).alias("_a"), *[F.col(c).alias(f"a_{c}") for c in cols]).join(
        b.select(key, F.lit(True).alias("_b"), *[F.col(c).alias(f"b_{c}") for c in cols]), key, "full_outer")
    types = dict(a.dtypes)

    def same(c: str) -> Column:
        x, y = F.col(f"a_{c}"), F.col(f"b_{c}")
        if tolerance and types[c] in ("double", "float"):
            near = F.abs(x - y) <= tolerance * F.greatest(F.abs(x), F.lit(1.0))
            return F.coalesce(near, x.eqNullSafe(y))
        return x.eqNullSafe(y)

    both = F.col("_a").isNotNull() & F.col("_b").isNotNull()
    aggs = [F.sum(F.when(both & same(c), 0).otherwise(1)).cast("bigint").alias(c) for c in cols]
    one = j.agg(*aggs)
    return one.unpivot([], cols, "feature", "differing")


def alert_queue(scored_features: DataFrame, reason_cols: list[str], scaler: EdgeScaler, k: int = 20,
                n_reasons: int = 3) -> DataFrame:
    """Accounts ranked by their highest transfer score (payer side), top ``k``, with the
    ``n_reasons`` features of that transfer that lie farthest above the training mean, in
    standard deviations (``scaler``, D9/D10), as reasons. Ties go by name."""
    best = Window.partitionBy("from_account").orderBy(F.col("score").desc(), F.col("txn_id"))
    top = (scored_features.withColumn("_rn", F.row_number().over(best)).filter(F.col("_rn") == 1)
           .orderBy(F.col("score").desc(), F.col("from_account")).limit(k))
    top = scaler.transform(top.select("from_account", "score", "txn_id", *reason_cols), reason_cols)
    pairs = F.array(*[F.struct(F.round(-F.col(c), 6).alias("v"), F.lit(c).alias("name")) for c in reason_cols])
    reasons = F.concat_ws(",", F.transform(F.slice(F.array_sort(pairs), 1, n_reasons), lambda x: x["name"]))
    return top.select(F.col("from_account").alias("account"), F.col("score").alias("max_score"),
                      F.col("txn_id").alias("top_txn_id"), reasons.alias("reasons"))


def ego_network(edges: DataFrame, seeds: DataFrame, hops: int = 2, fanout: int | None = None,
                seed: int = 42) -> DataFrame:
    """The money-flow subgraph from ``seeds`` (column ``account``), breadth first: at each hop
    the out-edges of the frontier, whose payees not reached before become the next frontier.

    An account is expanded once, at its least distance, so every edge comes once with its least
    hop, in cycles too. The walk ends with the hops or with an empty frontier. ``fanout``
    keeps at most that many out-edges per account (F6: smallest hashes first, under ``seed``);
    None keeps all. Null accounts are neither seeds nor reached. The frontier is
    checkpointed per hop, so a hop's plan does not hold the hops before. The joins carry no
    hint: a small frontier is broadcast by its measured size, and a hub's edges are split
    by adaptive execution otherwise."""
    ensure_checkpoint_dir(edges.sparkSession)
    frontier = seeds.select("account").filter(F.col("account").isNotNull()).distinct().checkpoint()
    reached, out = frontier, None
    for h in range(1, hops + 1):
        step = edges.join(frontier, edges["src"] == frontier["account"], "left_semi").select("txn_id", "src", "dst")
        if fanout is not None:
            step = fanout_sample(step, fanout, node="src", seed=seed)
        step = step.withColumn("hop", F.lit(h)).checkpoint()
        out = step if out is None else out.unionByName(step)
        if h == hops:
            break
        payees = step.select(F.col("dst").alias("account")).filter(F.col("account").isNotNull()).distinct()
        frontier = payees.join(reached, "account", "left_anti").checkpoint()
        if frontier.isEmpty():
            break
        reached = reached.unionByName(frontier)
    return out


def capacity_curve(scored: DataFrame, k_values: list[int]) -> DataFrame:
    """Precision, lift and cost at many k, from one evaluate."""
    t = evaluate(scored, k_values, patterns=False, cost=True, average_precision=False)
    return (t.filter(F.col("k").isNotNull()).groupBy("k").pivot(
        "metric", ["precision_at_k", "lift_at_k", "cost_investigator_hours", "cost_laundering_value_caught",
                   "cost_laundering_value_missed"]).agg(F.first("value")))


def psi(expected: DataFrame, actual: DataFrame, value: Column, bins: int = 10, eps: float = 1e-6) -> DataFrame:
    """Population stability index over fixed integer bins of ``value``
    (values floored, clamped to [0, bins]); one row per bin plus the total in
    column ``psi`` (same on every row)."""
    b = F.least(F.greatest(F.floor(value), F.lit(0)), F.lit(bins)).cast("int")
    e = expected.select(b.alias("bin")).groupBy("bin").agg(F.count(F.lit(1)).alias("n_expected"))
    a = actual.select(b.alias("bin")).groupBy("bin").agg(F.count(F.lit(1)).alias("n_actual"))
    j = e.join(a, "bin", "full_outer").na.fill(0, ["n_expected", "n_actual"])
    every = Window.partitionBy(F.lit(0))  # one row per bin: a tiny table
    pe = F.greatest(F.col("n_expected") / F.sum("n_expected").over(every), F.lit(eps))
    pa = F.greatest(F.col("n_actual") / F.sum("n_actual").over(every), F.lit(eps))
    j = j.select("bin", "n_expected", "n_actual", ((pa - pe) * F.log(pa / pe)).alias("contribution"))
    return j.withColumn("psi", F.sum("contribution").over(every))


def champion_challenger(champion: DataFrame, challenger: DataFrame, k: int = 100) -> DataFrame:
    """Both scored sets through evaluate; promote the challenger only on higher precision@k."""
    def one(name, scored):
        t = evaluate(scored, (k,), patterns=False, cost=False)
        return t.filter((F.col("metric") == "pr_auc") | (F.col("metric") == "precision_at_k")).groupBy().pivot(
            "metric", ["pr_auc", "precision_at_k"]).agg(F.first("value")).select(F.lit(name).alias("model"), "*")
    both = one("champion", champion).unionByName(one("challenger", challenger))
    every = Window.partitionBy(F.lit(0))  # two rows
    champ_p = F.max(F.when(F.col("model") == "champion", F.col("precision_at_k"))).over(every)
    return both.withColumn("promote", ((F.col("model") == "challenger") & (F.col("precision_at_k") > champ_p)).cast("int"))


def alert_forecast(alerts: DataFrame, trailing_days: int = 7) -> DataFrame:
    """Alerts on every calendar day from the first to the last (days without alerts count 0),
    with the mean of the previous ``trailing_days`` days and of earlier same-weekday days.
    The table has one row per day, so its windows stay small."""
    d = alerts.groupBy(F.to_date("timestamp").alias("day")).agg(F.count(F.lit(1)).alias("alerts"))
    every_day = d.agg(F.min("day").alias("a"), F.max("day").alias("b")).where("a IS NOT NULL").select(
        F.explode(F.sequence("a", "b")).alias("day"))
    d = every_day.join(d, "day", "left").na.fill(0, ["alerts"])
    d = d.withColumn("weekday", (F.weekday("day") + 1).cast("int"))
    trail = Window.orderBy("day").rowsBetween(-trailing_days, -1)
    same = Window.partitionBy("weekday").orderBy("day").rowsBetween(Window.unboundedPreceding, -1)
    return d.select("day", "weekday", "alerts", F.avg("alerts").over(trail).alias("trailing_mean"),
                    F.avg("alerts").over(same).alias("same_weekday_mean"))


def staleness(transfers: DataFrame, as_of: dt.datetime) -> DataFrame:
    """Seconds since each account's last activity (either side) before ``as_of``."""
    past = transfers.filter(F.col("timestamp") < ntz_lit(as_of))
    roles = past.select(F.explode(F.array("from_account", "to_account")).alias("account"), "timestamp")
    last = roles.groupBy("account").agg(F.max("timestamp").alias("last_seen"))
    return last.withColumn("age_seconds", seconds_between(F.col("last_seen"), ntz_lit(as_of)))


def leak_audit(transfers: DataFrame, as_of: dt.datetime) -> DataFrame:
    """The future-invariance audit. Features are computed on the full record
    twice: as is, and with every row at or after ``as_of`` perturbed (amounts x10,
    accounts renamed, labels flipped). What belongs to rows or days before
    ``as_of`` must come out identical: the history features (E1-E9), the per-day
    node features and neighbour means of both hops (J4, J5), the scoring rows built
    from them (J6), and the scaler fitted on the window (D9). The result lists, per
    feature, how many values changed, keeping only non-zero counts: empty means no leak.
    History and graph features are computed once per record and checkpointed; all views read that.
    """
    from ringwatch.operators.graph import NODE_FEATURES, edge_inputs, two_hop_mean_by_day
    from ringwatch.operators.scaler import EdgeScaler

    ensure_checkpoint_dir(transfers.sparkSession)
    cut = ntz_lit(as_of)
    later = F.col("timestamp") >= cut
    midnight = as_of.replace(hour=0, minute=0, second=0, microsecond=0)

    def perturb(c: str) -> Column:
        if c in ("amount_paid", "amount_received"):
            return F.when(later, F.round(F.col(c) * 10, 6)).otherwise(F.col(c)).alias(c)
        if c in ("from_account", "to_account"):
            return F.when(later, F.concat(F.lit("X"), F.col(c))).otherwise(F.col(c)).alias(c)
        if c == "is_laundering":
            return F.when(later, 1 - F.col(c)).otherwise(F.col(c)).alias(c)
        return F.col(c)

    perturbed = transfers.select(*[perturb(c) for c in transfers.columns])
    history = list(HISTORY_FEATURES)
    graph = [f"{p}{c}" for p in ("", "h1_", "h2_") for c in NODE_FEATURES]
    # Every day before the cut's own day is complete in both records; its own day starts equal, too.
    day = F.col("day") <= F.lit(midnight.date())

    def views(t: DataFrame) -> list[tuple[str, DataFrame, str, list[str]]]:
        past = build_account_history_features(t, None).filter(F.col("timestamp") < cut).checkpoint()
        by_day = two_hop_mean_by_day(t).filter(day).checkpoint()
        rows = edge_inputs(past.withColumn("log_amount", F.log1p("amount_paid")), by_day, ["log_amount"], graph)
        keyed = by_day.withColumn("key", F.concat_ws("|", "account", F.col("day").cast("string")))
        # Accounts that only later rows bring to the cut's own day are new in one record, not changed.
        return [("", past, "txn_id", history), ("by_day_", keyed, "key", graph),
                ("inputs_", rows, "txn_id", [c for c in rows.columns if c not in ("txn_id", "is_laundering")]),
                ("scaler_", EdgeScaler.moments_frame(past, history), "feature", ["mean", "std"])]

    out = None
    active = None
    for (name, a, key, cols), (_, b, _, _) in zip(views(transfers), views(perturbed)):
        if name == "by_day_":
            active = transfers.filter(~later).select(F.explode(F.array("from_account", "to_account")).alias("account"),
                                                     F.to_date("timestamp").alias("day")).distinct().withColumn(
                "key", F.concat_ws("|", "account", F.col("day").cast("string"))).select("key")
            a, b = a.join(active, "key", "left_semi"), b.join(active, "key", "left_semi")
        found = parity(a, b, key, cols, 1e-9).withColumn("feature", F.concat(F.lit(name), "feature"))
        out = found if out is None else out.unionByName(found)
    return out.filter(F.col("differing") > 0)
