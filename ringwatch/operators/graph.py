"""Snapshot graphs and node features as DataFrames.

A snapshot is ``edges.filter(ts < as_of)``; nodes are accounts. Per-day
features for *every* day come from daily per-account totals and prefix sums
over days (cost linear in edges, no per-day loop). Same-day edges never feed
a day's features.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ringwatch.functions.hashing import uniform_from_key
from ringwatch.operators.prefix import prefix_sum
from ringwatch.operators.sampling import fanout_sample
from ringwatch.sources.transfers import epoch_seconds, ntz_lit

NODE_FEATURES = ("f_out_degree", "f_in_degree", "f_value_out", "f_value_in", "f_distinct_out", "f_distinct_in")
_UNB = Window.unboundedPreceding


def snapshot_edges(transfers: DataFrame, as_of: dt.datetime) -> DataFrame:
    """Edges strictly before ``as_of``: src, dst, log amount, unix seconds."""
    past = transfers.filter(F.col("timestamp") < ntz_lit(as_of))
    return past.select("txn_id", F.col("from_account").alias("src"), F.col("to_account").alias("dst"),
                       F.log1p("amount_paid").alias("log_amount"), epoch_seconds("timestamp").alias("unix_seconds"),
                       "timestamp")


def snapshot_nodes(edges: DataFrame, extra_accounts: DataFrame | None = None) -> DataFrame:
    """Every account of the snapshot plus cold ``extra_accounts``, once each."""
    nodes = (edges.select(F.col("src").alias("account"))
             .unionByName(edges.select(F.col("dst").alias("account"))))
    if extra_accounts is not None:
        nodes = nodes.unionByName(extra_accounts.select("account"))
    return nodes.distinct()


def _raw_node_sums(edges: DataFrame, keys: list[str]) -> DataFrame:
    """Out/in counts and log-amount sums, distinct partners, per ``keys`` (account [, day])."""
    roles = F.array(
        F.struct(F.col("src").alias("account"), F.lit(0).alias("role"), F.col("dst").alias("partner")),
        F.struct(F.col("dst").alias("account"), F.lit(1).alias("role"), F.col("src").alias("partner")))
    extra = [k for k in keys if k != "account"]
    r = edges.select(*extra, "log_amount", F.explode(roles).alias("_r")).select(*extra, "log_amount", "_r.*")
    return r, extra


def node_features(edges: DataFrame, nodes: DataFrame | None = None) -> DataFrame:
    """log1p of out-degree, in-degree, sum log-amount out/in, distinct payees/payers.

    Cold nodes (in ``nodes`` but without edges) get zeros.
    """
    r, _ = _raw_node_sums(edges, ["account"])
    pairs = r.select("account", "role", "partner").distinct()
    dist = pairs.groupBy("account").agg(
        F.sum(F.when(F.col("role") == 0, 1).otherwise(0)).alias("d_out"),
        F.sum(F.when(F.col("role") == 1, 1).otherwise(0)).alias("d_in"))
    sums = r.groupBy("account").agg(
        F.sum(F.when(F.col("role") == 0, 1).otherwise(0)).alias("n_out"),
        F.sum(F.when(F.col("role") == 1, 1).otherwise(0)).alias("n_in"),
        F.sum(F.when(F.col("role") == 0, F.col("log_amount")).otherwise(0.0)).alias("v_out"),
        F.sum(F.when(F.col("role") == 1, F.col("log_amount")).otherwise(0.0)).alias("v_in"))
    feats = sums.join(dist, "account")
    if nodes is not None:
        feats = nodes.select("account").join(feats, "account", "left")
    z = lambda c: F.log1p(F.coalesce(F.col(c).cast("double"), F.lit(0.0)))
    return feats.select("account", z("n_out").alias("f_out_degree"), z("n_in").alias("f_in_degree"),
                        z("v_out").alias("f_value_out"), z("v_in").alias("f_value_in"),
                        z("d_out").alias("f_distinct_out"), z("d_in").alias("f_distinct_in"))


_RAW = ["n_out", "n_in", "v_out", "v_in", "d_out", "d_in"]


def _z(c: str) -> Column:
    return F.log1p(F.coalesce(F.col(c), F.lit(0)).cast("double"))


def daily_state(e: DataFrame, accounts: DataFrame | None = None) -> DataFrame:
    """Raw node totals per account on each of its active days: before the day
    (``before_*``) and including it (``after_*``); of ``accounts`` only, if given.

    Daily per-account totals (map-side combined) plus one row per
    (account, partner) pair on its first day give "new partners per day";
    prefix sums over days give both views. The per-account window runs over
    days, so even a hot account has at most one row per day in it.
    """
    r, _ = _raw_node_sums(e, ["account", "day"])
    if accounts is not None:
        r = r.join(accounts.select("account").distinct(), "account", "left_semi")
    daily = r.groupBy("account", "day").agg(
        F.sum(F.when(F.col("role") == 0, 1).otherwise(0)).alias("n_out"),
        F.sum(F.when(F.col("role") == 1, 1).otherwise(0)).alias("n_in"),
        F.sum(F.when(F.col("role") == 0, F.col("log_amount")).otherwise(0.0)).alias("v_out"),
        F.sum(F.when(F.col("role") == 1, F.col("log_amount")).otherwise(0.0)).alias("v_in"))
    first = r.groupBy("account", "role", "partner").agg(F.min("day").alias("day"))
    new = first.groupBy("account", "day").agg(
        F.sum(F.when(F.col("role") == 0, 1).otherwise(0)).alias("d_out"),
        F.sum(F.when(F.col("role") == 1, 1).otherwise(0)).alias("d_in"))
    t = daily.join(new, ["account", "day"], "left").na.fill(0, ["d_out", "d_in"])
    days = Window.partitionBy("account").orderBy("day")
    return t.select("account", "day",
                    *[F.sum(c).over(days.rowsBetween(_UNB, -1)).alias(f"before_{c}") for c in _RAW],
                    *[F.sum(c).over(days.rowsBetween(_UNB, 0)).alias(f"after_{c}") for c in _RAW])


def _own_state(state: DataFrame) -> DataFrame:
    return state.select("account", "day", *[_z(f"before_{c}").alias(f) for c, f in zip(_RAW, NODE_FEATURES)])


def _later_state(state: DataFrame) -> DataFrame:
    """Totals valid from the day after each active day on."""
    return state.select(F.col("account").alias("u"), F.date_add("day", 1).alias("_from"),
                        *[F.col(f"after_{c}").alias(c) for c in _RAW])


def node_features_by_day(transfers: DataFrame, accounts: DataFrame | None = None) -> DataFrame:
    """Node features at the start of every day an account is active (of ``accounts`` only, if given)."""
    return _own_state(daily_state(_edges_by_day(transfers), accounts))


def neighbor_mean(edges: DataFrame, feats: DataFrame, cols: list[str], cap: int, seed: int = 42,
                  prefix: str = "nbr_") -> DataFrame:
    """J5 (one hop): mean of in-neighbours' ``cols`` (payer -> payee, multi-edges
    counted each), after capping each node to ``cap`` in-edges (F6). Nodes
    without in-edges get zeros. Output: ``account`` + ``prefix<col>``."""
    capped = fanout_sample(edges.select("txn_id", "src", "dst"), cap, node="dst", seed=seed)
    msg = capped.join(feats.select(F.col("account").alias("src"), *cols), "src")
    agg = msg.groupBy(F.col("dst").alias("account")).agg(*[F.avg(c).alias(f"{prefix}{c}") for c in cols])
    out = feats.select("account").join(agg, "account", "left")
    return out.select("account", *[F.coalesce(F.col(f"{prefix}{c}"), F.lit(0.0)).alias(f"{prefix}{c}") for c in cols])


def two_hop_mean(edges: DataFrame, feats: DataFrame, caps=(15, 10), seed: int = 42) -> DataFrame:
    """J5 (two hops): own features, the mean over in-neighbours (``h1_*``) and the mean
    over in-neighbours of their own one-hop means (``h2_*``)."""
    cols = list(NODE_FEATURES)
    h1 = neighbor_mean(edges, feats, cols, caps[0], seed, prefix="h1_")
    h1cols = [f"h1_{c}" for c in cols]
    h2 = neighbor_mean(edges, h1, h1cols, caps[1], seed, prefix="h2_")
    return feats.join(h1, "account").join(h2, "account").select(
        "account", *cols, *h1cols, *[F.col(f"h2_h1_{c}").alias(f"h2_{c}") for c in cols])


def edge_inputs(targets: DataFrame, by_day: DataFrame, edge_cols: list[str],
                vector_cols: list[str] | None = None) -> DataFrame:
    """Payer vector (as of the transfer's day start) + payee vector + transfer features.

    ``vector_cols`` defaults to the six node features; a per-day table with
    neighbour means (``two_hop_mean_by_day``) gives the graph model its
    neighbourhood part as well.
    """
    vcols = list(vector_cols or NODE_FEATURES)
    t = targets.withColumn("day", F.to_date("timestamp"))
    pay = by_day.select(F.col("account").alias("from_account"), "day", *[F.col(c).alias(f"src_{c}") for c in vcols])
    rec = by_day.select(F.col("account").alias("to_account"), "day", *[F.col(c).alias(f"dst_{c}") for c in vcols])
    j = t.join(pay, ["from_account", "day"], "left").join(rec, ["to_account", "day"], "left")
    vec = [F.coalesce(F.col(f"{s}_{c}"), F.lit(0.0)).alias(f"{s}_{c}") for s in ("src", "dst") for c in vcols]
    return j.select("txn_id", *vec, *edge_cols, "is_laundering")


def graph_off(inputs: DataFrame) -> DataFrame:
    """The ablation: node parts (``src_*`` / ``dst_*``) zeroed, transfer features kept."""
    return inputs.select(*[F.lit(0.0).alias(c) if c.startswith(("src_", "dst_")) else F.col(c)
                           for c in inputs.columns])


def node_index(edges: DataFrame) -> DataFrame:
    """C4: dense integer id per account in first-appearance order (payers first,
    then payees), numbered with a distributed prefix count, not a global window."""
    roles = edges.select(F.array(F.struct(F.col("src").alias("account"), F.lit(0).alias("role"), "timestamp", "txn_id"),
                                 F.struct(F.col("dst").alias("account"), F.lit(1).alias("role"), "timestamp", "txn_id"))
                         .alias("a")).select(F.explode("a").alias("r")).select("r.*")
    first = roles.groupBy("account").agg(F.min(F.struct("role", "timestamp", "txn_id")).alias("k"))
    first = first.select("account", F.col("k.role").alias("_r"), F.col("k.timestamp").alias("_t"),
                         F.col("k.txn_id").alias("_i"), F.lit(1).alias("_one"))
    ids = prefix_sum(first, ["_r", "_t", "_i"], ["_one"], ["_cum"])
    return ids.select("account", (F.col("_cum") - 1).cast("bigint").alias("node_id"))


def edge_index(edges: DataFrame) -> DataFrame:
    """C4: (txn_id, src_id, dst_id)."""
    ids = node_index(edges)
    return (edges.join(ids.select(F.col("account").alias("src"), F.col("node_id").alias("src_id")), "src")
            .join(ids.select(F.col("account").alias("dst"), F.col("node_id").alias("dst_id")), "dst")
            .select("txn_id", "src_id", "dst_id"))


def _edges_by_day(transfers: DataFrame) -> DataFrame:
    return transfers.select("txn_id", F.col("from_account").alias("src"), F.col("to_account").alias("dst"),
                            F.log1p("amount_paid").alias("log_amount"), F.to_date("timestamp").alias("day"))


def in_samples(e: DataFrame, cap: int, seed: int) -> DataFrame:
    """Per payee, the F6 sample of its in-edges as it stands after each of its receiving days:
    ``(account, _from, sample)`` with the ``cap`` edges of smallest (hash, txn_id) dated before ``_from``.

    An edge is in day d's sample if it is dated before d and fewer than ``cap`` of the payee's edges
    dated before d have a smaller hash, so an edge outside its own day's ``cap`` smallest never is:
    a group limit per (payee, day) comes first, and the running smallest are carried over the days.
    A payee's array holds at most ``cap`` edges per day of the time span.
    """
    day_top = fanout_sample(e.withColumn("_payee_day", F.struct("dst", "day")), cap, node="_payee_day", seed=seed)
    edge = F.struct(uniform_from_key(seed, "txn_id").alias("h"), "txn_id", F.col("src").alias("u"))
    per_day = day_top.groupBy("dst", "day").agg(F.collect_list(edge).alias("top"))
    days = per_day.groupBy("dst").agg(F.sort_array(F.collect_list(F.struct("day", "top"))).alias("days"))
    kind = "array<struct<h:double,txn_id:bigint,u:string>>"

    def carry(acc, x):
        now = F.slice(F.array_sort(F.concat(acc["now"], x["top"].cast(kind))), 1, cap)
        return F.struct(now.alias("now"),
                        F.concat(acc["seen"], F.array(F.struct(x["day"].alias("day"), now.alias("sample")))).alias("seen"))

    start = F.struct(F.array().cast(kind).alias("now"), F.array().cast(f"array<struct<day:date,sample:{kind}>>").alias("seen"))
    run = days.select(F.col("dst").alias("account"), F.explode(F.aggregate("days", start, carry, lambda a: a["seen"])).alias("s"))
    return run.select("account", F.date_add("s.day", 1).alias("_from"), F.col("s.sample.u").alias("sample"))


def _sampled_pairs(points: DataFrame, samples: DataFrame) -> DataFrame:
    """(account, day, u): the payers in the account's sample at the start of the day, multi-edges counted each.
    Both tables have at most one row per account and day, so the unsplit as-of join is bounded by the time span."""
    from ringwatch.operators.joins import asof_join

    found = asof_join(points, samples, ["account"], "day", "_from", ["sample"], bucket_seconds=None)
    return found.select("account", "day", F.explode("sample").alias("u"))


def _mean_state_at(points: DataFrame, samples: DataFrame, after: DataFrame, prefix: str) -> DataFrame:
    """For (account, day) points: mean over the sampled in-edges before the day of the
    payer's state at the start of that day; points without such edges get zeros."""
    from ringwatch.operators.joins import asof_join

    pairs = _sampled_pairs(points, samples)
    wanted = pairs.select("u", "day").distinct()
    st = asof_join(wanted, after, ["u"], "day", "_from", _RAW, bucket_seconds=None)  # one row per payer and day
    st = st.select("u", "day", *[_z(c).alias(f) for c, f in zip(_RAW, NODE_FEATURES)])
    agg = pairs.join(st, ["u", "day"]).groupBy("account", "day").agg(
        *[F.avg(f).alias(f"{prefix}{f}") for f in NODE_FEATURES])
    return points.join(agg, ["account", "day"], "left").select(
        "account", "day", *[F.coalesce(F.col(f"{prefix}{f}"), F.lit(0.0)).alias(f"{prefix}{f}")
                            for f in NODE_FEATURES])


def neighbor_mean_by_day(transfers: DataFrame, cap: int = 15, seed: int = 42) -> DataFrame:
    """J5 for every day at once (one hop): for each account active on day d,
    its own state at the start of d (J4) and the mean state, at the start of
    d, of its in-neighbours through the F6 sample (``cap`` per payee) of the
    edges dated before d. Nothing dated d or later enters.

    Bounded work: a scored (account, d) has at most ``cap`` sampled edges;
    neighbour states come from an as-of lookup over *distinct* (neighbour,
    day) pairs, so even a hub neighbour contributes at most one row per day.
    """
    e = _edges_by_day(transfers)
    state = daily_state(e)
    own = _own_state(state)
    h1 = _mean_state_at(own.select("account", "day"), in_samples(e, cap, seed), _later_state(state), "h1_")
    return own.join(h1, ["account", "day"]).select("account", "day", *NODE_FEATURES,
                                                   *[f"h1_{f}" for f in NODE_FEATURES])


def two_hop_mean_by_day(transfers: DataFrame, caps=(15, 10), seed: int = 42) -> DataFrame:
    """J5 for every day at once (two hops): own state, one-hop mean (``h1_*``, over at most
    ``caps[0]`` sampled edges before d) and the mean (``h2_*``), over at most ``caps[1]``
    sampled in-edges before d, of each payer's one-hop mean at d. At most
    caps[0] x caps[1] rows of work per scored account and day."""
    e = _edges_by_day(transfers)
    state = daily_state(e)
    own = _own_state(state)
    targets = own.select("account", "day")
    # One sample for both hops: arrays are in hash order, so a smaller cap's sample is the head of a larger one's.
    widest = in_samples(e, max(caps), seed)
    first, second = (widest.withColumn("sample", F.slice("sample", 1, c)) for c in caps)
    pairs2 = _sampled_pairs(targets, second)
    points = targets.unionByName(pairs2.select(F.col("u").alias("account"), "day")).distinct()
    h1 = _mean_state_at(points, first, _later_state(state), "h1_")
    at_payer = h1.withColumnRenamed("account", "u")
    h2 = pairs2.join(at_payer, ["u", "day"]).groupBy("account", "day").agg(
        *[F.avg(f"h1_{f}").alias(f"h2_{f}") for f in NODE_FEATURES])
    out = own.join(h1, ["account", "day"]).join(h2, ["account", "day"], "left")
    return out.select("account", "day", *NODE_FEATURES, *[f"h1_{f}" for f in NODE_FEATURES],
                      *[F.coalesce(F.col(f"h2_{f}"), F.lit(0.0)).alias(f"h2_{f}") for f in NODE_FEATURES])
