"""Registered queries: snapshots, node features, neighbour means, sampling, as-of join."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ringwatch.functions.basic import amount_ratio, hour
from ringwatch.functions.hashing import duckdb_uniform_from_key
from ringwatch.operators.graph import (NODE_FEATURES, edge_index, edge_inputs, graph_off, neighbor_mean, neighbor_mean_by_day,
                                       node_features, node_features_by_day, snapshot_edges, snapshot_nodes,
                                       two_hop_mean, two_hop_mean_by_day)
from ringwatch.operators.graph_stats import node_list
from ringwatch.operators.joins import asof_join
from ringwatch.operators.sampling import fanout_sample, negative_subsample
from ringwatch.operators.split import select_split, truncate_tail
from ringwatch.plans.catalog import register
from ringwatch.plans.common import (
    AS_OF, SEED, SQL_AS_OF, SQL_TAIL_CUTOFF, T, TAIL_CUTOFF, frozen_split, round_doubles)
from ringwatch.plans.q_ingest import _BOUNDS_SQL
from ringwatch.sources.transfers import ntz_lit

NEXT_DAY = AS_OF + dt.timedelta(days=1)
SQL_NEXT_DAY = "TIMESTAMP '2024-01-22 00:00:00'"
CAPS = (15, 10)
MAX_ROWS_PER_DAY = 200  # small enough that every day of T is capped at sf0.01
_HASH = duckdb_uniform_from_key(SEED, "txn_id")
_FC = list(NODE_FEATURES)

_E_SQL = f"""e AS (SELECT txn_id, from_account AS src, to_account AS dst, ln(1 + amount_paid) AS log_amount,
                  timestamp FROM T WHERE timestamp < {SQL_AS_OF})"""
_NODES_SQL = f"""nodes AS (SELECT src AS account FROM e UNION SELECT dst FROM e
   UNION SELECT from_account FROM T WHERE timestamp >= {SQL_AS_OF} AND timestamp < {SQL_NEXT_DAY}
   UNION SELECT to_account FROM T WHERE timestamp >= {SQL_AS_OF} AND timestamp < {SQL_NEXT_DAY})"""
_NF_SQL = """ro AS (SELECT src AS account, count(*) AS n_out, sum(log_amount) AS v_out, count(DISTINCT dst) AS d_out
       FROM e GROUP BY 1),
ri AS (SELECT dst AS account, count(*) AS n_in, sum(log_amount) AS v_in, count(DISTINCT src) AS d_in FROM e GROUP BY 1),
nf AS (SELECT n.account, ln(1 + coalesce(n_out, 0)) AS f_out_degree, ln(1 + coalesce(n_in, 0)) AS f_in_degree,
         ln(1 + coalesce(v_out, 0)) AS f_value_out, ln(1 + coalesce(v_in, 0)) AS f_value_in,
         ln(1 + coalesce(d_out, 0)) AS f_distinct_out, ln(1 + coalesce(d_in, 0)) AS f_distinct_in
       FROM nodes n LEFT JOIN ro USING (account) LEFT JOIN ri USING (account))"""


def _edges(spark, sf_dir):
    return snapshot_edges(T(spark, sf_dir, end=AS_OF), AS_OF)


def _targets(spark, sf_dir):
    t = T(spark, sf_dir, AS_OF, NEXT_DAY)
    return t.filter((F.col("timestamp") >= ntz_lit(AS_OF)) &
                    (F.col("timestamp") < ntz_lit(NEXT_DAY)))


def _nodes(spark, sf_dir):
    tg = _targets(spark, sf_dir)
    extra = tg.select(F.col("from_account").alias("account")).unionByName(tg.select(F.col("to_account").alias("account")))
    return snapshot_nodes(_edges(spark, sf_dir), extra)


def _r(cols):
    return ", ".join(f"round({c}, 6) AS {c}" for c in cols)


@register("q_snapshot_edges", f"""WITH {_E_SQL}
SELECT txn_id, src, dst, round(log_amount, 6) AS log_amount, CAST(epoch(timestamp) AS BIGINT) AS unix_seconds FROM e""")
def q_snapshot_edges(spark, sf_dir):
    return round_doubles(_edges(spark, sf_dir).drop("timestamp"))


@register("q_snapshot_nodes", f"WITH {_E_SQL}, {_NODES_SQL}\nSELECT account FROM nodes")
def q_snapshot_nodes(spark, sf_dir):
    return _nodes(spark, sf_dir)


@register("q_nodes", f"""WITH {_E_SQL},
r AS (SELECT src AS account, 0 AS role, timestamp, txn_id FROM e UNION ALL SELECT dst, 1, timestamp, txn_id FROM e)
SELECT account, CAST(arg_min(role, (role, timestamp, txn_id)) AS INTEGER) AS first_role,
  arg_min(txn_id, (role, timestamp, txn_id)) AS first_txn_id FROM r GROUP BY account""")
def q_nodes(spark, sf_dir):
    e = _edges(spark, sf_dir).select("txn_id", "timestamp", F.col("src").alias("from_account"),
                                     F.col("dst").alias("to_account"))
    n = node_list(e)
    return n.select("account", F.col("first_seen.role").cast("int").alias("first_role"),
                    F.col("first_seen.txn_id").alias("first_txn_id"))


@register("q_node_features", f"WITH {_E_SQL}, {_NODES_SQL}, {_NF_SQL}\nSELECT account, {_r(_FC)} FROM nf")
def q_node_features(spark, sf_dir):
    return round_doubles(node_features(_edges(spark, sf_dir), _nodes(spark, sf_dir)))


_BY_DAY_SQL = """de AS (SELECT from_account AS src, to_account AS dst, ln(1 + amount_paid) AS la,
               CAST(timestamp AS DATE) AS day FROM T),
act AS (SELECT DISTINCT account, day FROM (SELECT src AS account, day FROM de UNION ALL SELECT dst, day FROM de)),
bo AS (SELECT a.account, a.day, count(d.src) AS n_out, coalesce(sum(d.la), 0) AS v_out, count(DISTINCT d.dst) AS d_out
       FROM act a LEFT JOIN de d ON d.src = a.account AND d.day < a.day GROUP BY 1, 2),
bi AS (SELECT a.account, a.day, count(d.dst) AS n_in, coalesce(sum(d.la), 0) AS v_in, count(DISTINCT d.src) AS d_in
       FROM act a LEFT JOIN de d ON d.dst = a.account AND d.day < a.day GROUP BY 1, 2),
byday AS (SELECT account, day, ln(1 + n_out) AS f_out_degree, ln(1 + n_in) AS f_in_degree, ln(1 + v_out) AS f_value_out,
            ln(1 + v_in) AS f_value_in, ln(1 + d_out) AS f_distinct_out, ln(1 + d_in) AS f_distinct_in
          FROM bo JOIN bi USING (account, day))"""


@register("q_node_features_by_day", f"""WITH {_BY_DAY_SQL}
SELECT account, strftime(day, '%Y-%m-%d') AS day, {_r(_FC)} FROM byday""")
def q_node_features_by_day(spark, sf_dir):
    d = node_features_by_day(T(spark, sf_dir))
    return round_doubles(d.withColumn("day", F.date_format("day", "yyyy-MM-dd")))


def _cap_sql(name: str, cap: int) -> str:
    return f"""{name} AS (SELECT src, dst FROM (
  SELECT src, dst, row_number() OVER (PARTITION BY dst ORDER BY {_HASH}, txn_id) AS rn FROM e) WHERE rn <= {cap})"""


_H1_SQL = f"""{_cap_sql('c1', CAPS[0])},
h1a AS (SELECT c.dst AS account, {', '.join(f'avg(nf.{c}) AS h1_{c}' for c in _FC)} FROM c1 c JOIN nf ON nf.account = c.src
        GROUP BY 1),
h1 AS (SELECT nf.*, {', '.join(f'coalesce(h1a.h1_{c}, 0.0) AS h1_{c}' for c in _FC)}
       FROM nf LEFT JOIN h1a USING (account))"""


@register("q_neighbor_mean_1hop", f"""WITH {_E_SQL}, {_NODES_SQL}, {_NF_SQL}, {_H1_SQL}
SELECT account, {_r(_FC)}, {_r('h1_' + c for c in _FC)} FROM h1""")
def q_neighbor_mean_1hop(spark, sf_dir):
    e = _edges(spark, sf_dir)
    nf = node_features(e, _nodes(spark, sf_dir))
    h1 = neighbor_mean(e, nf, _FC, CAPS[0], SEED, prefix="h1_")
    return round_doubles(nf.join(h1, "account"))


@register("q_neighbor_mean_2hop", f"""WITH {_E_SQL}, {_NODES_SQL}, {_NF_SQL}, {_H1_SQL}, {_cap_sql('c2', CAPS[1])},
h2a AS (SELECT c.dst AS account, {', '.join(f'avg(h1.h1_{c}) AS h2_{c}' for c in _FC)} FROM c2 c
        JOIN h1 ON h1.account = c.src GROUP BY 1)
SELECT h1.account, {', '.join(f'round(h1.{c}, 6) AS {c}' for c in _FC)},
  {', '.join(f'round(h1.h1_{c}, 6) AS h1_{c}' for c in _FC)},
  {', '.join(f'round(coalesce(h2a.h2_{c}, 0.0), 6) AS h2_{c}' for c in _FC)}
FROM h1 LEFT JOIN h2a USING (account)""")
def q_neighbor_mean_2hop(spark, sf_dir):
    e = _edges(spark, sf_dir)
    return round_doubles(two_hop_mean(e, node_features(e, _nodes(spark, sf_dir)), CAPS, SEED))


def _pairs_sql(cap: int, points: str, name: str) -> str:
    """``name(account, day, u)``: of the edges into the account dated before the day, the ``cap`` of smallest hash."""
    return f"""{name} AS (SELECT p.account, p.day, e.src AS u FROM {points} p
  JOIN de2 e ON e.dst = p.account AND e.day < p.day
  QUALIFY row_number() OVER (PARTITION BY p.account, p.day ORDER BY {_HASH.replace('txn_id', 'e.txn_id')}, e.txn_id) <= {cap})"""


def _by_day_h1_sql(cap: int, points: str, name: str) -> str:
    """CTEs ending in ``name(account, day, h1_*)``: one-hop mean state at the day start,
    for the (account, day) rows of ``points``, over the sample of the edges before that day."""
    return f"""{_pairs_sql(cap, points, f'{name}_pairs')},
{name}_pd AS (SELECT DISTINCT u, day FROM {name}_pairs),
{name}_so AS (SELECT p.u, p.day, count(d.src) AS n_out, coalesce(sum(d.la), 0) AS v_out, count(DISTINCT d.dst) AS d_out
       FROM {name}_pd p LEFT JOIN de d ON d.src = p.u AND d.day < p.day GROUP BY 1, 2),
{name}_si AS (SELECT p.u, p.day, count(d.dst) AS n_in, coalesce(sum(d.la), 0) AS v_in, count(DISTINCT d.src) AS d_in
       FROM {name}_pd p LEFT JOIN de d ON d.dst = p.u AND d.day < p.day GROUP BY 1, 2),
{name}_st AS (SELECT u, day, ln(1 + n_out) AS f_out_degree, ln(1 + n_in) AS f_in_degree, ln(1 + v_out) AS f_value_out,
         ln(1 + v_in) AS f_value_in, ln(1 + d_out) AS f_distinct_out, ln(1 + d_in) AS f_distinct_in
       FROM {name}_so JOIN {name}_si USING (u, day)),
{name}_agg AS (SELECT p.account, p.day, {', '.join(f'avg(st.{c}) AS h1_{c}' for c in _FC)}
       FROM {name}_pairs p JOIN {name}_st st ON st.u = p.u AND st.day = p.day GROUP BY 1, 2),
{name} AS (SELECT p.account, p.day, {', '.join(f'coalesce(a.h1_{c}, 0.0) AS h1_{c}' for c in _FC)}
       FROM {points} p LEFT JOIN {name}_agg a ON a.account = p.account AND a.day = p.day)"""


_DE2_SQL = "de2 AS (SELECT txn_id, from_account AS src, to_account AS dst, CAST(timestamp AS DATE) AS day FROM T)"


@register("q_neighbor_mean_by_day", f"""WITH {_BY_DAY_SQL}, {_DE2_SQL},
pts AS (SELECT account, day FROM byday),
{_by_day_h1_sql(CAPS[0], 'pts', 'h1')}
SELECT b.account, strftime(b.day, '%Y-%m-%d') AS day, {', '.join(f'round(b.{c}, 6) AS {c}' for c in _FC)},
  {', '.join(f'round(h1.h1_{c}, 6) AS h1_{c}' for c in _FC)}
FROM byday b JOIN h1 ON h1.account = b.account AND h1.day = b.day""")
def q_neighbor_mean_by_day(spark, sf_dir):
    d = neighbor_mean_by_day(T(spark, sf_dir), CAPS[0], SEED)
    return round_doubles(d.withColumn("day", F.date_format("day", "yyyy-MM-dd")))


@register("q_neighbor_mean_2hop_by_day", f"""WITH {_BY_DAY_SQL}, {_DE2_SQL},
{_pairs_sql(CAPS[1], 'byday', 'pairs2')},
pts AS (SELECT account, day FROM byday UNION SELECT u, day FROM pairs2),
{_by_day_h1_sql(CAPS[0], 'pts', 'h1')},
h2 AS (SELECT p.account, p.day, {', '.join(f'avg(h1.h1_{c}) AS h2_{c}' for c in _FC)}
       FROM pairs2 p JOIN h1 ON h1.account = p.u AND h1.day = p.day GROUP BY 1, 2)
SELECT b.account, strftime(b.day, '%Y-%m-%d') AS day, {', '.join(f'round(b.{c}, 6) AS {c}' for c in _FC)},
  {', '.join(f'round(h1.h1_{c}, 6) AS h1_{c}' for c in _FC)},
  {', '.join(f'round(coalesce(h2.h2_{c}, 0.0), 6) AS h2_{c}' for c in _FC)}
FROM byday b JOIN h1 ON h1.account = b.account AND h1.day = b.day LEFT JOIN h2 ON h2.account = b.account AND h2.day = b.day""")
def q_neighbor_mean_2hop_by_day(spark, sf_dir):
    d = two_hop_mean_by_day(T(spark, sf_dir), CAPS, SEED)
    return round_doubles(d.withColumn("day", F.date_format("day", "yyyy-MM-dd")))


_EDGE_COLS = ["log_amount", "hour", "is_same_bank", "amount_ratio"]


@register("q_edge_inputs", f"""WITH {_BY_DAY_SQL},
tg AS (SELECT *, CAST(timestamp AS DATE) AS day FROM T WHERE timestamp >= {SQL_AS_OF} AND timestamp < {SQL_NEXT_DAY})
SELECT tg.txn_id, {', '.join(f'round(coalesce(p.{c}, 0.0), 6) AS src_{c}' for c in _FC)},
  {', '.join(f'round(coalesce(q.{c}, 0.0), 6) AS dst_{c}' for c in _FC)},
  round(ln(1 + tg.amount_paid), 6) AS log_amount, CAST(hour(tg.timestamp) AS INTEGER) AS hour,
  CAST(tg.from_bank = tg.to_bank AS INTEGER) AS is_same_bank,
  round(CASE WHEN tg.amount_paid > 0 THEN tg.amount_received / tg.amount_paid ELSE 1.0 END, 6) AS amount_ratio,
  tg.is_laundering
FROM tg LEFT JOIN byday p ON p.account = tg.from_account AND p.day = tg.day
        LEFT JOIN byday q ON q.account = tg.to_account AND q.day = tg.day""")
def q_edge_inputs(spark, sf_dir):
    return round_doubles(_day_inputs(spark, sf_dir))


def _day_inputs(spark, sf_dir):
    """J6 for the transfers of one day: node state from that day's past, of the scored accounts only."""
    tg = _targets(spark, sf_dir).select(
        "txn_id", "timestamp", "from_account", "to_account", "is_laundering",
        F.log1p("amount_paid").alias("log_amount"), hour().alias("hour"),
        (F.col("from_bank") == F.col("to_bank")).cast("int").alias("is_same_bank"),
        amount_ratio().alias("amount_ratio"))
    scored = tg.select(F.explode(F.array("from_account", "to_account")).alias("account"))
    return edge_inputs(tg, node_features_by_day(T(spark, sf_dir, end=NEXT_DAY), scored), _EDGE_COLS)


@register("q_graph_off", f"""
SELECT txn_id, {', '.join(f'0.0 AS {s}_{c}' for s in ('src', 'dst') for c in _FC)},
  round(ln(1 + amount_paid), 6) AS log_amount, CAST(hour(timestamp) AS INTEGER) AS hour,
  CAST(from_bank = to_bank AS INTEGER) AS is_same_bank,
  round(CASE WHEN amount_paid > 0 THEN amount_received / amount_paid ELSE 1.0 END, 6) AS amount_ratio, is_laundering
FROM T WHERE timestamp >= {SQL_AS_OF} AND timestamp < {SQL_NEXT_DAY}""")
def q_graph_off(spark, sf_dir):
    """The same rows with the node part zeroed."""
    return round_doubles(graph_off(_day_inputs(spark, sf_dir)))


@register("q_edge_index", f"""WITH {_E_SQL},
r AS (SELECT src AS account, 0 AS role, timestamp, txn_id FROM e UNION ALL SELECT dst, 1, timestamp, txn_id FROM e),
f AS (SELECT account, min((role, timestamp, txn_id)) AS k FROM r GROUP BY account),
ids AS (SELECT account, CAST(row_number() OVER (ORDER BY k) - 1 AS BIGINT) AS node_id FROM f)
SELECT e.txn_id, s.node_id AS src_id, d.node_id AS dst_id FROM e JOIN ids s ON s.account = e.src
  JOIN ids d ON d.account = e.dst""")
def q_edge_index(spark, sf_dir):
    return edge_index(_edges(spark, sf_dir))


@register("q_fanout_sample", f"""WITH {_E_SQL}, {_cap_sql('c', CAPS[0]).replace('SELECT src, dst FROM', 'SELECT * FROM')}
SELECT txn_id, src, dst FROM c""".replace("SELECT src, dst, row_number()", "SELECT txn_id, src, dst, row_number()"))
def q_fanout_sample(spark, sf_dir):
    return fanout_sample(_edges(spark, sf_dir).select("txn_id", "src", "dst"), CAPS[0], "dst", SEED)


@register("q_neg_subsample", _BOUNDS_SQL + f""",
tr AS (SELECT t.*, CAST(t.timestamp AS DATE) AS day, {_HASH.replace('txn_id', 't.txn_id')} AS h
       FROM T t, b WHERE t.timestamp < {SQL_TAIL_CUTOFF} AND t.timestamp < b.train_end),
pd AS (SELECT day, count(*) AS nr, sum(is_laundering) AS np FROM tr GROUP BY day),
neg AS (SELECT txn_id, day, row_number() OVER (PARTITION BY day ORDER BY h, txn_id) AS rk FROM tr WHERE is_laundering = 0)
SELECT tr.txn_id, tr.is_laundering FROM tr JOIN pd USING (day) LEFT JOIN neg USING (txn_id)
WHERE tr.is_laundering = 1 OR nr <= {MAX_ROWS_PER_DAY} OR neg.rk <= greatest({MAX_ROWS_PER_DAY} - np, 0)""")
def q_neg_subsample(spark, sf_dir):
    t = truncate_tail(T(spark, sf_dir, end=TAIL_CUTOFF), TAIL_CUTOFF)
    train = select_split(t, "train", frozen_split(spark, sf_dir))
    return negative_subsample(train, MAX_ROWS_PER_DAY, SEED).select("txn_id", "is_laundering")


@register("q_asof_join", """
WITH r AS (SELECT to_account AS acct, timestamp AS rts, arg_max(amount_paid, txn_id) AS ramt, max(txn_id) AS rid
           FROM T GROUP BY 1, 2)
SELECT l.txn_id, r.ramt AS last_in_amount, r.rid AS last_in_txn_id,
  strftime(r.rts, '%Y-%m-%dT%H:%M:%S') AS last_in_time
FROM T l ASOF LEFT JOIN r ON l.from_account = r.acct AND l.timestamp >= r.rts""")
def q_asof_join(spark, sf_dir):
    t = T(spark, sf_dir)
    right = (t.groupBy(F.col("to_account").alias("from_account"), F.col("timestamp").alias("rts"))
             .agg(F.max_by("amount_paid", "txn_id").alias("last_in_amount"), F.max("txn_id").alias("last_in_txn_id")))
    # Hour buckets: the skew-safe form (one hot payer is spread over its hours).
    j = asof_join(t.select("txn_id", "from_account", "timestamp"), right, ["from_account"], "timestamp", "rts",
                  ["last_in_amount", "last_in_txn_id", "rts"], bucket_seconds=3600)
    return j.select("txn_id", "last_in_amount", "last_in_txn_id",
                    F.date_format("rts", "yyyy-MM-dd'T'HH:mm:ss").alias("last_in_time"))
