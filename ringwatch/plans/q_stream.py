"""Registered query: streaming history (N1), which must equal the batch E1-E9."""

from __future__ import annotations

import datetime as dt
import uuid

from ringwatch.operators.history import HISTORY_FEATURES, cut_as_of
from ringwatch.plans.catalog import register
from ringwatch.plans.common import AS_OF, T, round_doubles
from ringwatch.plans.q_features import _HISTORY_SQL
from ringwatch.session import shared_dir
from ringwatch.streaming.history_stream import assemble_features, run_stream

RESTART = dt.datetime(2024, 1, 11, 12, 34)


@register("q_stream_history", _HISTORY_SQL)
def q_stream_history(spark, sf_dir):
    """T arrives in two deliveries; the stream catches up after each, the second time from its
    checkpoint and state, and its decisions equal ``q_account_history``."""
    root = shared_dir(spark, f"stream-{uuid.uuid4().hex}")
    t = cut_as_of(T(spark, sf_dir, end=AS_OF), AS_OF)
    source, out, checkpoint = f"{root}/source", f"{root}/out", f"{root}/checkpoint"
    cut_as_of(t, RESTART).write.parquet(f"{source}/delivery=1")
    run_stream(spark, source, t.schema, out, checkpoint)
    T(spark, sf_dir, start=RESTART, end=AS_OF).write.parquet(f"{source}/delivery=2")
    run_stream(spark, source, t.schema, out, checkpoint)
    return round_doubles(assemble_features(spark, out).select("txn_id", *HISTORY_FEATURES))
