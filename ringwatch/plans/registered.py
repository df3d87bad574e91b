"""Import every module that registers queries."""

from ringwatch.plans import q_features, q_graph, q_ingest, q_metrics, q_models, q_monitor, q_reports, q_scoring, q_stream  # noqa: F401
