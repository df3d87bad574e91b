"""Data contracts enforced at runtime.

The schema part is checked on the driver from ``df.schema`` (no job). The
value rules are counted in **one** aggregate. ``mode="raise"`` fails on any
violation; ``mode="quarantine"`` splits good and bad rows without a job.

NaN gets its own rule: in Spark ``NaN >= 0`` is true, so a range check alone
would let NaN through.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T


class ContractError(ValueError):
    pass


@dataclass(frozen=True)
class Contract:
    name: str
    types: dict[str, tuple[type, ...] | None]        # column -> allowed Spark types (None: any)
    # rule name -> builder of the "row violates" predicate (built lazily, so
    # contracts can be defined before a SparkContext exists)
    rules: dict[str, Callable[[], Column]] = field(default_factory=dict)


_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_NUMERIC = _INTEGRAL + (T.FloatType, T.DoubleType, T.DecimalType)
_TS = (T.TimestampNTZType, T.TimestampType)


def _isnull(c: str) -> Column:
    return F.col(c).isNull()


def _nan(c: str) -> Column:
    return F.isnan(F.col(c))


def _raw_contract() -> Contract:
    strings = ("from_bank", "from_account", "to_bank", "to_account",
               "receiving_currency", "payment_currency", "payment_format")
    types = {"timestamp": _TS, **{c: (T.StringType,) for c in strings},
             "amount_received": (T.DoubleType,), "amount_paid": (T.DoubleType,), "is_laundering": _INTEGRAL}
    rules = {f"{c}_null": (lambda c=c: _isnull(c)) for c in types}
    for c in ("amount_received", "amount_paid"):
        rules[f"{c}_negative"] = lambda c=c: F.col(c) < 0
        rules[f"{c}_nan"] = lambda c=c: _nan(c)
    rules["is_laundering_not_binary"] = lambda: ~F.col("is_laundering").isin(0, 1)
    return Contract("raw_transactions", types, rules)


def _feature_contract() -> Contract:
    types: dict = {}
    rules: dict = {}

    def col(name, allowed, nullable=False, lo=None, hi=None, binary=False, nan_check=False):
        types[name] = allowed
        if not nullable:
            rules[f"{name}_null"] = lambda: _isnull(name)
        if lo is not None:
            rules[f"{name}_below_{lo}"] = lambda: F.col(name) < lo
        if hi is not None:
            rules[f"{name}_above_{hi}"] = lambda: F.col(name) > hi
        if binary:
            rules[f"{name}_not_binary"] = lambda: ~F.col(name).isin(0, 1)
        if nan_check:
            rules[f"{name}_nan"] = lambda: _nan(name)

    col("hour", _INTEGRAL, lo=0, hi=23)
    col("weekday", _INTEGRAL, lo=1, hi=7)
    col("log_amount", (T.DoubleType,), lo=0, nan_check=True)
    col("amount_ratio", (T.DoubleType,), lo=0, nan_check=True)
    for f in ("is_cross_currency", "is_self_transfer", "is_same_bank"):
        col(f, _INTEGRAL, binary=True)
    for f in ("sender_n_sent_before", "sender_distinct_out_before", "sender_sent_last_24h",
              "receiver_n_received_before", "receiver_distinct_in_before"):
        col(f, _NUMERIC, lo=0)
    for f in ("sender_amount_sent_before", "receiver_amount_received_before"):
        col(f, (T.DoubleType,), nullable=True, lo=0, nan_check=True)
    col("in_out_ratio_before", (T.DoubleType,), lo=0, nan_check=True)
    col("is_laundering", _INTEGRAL, binary=True)
    return Contract("features", types, rules)


RAW_TRANSACTIONS = _raw_contract()
FEATURES = _feature_contract()


def check_schema(df: DataFrame, contract: Contract) -> None:
    """Missing or wrongly typed columns raise; extra columns are allowed."""
    fields = {f.name: f.dataType for f in df.schema.fields}
    problems = []
    for name, allowed in contract.types.items():
        if name not in fields:
            problems.append(f"missing column {name}")
        elif allowed is not None and not isinstance(fields[name], allowed):
            problems.append(f"{name}: {fields[name].simpleString()} not allowed")
    if problems:
        raise ContractError(f"{contract.name}: " + "; ".join(problems))


def violation_counts(df: DataFrame, contract: Contract) -> DataFrame:
    """Tidy ``(rule, violations)``: one aggregate over the data, then an unpivot of one row."""
    check_schema(df, contract)
    names = list(contract.rules)
    aggs = [F.sum(F.when(contract.rules[r](), 1).otherwise(0)).cast("bigint").alias(r) for r in names]
    wide = df.agg(*aggs)
    return wide.unpivot([], names, "rule", "violations")


def _any_violation(contract: Contract) -> Column:
    cond = F.lit(False)
    for pred in contract.rules.values():
        cond = cond | F.coalesce(pred(), F.lit(False))
    return cond


def validate(df: DataFrame, contract: Contract, mode: str = "raise"):
    """Enforce ``contract``. ``raise`` returns ``df`` or raises; ``quarantine`` returns (good, bad)."""
    check_schema(df, contract)
    if mode == "raise":
        bad = [(r["rule"], r["violations"]) for r in violation_counts(df, contract).collect() if r["violations"]]
        if bad:
            raise ContractError(f"{contract.name}: " + ", ".join(f"{k}={v}" for k, v in bad))
        return df
    if mode == "quarantine":
        flag = _any_violation(contract)
        return df.filter(~flag), df.filter(flag)
    raise ValueError(f"unknown mode {mode}")


@dataclass(frozen=True)
class Checked:
    """What :func:`write_checked` stored: the rows that keep the contract, the others, and per rule its violations."""

    good: DataFrame
    quarantined: DataFrame
    violations: dict[str, int]


def write_checked(df: DataFrame, contract: Contract, path: str) -> Checked:
    """Count violations, quarantine and write in one job with one scan of ``df``.

    The table at ``path`` (which must not exist) gets two partitions, ``quarantined=false`` and
    ``quarantined=true``; the counts are observed on the rows as they are written. The observation sits in the
    write's own stage, where a task that is run again reports once. Empty input gives an empty
    table and zero counts. A column named ``quarantined`` in ``df`` is an error.
    """
    check_schema(df, contract)
    if "quarantined" in (c.lower() for c in df.columns):
        raise ContractError(f"{contract.name}: column quarantined is taken")
    seen = Observation(f"contract-{contract.name}")
    names = list(contract.rules)
    counts = [F.sum(F.when(contract.rules[r](), 1).otherwise(0)).cast("bigint").alias(r) for r in names]
    (df.observe(seen, *counts).withColumn("quarantined", _any_violation(contract))
     .write.partitionBy("quarantined").mode("error").parquet(path))
    violations = {r: int(seen.get.get(r) or 0) for r in names}
    schema = T.StructType([*df.schema.fields, T.StructField("quarantined", T.BooleanType())])
    stored = df.sparkSession.read.schema(schema).parquet(path)
    return Checked(stored.filter(~F.col("quarantined")).drop("quarantined"),
                   stored.filter("quarantined").drop("quarantined"), violations)


def validate_raw_transactions(df: DataFrame, mode: str = "raise"):
    return validate(df, RAW_TRANSACTIONS, mode)


def validate_features(df: DataFrame, mode: str = "raise"):
    return validate(df, FEATURES, mode)
