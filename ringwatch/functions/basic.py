"""Row-level features. One projection, no shuffle, no history."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BASIC_FEATURES = ("hour", "weekday", "log_amount", "amount_ratio",
                  "is_cross_currency", "is_self_transfer", "is_same_bank")


def hour(ts: str = "timestamp") -> Column:
    return F.hour(ts).cast("int")


def iso_weekday(ts: str = "timestamp") -> Column:
    """ISO day of week, Monday = 1 ... Sunday = 7."""
    return (F.weekday(ts) + 1).cast("int")


def log_amount(amount: str = "amount_paid") -> Column:
    return F.log1p(F.col(amount))


def amount_ratio(received: str = "amount_received", paid: str = "amount_paid") -> Column:
    # The guard is required: ANSI division by zero raises.
    return F.when(F.col(paid) > 0, F.col(received) / F.col(paid)).otherwise(F.lit(1.0))


def flag(cond: Column) -> Column:
    return cond.cast("int")


def basic_feature_columns() -> list[Column]:
    return [
        hour().alias("hour"),
        iso_weekday().alias("weekday"),
        log_amount().alias("log_amount"),
        amount_ratio().alias("amount_ratio"),
        flag(F.col("receiving_currency") != F.col("payment_currency")).alias("is_cross_currency"),
        flag(F.col("from_account") == F.col("to_account")).alias("is_self_transfer"),
        flag(F.col("from_bank") == F.col("to_bank")).alias("is_same_bank"),
    ]


def build_basic_features(df: DataFrame) -> DataFrame:
    """Append B1-B7, keeping every input column."""
    return df.select("*", *basic_feature_columns())
