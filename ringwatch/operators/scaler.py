"""Standard scaler fitted on training rows only.

Preparation: null / NaN -> 0, then log1p where positive. Moments are the mean
and the *sample* standard deviation; a null (one row) or tiny (<= 1e-9) std
becomes 1.0. Fitting is one aggregate for all columns; the moments come back
as a small dict and are applied as literals (no join).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MIN_STD = 1e-9


def prepare(c: str) -> Column:
    x = F.col(c).cast("double")
    x = F.when(x.isNull() | F.isnan(x), F.lit(0.0)).otherwise(x)
    return F.when(x > 0, F.log1p(x)).otherwise(x)


@dataclass(frozen=True)
class EdgeScaler:
    mean: dict[str, float]
    std: dict[str, float]

    @classmethod
    def moments_frame(cls, train: DataFrame, columns: list[str]) -> DataFrame:
        """One row per column: (feature, mean, std) — the fitted state as a DataFrame."""
        aggs = []
        for i, c in enumerate(columns):
            aggs += [F.avg(prepare(c)).alias(f"m{i}"), F.stddev_samp(prepare(c)).alias(f"s{i}")]
        one = train.agg(*aggs)
        std = lambda i: F.when(F.col(f"s{i}").isNull() | (F.col(f"s{i}") <= MIN_STD), F.lit(1.0)).otherwise(F.col(f"s{i}"))
        rows = F.array(*[F.struct(F.lit(c).alias("feature"), F.coalesce(F.col(f"m{i}"), F.lit(0.0)).alias("mean"),
                                  std(i).alias("std")) for i, c in enumerate(columns)])
        return one.select(F.explode(rows).alias("r")).select("r.*")

    @classmethod
    def fit(cls, train: DataFrame, columns: list[str]) -> "EdgeScaler":
        rows = cls.moments_frame(train, columns).collect()  # one row per column
        return cls({r["feature"]: float(r["mean"]) for r in rows}, {r["feature"]: float(r["std"]) for r in rows})

    def transform(self, df: DataFrame, columns: list[str]) -> DataFrame:
        scaled = {c: ((prepare(c) - F.lit(self.mean[c])) / F.lit(self.std[c])).alias(c) for c in columns}
        return df.select(*[scaled.get(c, F.col(c)) for c in df.columns])
