"""Aggregations.

Every aggregate is a declarative ``groupBy``/``agg`` so Spark plans a partial
(map-side) aggregate before the shuffle; the shuffled volume is one row per
group and task, regardless of how skewed a key is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import ordering


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def metric_columns(actual, pred) -> list[Column]:
    """rows, MAE, RMSE, WAPE (0 when the actual total is 0); NULL predictions excluded."""
    a, p = _c(actual), _c(pred)
    valid = p.isNotNull()
    err = F.when(valid, a - p)
    abs_total = F.sum(F.when(valid, F.abs(a)))
    return [
        F.count(err).alias("rows"),
        F.coalesce(F.avg(F.abs(err)), F.lit(0.0)).alias("mae"),
        F.coalesce(F.sqrt(F.avg(err * err)), F.lit(0.0)).alias("rmse"),
        F.when(F.coalesce(abs_total, F.lit(0.0)) == 0, F.lit(0.0))
         .otherwise(F.sum(F.abs(err)) / abs_total).alias("wape"),
    ]


def metrics(df: DataFrame, actual="active_people", pred="prediction", by=(), clip: bool = False) -> DataFrame:
    """MAE/RMSE/WAPE; ``clip`` first clips predictions at 0 (model experiments do, baselines do not)."""
    p = F.greatest(_c(pred), F.lit(0.0)) if clip else _c(pred)
    return df.groupBy(*by).agg(*metric_columns(actual, p))


def metrics_multi(df: DataFrame, pred_cols: dict[str, str], actual="active_people", clip=False,
                  model_col="model") -> DataFrame:
    """Metrics for many prediction columns in one scan: unpivot, then group by model."""
    long = df.unpivot([actual], list(pred_cols.values()), "_pred_col", "prediction")
    names = F.create_map(*[x for k, v in pred_cols.items() for x in (F.lit(v), F.lit(k))])
    long = long.withColumn(model_col, names[F.col("_pred_col")])
    return metrics(long, actual, "prediction", by=[model_col], clip=clip)


def error_slices(df: DataFrame, actual="active_people", pred="prediction") -> DataFrame:
    """Error by hour, by weekday and by gym from one scan (GROUPING SETS -> one Expand + aggregate)."""
    err = F.col(actual) - F.col(pred)
    base = df.select("hour", "day_of_week", "gym_id", "city", "address", actual, pred,
                     F.abs(err).alias("_ae"), (err * err).alias("_se"))
    g = base.groupingSets([["hour"], ["day_of_week"], ["gym_id", "city", "address"]],
                          "hour", "day_of_week", "gym_id", "city", "address").agg(
        F.grouping_id().alias("_gid"),
        F.count(F.lit(1)).alias("rows"), F.avg("_ae").alias("mae"), F.sqrt(F.avg("_se")).alias("rmse"),
        F.avg(actual).alias("avg_actual"), F.avg(pred).alias("avg_prediction"))
    dim = (F.when(F.col("hour").isNotNull() & F.col("day_of_week").isNull() & F.col("gym_id").isNull(), "hour")
            .when(F.col("day_of_week").isNotNull(), "day_of_week").otherwise("gym"))
    key = F.coalesce(F.col("hour").cast("string"), F.col("day_of_week").cast("string"), F.col("gym_id"))
    return g.select(dim.alias("slice"), key.alias("slice_key"), "city", "address", "rows", "mae", "rmse",
                    "avg_actual", "avg_prediction")


def profile(df: DataFrame, keys, value="active_people", prefix="profile") -> DataFrame:
    """Mean and sample std per key; a single-row group has std 0."""
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias(f"{prefix}_rows"),
        F.avg(value).alias(f"{prefix}_mean"),
        F.coalesce(F.stddev_samp(value), F.lit(0.0)).alias(f"{prefix}_std"))


def residuals(df: DataFrame, keys, value="active_people", out="residual") -> DataFrame:
    mean = df.groupBy(*keys).agg(F.avg(value).alias("_mean"))
    matched = df.join(mean.select(*[F.col(k).alias(f"_k_{k}") for k in keys], "_mean"),
                      [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys])
    return matched.withColumn(out, F.col(value) - F.col("_mean")).drop("_mean", *[f"_k_{k}" for k in keys])


def quantile_levels(df: DataFrame, value: str, levels: list[list[str]], q: float = 0.8) -> list[DataFrame]:
    """Exact (linearly interpolated) quantile of ``value`` per level of keys, all levels in the same two passes."""
    out = f"p{int(q * 100)}"
    types = {f.name: f.dataType for f in df.schema.fields}
    names = sorted({k for keys in levels for k in keys})
    each = [F.struct(F.lit(i).alias("level"), *[(F.col(k) if k in keys else F.lit(None).cast(types[k])).alias(k) for k in names])
            for i, keys in enumerate(levels)]
    rows = df.select(F.explode(F.array(*each)).alias("key"), F.col(value).alias("value"))
    found = ordering.keyed_quantiles(rows, q).select("key.*", F.col("quantile").alias(out))
    return [found.where(F.col("level") == i).select(*keys, out) for i, keys in enumerate(levels)]


def dataset_summary(df: DataFrame, key="gym_id", ts="ts", value="active_people") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("rows"), F.countDistinct(key).alias("gyms"),
                  F.min(ts).alias("min_timestamp"), F.max(ts).alias("max_timestamp"),
                  F.min(value).alias("min_active_people"), F.max(value).alias("max_active_people"),
                  F.avg(value).alias("avg_active_people"))


def entity_sizes(df: DataFrame, key="gym_id", top: int = 1) -> DataFrame:
    """Largest series by rows (ties -> smallest key); a top-k without a global sort."""
    return (df.groupBy(key).agg(F.count(F.lit(1)).alias("rows"))
              .orderBy(F.col("rows").desc(), F.col(key)).limit(top))
