"""Time-series and window operators.

Lags and rolling means are *row* offsets inside an entity, ordered by time with
an explicit tie-breaker.  All features of one entity share one window spec so
Catalyst plans a single Exchange (hash by entity) + Sort + Window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import calendar as cal
from . import ordering


def _order(ts: str, tiebreak: str | None):
    return [F.col(ts)] + ([F.col(tiebreak)] if tiebreak else [])


def entity_id(df: DataFrame, parts=("city", "address"), out: str = "gym_id",
              fmt: str = "gym_%03d", sep: str = "|") -> DataFrame:
    """1-based dense id of the sorted natural key ``a|b``.

    The rank is the place of each *distinct* key (one row per entity) in a total order and
    joined back, so no window ever spans the fact rows or all keys.
    """
    key = F.concat_ws(sep, *[F.col(p) for p in parts])
    keys = ordering.total_order(df.select(key.alias("_entity_key")).distinct(), ["_entity_key"], "_rank")
    ranked = keys.select("_entity_key", F.format_string(fmt, "_rank").alias(out))
    return df.withColumn("_entity_key", key).join(ranked, "_entity_key").drop("_entity_key")


def lag_columns(value: str, w, lags=(1, 4, 96)) -> dict[str, Column]:
    # Lags are DOUBLE: they feed models, and NULL-able integers round-trip badly through pandas.
    return {f"lag_{n}": F.lag(F.col(value), n).over(w).cast("double") for n in lags}


def rolling_columns(value: str, w, windows=(4, 16, 96)) -> dict[str, Column]:
    """Mean of the previous ``n`` rows, current row excluded, partial windows allowed."""
    return {f"rolling_mean_{n}": F.avg(F.col(value)).over(w.rowsBetween(-n, -1)) for n in windows}


def over_chunks(df: DataFrame, columns, halo: int, key="gym_id", ts="ts", tiebreak: str | None = None,
                chunk_rows: int = 50_000, keep_position: bool = False) -> DataFrame:
    """Window columns over an entity's last ``halo`` rows without a window over the whole entity.

    Rows are numbered, cut into chunks of ``chunk_rows``, and each row that ends a
    chunk is also put into the next one, so every chunk starts with its
    predecessor's last ``halo`` rows; ``columns(w)`` gives the expressions over
    the chunk's window.  ``keep_position`` keeps ``row_pos`` and ``entity_rows``.
    """
    if chunk_rows < halo:
        raise ValueError("chunk_rows must be at least the longest lag / rolling window")
    idx = chunked_row_index(df, key, ts, tiebreak, out="row_pos", total="entity_rows")
    own = F.floor(F.col("row_pos") / chunk_rows)
    ends = (F.col("row_pos") % chunk_rows) >= chunk_rows - halo
    put = idx.withColumn("_own", own).withColumn(
        "_c", F.explode(F.when(ends, F.array("_own", F.col("_own") + 1)).otherwise(F.array("_own"))))
    w = Window.partitionBy(key, "_c").orderBy("row_pos")
    out = put.withColumns(columns(w)).filter(F.col("_c") == F.col("_own")).drop("_c", "_own")
    return out if keep_position else out.drop("row_pos", "entity_rows")


def lag_features(df: DataFrame, key="gym_id", ts="ts", value="active_people", lags=(1, 4, 96),
                 tiebreak: str | None = None, chunk_rows: int = 50_000) -> DataFrame:
    return over_chunks(df, lambda w: lag_columns(value, w, lags), max(lags), key, ts, tiebreak, chunk_rows)


def rolling_features(df: DataFrame, key="gym_id", ts="ts", value="active_people",
                     windows=(4, 16, 96), tiebreak: str | None = None, chunk_rows: int = 50_000) -> DataFrame:
    return over_chunks(df, lambda w: rolling_columns(value, w, windows), max(windows), key, ts, tiebreak, chunk_rows)


def feature_table(df: DataFrame, holidays: cal.HolidayCalendar, key="gym_id", ts="ts",
                  value="active_people", lags=(1, 4, 96), windows=(4, 16, 96),
                  tiebreak: str | None = None) -> DataFrame:
    """Calendar + opening + holiday + lag + rolling features in one window pass."""
    return feature_table_chunked(df, holidays, key, ts, value, lags, windows, tiebreak, chunk_rows=50_000)


def seq_lags(df: DataFrame, key="gym_id", ts="ts", value="active_people", n: int = 12,
             tiebreak: str | None = None) -> DataFrame:
    """``n`` most recent previous values as columns; the first ``n`` rows per entity are dropped."""
    out = over_chunks(df, lambda w: {f"seq_lag_{i}": F.lag(F.col(value), i).over(w) for i in range(1, n + 1)},
                      n, key, ts, tiebreak)
    return out.filter(F.col(f"seq_lag_{n}").isNotNull())


def seq_windows(df: DataFrame, key="gym_id", ts="ts", fields=("active_people",), n: int = 12,
                tiebreak: str | None = None, out: str = "window") -> DataFrame:
    """Array of the previous ``n`` token structs; rows with a short history are dropped."""
    token = F.struct(*[F.col(f) for f in fields])
    return over_chunks(df, lambda w: {out: F.collect_list(token).over(w.rowsBetween(-n, -1))}, n, key, ts,
                       tiebreak).filter(F.size(out) == n)


def split_flags(df: DataFrame, key="gym_id", ts="ts", ratio: float = 0.8,
                tiebreak: str | None = None, out: str = "is_train") -> DataFrame:
    """Chronological per-entity split: the first ``max(1, floor(n*ratio))`` rows train."""
    idx = chunked_row_index(df, key, ts, tiebreak, total="_n")
    cut = F.greatest(F.lit(1), F.floor(F.col("_n") * F.lit(ratio)))
    return idx.withColumn(out, (F.col("_i") < cut).cast("int")).drop("_i", "_n")


def split3(df: DataFrame, key="gym_id", ts="ts", first: float = 0.7, second: float = 0.8,
           tiebreak: str | None = None, out: str = "split") -> DataFrame:
    """70/10/20 per entity; the validation end is at least one row after the train end."""
    idx = chunked_row_index(df, key, ts, tiebreak, total="_n")
    n, rn = F.col("_n"), F.col("_i") + 1
    a = F.greatest(F.lit(1), F.floor(n * F.lit(first)))
    b = F.greatest(a + 1, F.floor(n * F.lit(second)))
    return idx.withColumn(out, F.when(rn <= a, "train").when(rn <= b, "validation").otherwise("test")).drop("_i", "_n")


def infer_interval(df: DataFrame, key="gym_id", ts="ts", floor_minutes: int = 5,
                   default: int = 20) -> DataFrame:
    """Median gap in minutes over all series, rounded, floored at 5; 20 without gaps."""
    micros = F.unix_micros(F.col(ts).cast("timestamp"))
    gaps = over_chunks(df.select(key, ts), lambda w: {
        "gap": (micros - F.unix_micros(F.lag(F.col(ts)).over(w).cast("timestamp"))) / 6e7}, 1, key, ts)
    med = exact_quantiles(gaps, "gap", [], 0.5)
    one = df.sparkSession.range(1).drop("id")
    return one.join(med, how="left").select(F.greatest(
        F.lit(floor_minutes), F.coalesce(F.round("quantile").cast("int"), F.lit(default))).alias("interval_minutes"))


def exact_quantiles(df: DataFrame, value: str, keys: list[str], q: float, pieces: int = 256) -> DataFrame:
    """Exact quantile (linear interpolation) per key as ``quantile``, nulls left out.

    Values are counted, cut into ``pieces`` ranges at approximate quantiles, and
    only the ranges that hold the wanted ranks are put in order.  No task keeps
    all values of a key.
    """
    v = df.filter(F.col(value).isNotNull()).select(*keys, F.col(value).cast("double").alias("_v"))
    v = v.groupBy(*keys, "_v").agg(F.count(F.lit(1)).alias("_n"))
    cuts = v.groupBy(*keys).agg(F.percentile_approx("_v", [i / pieces for i in range(1, pieces)], 10 * pieces).alias("_cuts"),
                                F.sum("_n").alias("_total"))
    v = v.join(cuts, keys) if keys else v.crossJoin(F.broadcast(cuts))  # one row
    v = v.withColumn("_b", F.size(F.filter("_cuts", lambda c: c < F.col("_v")))).drop("_cuts")
    w = Window.partitionBy(*keys).orderBy("_b")
    sizes = v.groupBy(*keys, "_b").agg(F.sum("_n").alias("_bn"), F.first("_total").alias("_total"))
    sizes = sizes.withColumn("_to", F.sum("_bn").over(w))
    rank = (F.col("_total") - 1) * q
    low, high = F.floor(rank), F.ceil(rank)
    from_ = F.col("_to") - F.col("_bn")
    wanted = sizes.filter(((from_ <= low) & (low < F.col("_to"))) | ((from_ <= high) & (high < F.col("_to"))))
    some = v.drop("_total").join(wanted.select(*keys, "_b", from_.alias("_from"), "_total"), [*keys, "_b"])
    to = F.col("_from") + F.sum("_n").over(Window.partitionBy(*keys, "_b").orderBy("_v"))
    some = some.withColumn("_to", to)

    def at(r):
        return F.min(F.when(r < F.col("_to"), F.col("_v")))

    found = some.groupBy(*keys).agg(at(low).alias("_a"), at(high).alias("_z"), F.first((F.col("_total") - 1) * q).alias("_r"))
    return found.select(*keys, (F.col("_a") + (F.col("_z") - F.col("_a")) * (F.col("_r") - F.floor("_r"))).alias("quantile"))


def spine(entities: DataFrame, start: Column, end: Column, interval_minutes, ts: str = "ts") -> DataFrame:
    """Left-inclusive timestamp grid ``[start, end)`` per entity row."""
    step = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(interval_minutes) if isinstance(interval_minutes, int)
                              else interval_minutes)
    return (entities.withColumn(ts, F.explode(F.sequence(start, end, step)))
                    .filter(F.col(ts) < end))


def latest_per_entity(df: DataFrame, key="gym_id", ts="ts", seq: str | None = None,
                      cols=None) -> DataFrame:
    """Last row per entity (``max_by``); ties on time go to the first-seen row."""
    cols = cols or [c for c in df.columns if c != key]
    order = F.struct(F.col(ts), -F.col(seq)) if seq else F.col(ts)
    return df.groupBy(key).agg(*[F.max_by(F.col(c), order).alias(c) for c in cols])


def current_streak(days: DataFrame, key="user_id", day="day", out="streak") -> DataFrame:
    """Consecutive-day run ending at each key's latest day (gaps and islands)."""
    d = days.select(key, day).distinct()
    w = Window.partitionBy(key).orderBy(day)
    isl = d.withColumn("_island", F.date_sub(F.col(day), F.row_number().over(w).cast("int")))
    last = isl.groupBy(key).agg(F.max_by("_island", day).alias("_island"))
    return isl.join(last, [key, "_island"]).groupBy(key).agg(F.count(F.lit(1)).alias(out))


def running_cross(df: DataFrame, key, ts, value, threshold, out="crossed_at",
                  tiebreak: str | None = None) -> DataFrame:
    """First time per key at which the running sum of ``value`` reaches ``threshold``."""
    w = Window.partitionBy(key).orderBy(*_order(ts, tiebreak)).rowsBetween(Window.unboundedPreceding, 0)
    return (df.withColumn("_run", F.sum(value).over(w))
              .groupBy(key).agg(F.min(F.when(F.col("_run") >= threshold, F.col(ts))).alias(out)))


def nth_event(df: DataFrame, key, ts, n: int, out="nth_at", tiebreak: str | None = None) -> DataFrame:
    w = Window.partitionBy(key).orderBy(*_order(ts, tiebreak))
    return (df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == n)
              .select(key, F.col(ts).alias(out)))


def distinct_cross(df: DataFrame, key, ts, item, threshold: int, out="crossed_at") -> DataFrame:
    """First time the number of distinct items seen so far (ties on time included) reaches ``threshold``.

    Each item contributes once at its first time; a RANGE frame sums those
    first-occurrence marks so equal timestamps are counted together.
    """
    firsts = df.groupBy(key, item).agg(F.min(ts).alias(ts))
    per_ts = firsts.groupBy(key, ts).agg(F.count(F.lit(1)).alias("_new"))
    w = Window.partitionBy(key).orderBy(ts).rangeBetween(Window.unboundedPreceding, 0)
    return (per_ts.withColumn("_seen", F.sum("_new").over(w))
                  .groupBy(key).agg(F.min(F.when(F.col("_seen") >= threshold, F.col(ts))).alias(out)))


def running_max(df: DataFrame, key, order, value, out="running_max") -> DataFrame:
    w = Window.partitionBy(key).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(out, F.max(value).over(w))


def row_budget(df: DataFrame, key, ts, n: int, tiebreak: str | None = None) -> DataFrame:
    """First ``n`` rows per entity (WindowGroupLimit keeps only n rows per key before the window)."""
    w = Window.partitionBy(key).orderBy(*_order(ts, tiebreak))
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).drop("_rn")


def chunked_row_index(df: DataFrame, key="gym_id", ts="ts", tiebreak: str | None = "seq",
                      bucket: Column | None = None, out: str = "_i", total: str | None = None) -> DataFrame:
    """0-based row position inside each entity without a window over the whole entity.

    Rows are counted per (entity, time bucket) -- by default the minute -- a running
    sum over that table gives each bucket's offset, and a window *inside* each
    (entity, bucket) adds the local position.  A hot entity is therefore spread
    over as many tasks as it has minutes.
    """
    b = bucket if bucket is not None else F.date_trunc("minute", F.col(ts))
    d = df.withColumn("_bk", b)
    counts = d.groupBy(key, "_bk").agg(F.count(F.lit(1)).alias("_bn"))
    offs = counts.withColumn("_off", F.coalesce(F.sum("_bn").over(
        Window.partitionBy(key).orderBy("_bk").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("_bn")
    if total:  # entity sizes from the same small count table (no second pass over the rows)
        offs = offs.join(counts.groupBy(key).agg(F.sum("_bn").alias(total)), key)
    w = Window.partitionBy(key, "_bk").orderBy(*_order(ts, tiebreak))
    return d.join(offs, [key, "_bk"]).withColumn(out, F.col("_off") + F.row_number().over(w) - 1).drop("_bk", "_off")


def feature_table_chunked(df: DataFrame, holidays: cal.HolidayCalendar, key="gym_id", ts="ts",
                          value="active_people", lags=(1, 4, 96), windows=(4, 16, 96), tiebreak: str | None = "seq",
                          chunk_rows: int = 1_000_000, keep_position: bool = False) -> DataFrame:
    """Same output as :func:`feature_table`, with the window split into fixed-size row chunks.

    Each chunk of ``chunk_rows`` consecutive rows of an entity is one window
    partition; the last ``max(lags, windows)`` rows of every chunk are copied
    into the next chunk as a halo, so lags and rolling means stay exact while
    a single huge series is processed by many tasks.
    """
    def columns(w):
        return {**cal.calendar_columns(ts), "is_open_estimated": cal.business_open(ts), **cal.holiday_columns(ts, holidays),
                **lag_columns(value, w, lags), **rolling_columns(value, w, windows)}

    return over_chunks(df, columns, max(max(lags), max(windows)), key, ts, tiebreak, chunk_rows, keep_position)


def nth_event_chunked(df: DataFrame, key, ts, n: int, out="nth_at", tiebreak: str | None = None) -> DataFrame:
    """Time of the n-th event per key, using per-(key, day) positions instead of a per-key window."""
    idx = chunked_row_index(df, key, ts, tiebreak)
    return idx.filter(F.col("_i") == n - 1).select(key, F.col(ts).alias(out))


def running_cross_chunked(df: DataFrame, key, ts, value, threshold, out="crossed_at",
                          tiebreak: str | None = None) -> DataFrame:
    """First time the running sum of ``value`` reaches ``threshold``: day totals give each
    day's starting sum (a running sum over the small per-day table), a window inside each
    (key, day) adds the running part."""
    d = df.withColumn("_d", F.to_date(F.col(ts)))
    day = d.groupBy(key, "_d").agg(F.sum(value).alias("_ds"))
    start = day.withColumn("_start", F.coalesce(F.sum("_ds").over(
        Window.partitionBy(key).orderBy("_d").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("_ds")
    w = Window.partitionBy(key, "_d").orderBy(*_order(ts, tiebreak)).rowsBetween(Window.unboundedPreceding, 0)
    run = d.join(start, [key, "_d"]).withColumn("_run", F.col("_start") + F.sum(value).over(w))
    return run.groupBy(key).agg(F.min(F.when(F.col("_run") >= threshold, F.col(ts))).alias(out))
