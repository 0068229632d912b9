"""Value anomalies in keyed series."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataward.functions.ordered import Ordered, ordered, unordered
from strataward.functions.quantiles import ranked_quantiles
from strataward.functions.size import AUTO, KEY, SkewPolicy

FLAGS = ("iqr_anomaly", "zscore_anomaly", "volatility_anomaly", "price_gap_anomaly")
ALL = FLAGS + ("volume_confirmed",)


@dataclass(frozen=True)
class AnomalyConfig:
    iqr_multiplier: float = 1.5
    zscore_threshold: float = 3.0
    volatility_window: int = 20
    volatility_threshold: float = 2.0
    gap_multiplier: float = 2.0
    volume_window: int = 5


DEFAULTS = AnomalyConfig()


def _series(df, value, order_by, keys, volume, config, policy, parts) -> Ordered:
    missing = [c for c in (value, volume, *order_by, *keys) if c is not None and c not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}")
    halo = 0
    if "price_gap_anomaly" in parts:
        halo = 1
    if "volume_confirmed" in parts:
        halo = max(halo, config.volume_window - 1)
    if "volatility_anomaly" in parts:
        halo = max(halo, config.volatility_window)
    fill = [value] if "volatility_anomaly" in parts else []
    return ordered(df, keys, order_by, fill=fill, halo=max(halo, 1), policy=policy)


def _annotate(df, value, order_by, keys, volume, config, policy, parts) -> DataFrame:
    keys, order_by = list(keys), [order_by] if isinstance(order_by, str) else list(order_by)
    columns = df.columns
    x = F.col(value)
    if set(parts) & {"volatility_anomaly", "price_gap_anomaly", "volume_confirmed"}:
        o = _series(df, value, order_by, keys, volume, config, policy, parts)
    else:
        o = unordered(df, keys, policy)
    d, w = o.df, o.window
    if "price_gap_anomaly" in parts:
        d = d.withColumn("_delta", F.abs(x - F.lag(x).over(w)))
    if "volatility_anomaly" in parts:
        held = o.filled(value)
        d = d.withColumn("_ret", F.try_divide(held, F.lag(held).over(w)) - 1)
        n = config.volatility_window
        recent = w.rowsBetween(-(n - 1), 0)
        d = d.withColumn(
            "_roll", F.when(F.count("_ret").over(recent) == n, F.stddev_samp("_ret").over(recent))
        )
    if "volume_confirmed" in parts:
        n, v = config.volume_window, F.col(volume)
        recent = w.rowsBetween(-(n - 1), 0)
        d = d.withColumn("_vmean", F.when(F.count(v).over(recent) == n, F.avg(v).over(recent)))

    def derived(on):
        aggs = {}
        if "price_gap_anomaly" in parts:
            aggs |= {"_delta_mean": F.avg(on(F.col("_delta"))), "_delta_std": F.stddev_samp(on(F.col("_delta")))}
        if "volatility_anomaly" in parts:
            aggs |= {"_ret_std": F.stddev_samp(on(F.col("_ret")))}
        if "zscore_anomaly" in parts:
            aggs |= {"_mean": F.avg(on(x)), "_std": F.stddev_samp(on(x))}
        return aggs

    if set(parts) - {"iqr_anomaly", "volume_confirmed"}:
        d = o.with_key_stats(d, derived)
    if "iqr_anomaly" in parts:
        d = _with_quartiles(d, o, df, value)

    out = _static_columns(value, config, parts)
    if "volatility_anomaly" in parts:
        cut = F.col("_ret_std") * (1 + config.volatility_threshold)
        out["volatility_anomaly"] = F.coalesce((F.col("_roll") > cut) & (F.col("_roll") > 0), F.lit(False))
    if "price_gap_anomaly" in parts:
        cut = F.col("_delta_mean") + config.gap_multiplier * F.col("_delta_std")
        out["price_gap_anomaly"] = F.col("_delta") > cut
    if "volume_confirmed" in parts:
        out["volume_confirmed"] = F.col(volume) > F.col("_vmean")
    d = d.withColumns(out)
    return o.finish(d).select(*columns, *[p for p in ALL if p in parts])


def _static_columns(value, config, parts) -> dict:
    x, out = F.col(value), {}
    if "iqr_anomaly" in parts:
        reach = config.iqr_multiplier * (F.col("_q3") - F.col("_q1"))
        out["iqr_anomaly"] = F.coalesce((x < F.col("_q1") - reach) | (x > F.col("_q3") + reach), F.lit(False))
    if "zscore_anomaly" in parts:
        z = F.try_divide(x - F.col("_mean"), F.col("_std"))
        out["zscore_anomaly"] = F.abs(z) > config.zscore_threshold
    return out


def _with_quartiles(d, o: Ordered, source, value) -> DataFrame:
    """Quartiles per key: an aggregate of whole groups, ranked counts for split ones."""
    both = F.array(F.lit(0.25), F.lit(0.75))
    d = o.with_cold_stats(d, lambda on: {"_q": F.percentile(on(F.col(value).cast("double")), both)})
    d = d.withColumns({"_q1": F.col("_q")[0], "_q3": F.col("_q")[1]})
    if o.hot is None:
        return d
    rows = o.hot_rows(source).select(F.col(KEY).alias("_hk"), value)
    table = ranked_quantiles(rows, ["_hk"], value, [0.25, 0.75], ["_q1", "_q3"], o.hot)
    return o.with_hot_table(d, table.withColumnRenamed("_hk", KEY))


def iqr_anomaly(df, value, keys=(), config=DEFAULTS, policy: SkewPolicy = AUTO) -> DataFrame:
    """Outside the quartiles by more than a multiple of their distance; null is false."""
    return _annotate(df, value, (), keys, None, config, policy, ("iqr_anomaly",))


def zscore_anomaly(df, value, keys=(), config=DEFAULTS, policy: SkewPolicy = AUTO) -> DataFrame:
    """Distance from the mean in sample deviations above the threshold; null stays null."""
    return _annotate(df, value, (), keys, None, config, policy, ("zscore_anomaly",))


def volatility_anomaly(df, value, order_by, keys=(), config=DEFAULTS, policy: SkewPolicy = AUTO) -> DataFrame:
    """Rolling deviation of returns above the overall one by the threshold."""
    return _annotate(df, value, order_by, keys, None, config, policy, ("volatility_anomaly",))


def price_gap_anomaly(df, value, order_by, keys=(), config=DEFAULTS, policy: SkewPolicy = AUTO) -> DataFrame:
    """Step from the previous row far above the usual step."""
    return _annotate(df, value, order_by, keys, None, config, policy, ("price_gap_anomaly",))


def volume_confirmed(df, volume, order_by, keys=(), config=DEFAULTS, policy: SkewPolicy = AUTO) -> DataFrame:
    """Volume above its own short rolling mean."""
    return _annotate(df, volume, order_by, keys, volume, config, policy, ("volume_confirmed",))


def combined_flag():
    """OR of the four flags with three-valued logic."""
    out = F.col(FLAGS[0])
    for name in FLAGS[1:]:
        out = out | F.col(name)
    return out


def score_flags():
    """Share of the four flags that are true."""
    total = F.lit(0)
    for name in FLAGS:
        total = total + F.coalesce(F.col(name), F.lit(False)).cast("int")
    return total / F.lit(4.0)


def detect_anomalies(
    df: DataFrame,
    value: str,
    order_by: Sequence[str] | str,
    keys: Sequence[str] = (),
    volume: str | None = None,
    config: AnomalyConfig = DEFAULTS,
    policy: SkewPolicy = AUTO,
) -> DataFrame:
    """Append every flag, their OR and a score to the input rows.

    ``order_by`` must be unique within a key. All flags share one shuffle by key.
    """
    parts = ALL if volume else FLAGS
    d = _annotate(df, value, order_by, keys, volume, config, policy, parts)
    return d.withColumns({"is_anomaly": combined_flag(), "anomaly_score": score_flags()})


def anomaly_summary(flagged: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Rows, anomalies and their percentage, whole or per group."""
    hits = F.sum(F.coalesce(F.col("is_anomaly"), F.lit(False)).cast("long"))
    return flagged.groupBy(*by).agg(
        F.count(F.lit(1)).alias("total_records"),
        F.coalesce(hits, F.lit(0)).alias("anomaly_count"),
        F.coalesce(F.try_divide(hits * 100.0, F.count(F.lit(1))), F.lit(0.0)).alias("anomaly_pct"),
    )


def anomaly_samples(flagged: DataFrame, order_by: Sequence[str], n: int = 5) -> DataFrame:
    """First n anomalous rows in the given order."""
    return flagged.where("is_anomaly").orderBy(*order_by).limit(n)
