"""Detection and repair of common faults."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataward.functions.dates import as_date
from strataward.functions.ordered import ordered
from strataward.functions.quantiles import key_quantiles, ranked_quantiles
from strataward.functions.size import AUTO, BOUNDED, Hot, SkewPolicy, broadcast_if_small, find_hot
from strataward.operators.consistency import broken_high, broken_low

FAULT_SCHEMA = "issue string, field string, count long, percentage double, severity string, lower double, upper double"
OHLC = ("open", "high", "low", "close")


@dataclass(frozen=True)
class RepairConfig:
    iqr_multiplier: float = 1.5
    max_gap_days: int = 7
    repairs: tuple[str, ...] = ("nulls", "outliers", "duplicates", "ohlc", "gaps")
    rules: dict[str, Callable[[DataFrame], DataFrame]] = field(default_factory=dict)


DEFAULTS = RepairConfig()


def _severity(pct: Column, high: float, medium: float | None) -> Column:
    out = F.when(pct > high, "high")
    return out.otherwise("medium") if medium is None else out.when(pct > medium, "medium").otherwise("low")


def _fault(issue: str, field_name, count: Column, pct: Column, severity: Column, lower=None, upper=None) -> Column:
    return F.struct(
        F.lit(issue).alias("issue"),
        F.lit(field_name).cast("string").alias("field"),
        count.cast("long").alias("count"),
        pct.cast("double").alias("percentage"),
        severity.alias("severity"),
        (F.lit(None) if lower is None else lower).cast("double").alias("lower"),
        (F.lit(None) if upper is None else upper).cast("double").alias("upper"),
    )


def _pct(n: Column, total: Column) -> Column:
    return F.coalesce(F.try_divide(n * 100.0, total), F.lit(0.0))


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def detect_nulls(df: DataFrame) -> DataFrame:
    """Columns with nulls; all counted in one pass."""
    n = F.count(F.lit(1)).alias("_n")
    counts = df.agg(n, *[F.count_if(F.col(c).isNull()).alias(f"n{i}") for i, c in enumerate(df.columns)])
    cells = []
    for i, c in enumerate(df.columns):
        pct = _pct(F.col(f"n{i}"), F.col("_n"))
        cells.append(_fault("nulls", c, F.col(f"n{i}"), pct, _severity(pct, 10, 1)))
    return counts.select(F.inline(F.array(*cells))).where(F.col("count") > 0)


def columns_table(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per column name."""
    return df.sparkSession.range(1).select(F.explode(F.array(*[F.lit(c) for c in columns])).alias("field"))


def outlier_bounds(df: DataFrame, columns: Sequence[str] | None = None, multiplier: float = 1.5, policy: SkewPolicy = AUTO) -> DataFrame:
    """Lower and upper bound per numeric column, where the quartiles differ."""
    columns = list(columns or numeric_columns(df))
    cells = F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).cast("double").alias("v")) for c in columns])
    long = df.select(F.inline(cells))
    # each column is one group as long as the frame, so the frame decides the plan
    if find_hot(df, [], policy) is None:
        q = key_quantiles(long, ["field"], "v", [0.25, 0.75], ["q1", "q3"], policy=BOUNDED)
    else:
        groups = Hot(0, len(columns), columns_table(df, columns))
        q = ranked_quantiles(long, ["field"], "v", [0.25, 0.75], ["q1", "q3"], groups, policy)
    reach = multiplier * (F.col("q3") - F.col("q1"))
    return q.where(F.col("q3") > F.col("q1")).select(
        "field", (F.col("q1") - reach).alias("lower"), (F.col("q3") + reach).alias("upper")
    )


def _bounds_row(bounds: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Bounds of all columns as one row of structs; null where a column has none."""
    picks = [F.max(F.when(F.col("field") == c, F.struct("lower", "upper"))).alias(f"_b_{c}") for c in columns]
    return bounds.agg(*picks)


def _scalars(bounds: DataFrame, columns: Sequence[str]) -> dict[str, Column]:
    """Bounds as scalar subqueries over the small bounds table."""
    row = _bounds_row(bounds, columns).select(F.struct(*[F.col(f"_b_{c}").alias(c) for c in columns]).alias("b"))
    value = row.scalar()
    return {c: value[c] for c in columns}


def detect_outliers(df: DataFrame, columns: Sequence[str] | None = None, multiplier: float = 1.5, policy: SkewPolicy = AUTO, bounds: DataFrame | None = None) -> DataFrame:
    """Columns with values outside their quartile bounds; all counted in one pass."""
    columns = list(columns or numeric_columns(df))
    bounds = outlier_bounds(df, columns, multiplier, policy) if bounds is None else bounds
    limits = _scalars(bounds, columns)
    outside = [(F.col(c) < limits[c]["lower"]) | (F.col(c) > limits[c]["upper"]) for c in columns]
    counts = df.agg(F.count(F.lit(1)).alias("_n"), *[F.count_if(o).alias(f"n{i}") for i, o in enumerate(outside)])
    cells = []
    for i, c in enumerate(columns):
        pct = _pct(F.col(f"n{i}"), F.col("_n"))
        cells.append(_fault("outliers", c, F.col(f"n{i}"), pct, _severity(pct, 5, 1), limits[c]["lower"], limits[c]["upper"]))
    return counts.select(F.inline(F.array(*cells))).where(F.col("count") > 0)


def detect_duplicates(df: DataFrame) -> DataFrame:
    """Rows beyond the first of each whole-row group; equal rows merge before the shuffle."""
    groups = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_sw_n"))
    n, total = F.col("extra"), F.col("total")
    counts = groups.agg(F.coalesce(F.sum(F.col("_sw_n") - 1), F.lit(0)).alias("extra"), F.sum("_sw_n").alias("total"))
    pct = _pct(n, total)
    return counts.select(F.inline(F.array(_fault("duplicates", None, n, pct, _severity(pct, 5, 1))))).where(F.col("count") > 0)


def detect_ohlc(df: DataFrame) -> DataFrame:
    """Rows whose high or low does not enclose open and close."""
    bad = F.coalesce(broken_high(), F.lit(False)) | F.coalesce(broken_low(), F.lit(False))
    counts = df.agg(F.count_if(bad).alias("bad"), F.count(F.lit(1)).alias("total"))
    pct = _pct(F.col("bad"), F.col("total"))
    cell = _fault("ohlc_inconsistency", None, F.col("bad"), pct, _severity(pct, 2, None))
    return counts.select(F.inline(F.array(cell))).where(F.col("count") > 0)


def detect_date_gaps(df: DataFrame, date_col: str, keys: Sequence[str] = (), max_days: int = 7) -> DataFrame:
    """Steps between consecutive days of a key that exceed the limit.

    Equal days merge first, so a key orders at most one row per day.
    """
    days = df.select(*keys, as_date(df, date_col).alias("_d")).where(F.col("_d").isNotNull()).distinct()
    w = Window.partitionBy(*(keys or [F.lit(0)])).orderBy("_d")
    step = F.date_diff("_d", F.lag("_d").over(w))
    counts = days.select(step.alias("step")).agg(F.count_if(F.col("step") > max_days).alias("gaps"), F.count(F.lit(1)).alias("total"))
    severity = F.when(F.col("gaps") > 5, "medium").otherwise("low")
    cell = _fault("date_gaps", date_col, F.col("gaps"), _pct(F.col("gaps"), F.col("total")), severity)
    return counts.select(F.inline(F.array(cell))).where(F.col("count") > 0)


def repair_ffill(
    df: DataFrame, columns: Sequence[str], order_by: Sequence[str], keys: Sequence[str] = (), policy: SkewPolicy = AUTO
) -> DataFrame:
    """Nulls take the last known value of their key."""
    o = ordered(df, keys, order_by, fill=columns, policy=policy)
    return o.finish(o.df.withColumns({c: o.filled(c) for c in columns})).select(*df.columns)


def repair_winsorize(df: DataFrame, bounds: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Values beyond a bound move to it; nulls stay."""
    columns = list(columns or numeric_columns(df))
    limits = _scalars(bounds, columns)

    def clipped(c: str) -> Column:
        x, b = F.col(c), limits[c]
        wanted = F.least(F.greatest(x.cast("double"), b["lower"]), b["upper"])
        return F.when(x.isNull() | b.isNull(), x).otherwise(wanted).cast("double").alias(c)

    return df.select(*[clipped(c) if c in columns else F.col(c) for c in df.columns])


def repair_dedup(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


def repair_ohlc(df: DataFrame) -> DataFrame:
    """High and low widened to enclose open and close."""
    return df.withColumns(
        {
            "high": F.when(F.col("high").isNotNull(), F.greatest("high", "open", "close")),
            "low": F.when(F.col("low").isNotNull(), F.least("low", "open", "close")),
        }
    )


def repair_gaps(
    df: DataFrame,
    date_col: str,
    values: Sequence[str],
    keys: Sequence[str] = (),
    calendar: DataFrame | None = None,
    policy: SkewPolicy = AUTO,
) -> DataFrame:
    """Missing days of a key, with values on the line between their neighbours.

    Each row expands to the days since the row before it, so no day grid is joined.
    With a calendar only its open days are added. Days must be unique in a key;
    other columns of an added row are null. Rows without a readable date stay as they are.
    """
    narrow = df.withColumn("_d", as_date(df, date_col))
    o = ordered(narrow.where(F.col("_d").isNotNull()), keys, ["_d"], halo=1, policy=policy)
    w = o.window
    stepped = o.df.withColumn("_prev", F.lag("_d").over(w)).withColumns({f"_p_{c}": F.lag(c).over(w) for c in values})
    stepped = o.finish(stepped)
    # two rows on one day give no days between them
    first = F.least(F.coalesce(F.date_add("_prev", 1), F.col("_d")), F.col("_d"))
    days = stepped.withColumn("_day", F.explode(F.sequence(first, F.col("_d"))))
    own = F.col("_day") == F.col("_d")
    if calendar is not None:
        opened = calendar.where(F.col("is_open") == 1).select(F.col("cal_date").alias("_day"), F.lit(True).alias("_open"))
        days = days.join(broadcast_if_small(opened), "_day", "left").where(own | F.col("_open"))
    share = F.try_divide(F.date_diff("_day", "_prev"), F.date_diff("_d", "_prev"))
    stored = df.schema[date_col].dataType
    day_value = F.date_format("_day", "yyyyMMdd") if isinstance(stored, T.StringType) else F.col("_day").cast(stored)

    def cell(c: str) -> Column:
        if c in keys:
            return F.col(c)
        if c == date_col:
            return F.when(own, F.col(c)).otherwise(day_value).alias(c)
        if c in values:
            line = F.col(f"_p_{c}") + (F.col(c) - F.col(f"_p_{c}")) * share
            return F.when(own, F.col(c)).otherwise(line).alias(c)
        return F.when(own, F.col(c)).alias(c)

    filled = days.select(*[cell(c) for c in df.columns], (~own).alias("is_filled"))
    return filled.unionByName(narrow.where(F.col("_d").isNull()).select(*df.columns, F.lit(False).alias("is_filled")))


# fixed values: confidence of each repair, some less a share of the faulty percentage
CONFIDENCE = {
    "nulls": (1.0, 100.0),
    "outliers": (1.0, 200.0),
    "duplicates": (0.95, None),
    "ohlc_inconsistency": (0.8, None),
    "date_gaps": (0.6, None),
}


def detect_faults(
    df: DataFrame, date_col: str | None = None, keys: Sequence[str] = (), config: RepairConfig = DEFAULTS,
    policy: SkewPolicy = AUTO, bounds: DataFrame | None = None,
) -> DataFrame:
    """Every detector on the given rows."""
    frames = [detect_nulls(df), detect_duplicates(df)]
    numbers = [c for c in numeric_columns(df) if c not in keys]
    if numbers:
        frames.append(detect_outliers(df, numbers, config.iqr_multiplier, policy, bounds))
    if set(OHLC) <= set(df.columns):
        frames.append(detect_ohlc(df))
    if date_col:
        frames.append(detect_date_gaps(df, date_col, keys, config.max_gap_days))
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


# which fault each named repair answers
_ANSWERS = {"nulls": "nulls", "outliers": "outliers", "duplicates": "duplicates", "ohlc": "ohlc_inconsistency", "gaps": "date_gaps"}


def repair_confidence(faults: DataFrame, repairs: Sequence[str] = DEFAULTS.repairs) -> DataFrame:
    """One row: mean confidence of the repairs made, or one less the severity share when none was."""
    done = [_ANSWERS[r] for r in repairs if r in _ANSWERS]
    score = None
    for issue in done:
        base, per = CONFIDENCE[issue]
        value = F.lit(base) if per is None else F.lit(base) - F.col("percentage") / per
        cond = F.col("issue") == issue
        score = F.when(cond, value) if score is None else score.when(cond, value)
    score = F.lit(None).cast("double") if score is None else score
    weight = F.when(F.col("severity") == "high", 3).when(F.col("severity") == "medium", 2).otherwise(1)
    n = F.count(F.lit(1))
    unrepaired = 1.0 - F.try_divide(F.sum(weight), n * 3)
    confidence = F.when(n == 0, 1.0).otherwise(F.coalesce(F.avg(score), unrepaired))
    return faults.agg(n.alias("faults"), F.count(score).alias("repaired"), confidence.cast("double").alias("confidence"))


def repair_dataset(
    df: DataFrame,
    order_by: Sequence[str],
    keys: Sequence[str] = (),
    date_col: str | None = None,
    calendar: DataFrame | None = None,
    config: RepairConfig = DEFAULTS,
    policy: SkewPolicy = AUTO,
) -> tuple[DataFrame, DataFrame]:
    """Repaired rows and the faults found in the original ones.

    Bounds come from the original rows. Repairs follow in a fixed order: nulls,
    outliers, duplicates, OHLC, gaps, then any rules given by name.
    """
    numbers = [c for c in numeric_columns(df) if c not in keys]
    bounds = outlier_bounds(df, numbers, config.iqr_multiplier, policy) if numbers else None
    faults = detect_faults(df, date_col, keys, config, policy, bounds)
    out = df
    if "nulls" in config.repairs:
        fillable = [c for c in out.columns if c not in keys and c not in order_by and c != date_col]
        out = repair_ffill(out, fillable, order_by, keys, policy)
    if "outliers" in config.repairs and bounds is not None:
        out = repair_winsorize(out, bounds, numbers)
    if "duplicates" in config.repairs:
        out = repair_dedup(out)
    if "ohlc" in config.repairs and set(OHLC) <= set(out.columns):
        out = repair_ohlc(out)
    if "gaps" in config.repairs and date_col:
        out = repair_gaps(out, date_col, numbers, keys, calendar, policy)
    for rule in config.rules.values():
        out = rule(out)
    return out, faults
