"""Permanent integer IDs for natural keys."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataward.functions.ordered import with_index
from strataward.functions.size import AUTO, SkewPolicy, broadcast_if_small, empty_frame
from strataward.sources import fs

# fixed values: first and last ID of each kind
ID_RANGES = {
    "stock": (1_000_000, 1_999_999),
    "industry": (2_000_000, 2_999_999),
    "region": (3_000_000, 3_999_999),
}


def empty_dictionary(spark: SparkSession) -> DataFrame:
    return empty_frame(spark, "code string, id long")


def allocate_ids(
    existing: DataFrame, codes: DataFrame, kind: str, ranges: dict = ID_RANGES, policy: SkewPolicy = AUTO
) -> DataFrame:
    """Dictionary with an ID for every code: known codes keep theirs, new ones follow in code order.

    The ID after the last of the range raises when the result is evaluated.
    """
    low, high = ranges[kind]
    known = existing.select("code", "id")
    new = codes.select("code").where(F.col("code").isNotNull()).distinct().join(known.select("code"), "code", "left_anti")
    last = F.coalesce(known.agg(F.max("id")).scalar(), F.lit(low - 1))
    numbered = with_index(new, [], ["code"], "_n", policy)
    value = last + 1 + F.col("_n")
    checked = F.when(value <= high, value).otherwise(F.raise_error(F.lit(f"{kind} ID range is exhausted")).cast("long"))
    return known.unionByName(numbered.select("code", checked.cast("long").alias("id")))


def encode(
    df: DataFrame, dictionary: DataFrame, code_col: str, id_col: str | None = None, on_missing: str = "null"
) -> DataFrame:
    """Add or replace the ID of a code; unknown codes give null or raise."""
    id_col = id_col or f"{code_col}_id"
    if on_missing not in ("null", "error"):
        raise ValueError(f"unknown on_missing {on_missing}")
    lookup = broadcast_if_small(dictionary.select(F.col("code").alias(code_col), F.col("id").alias("_sw_id")))
    out = df.drop(id_col).join(lookup, code_col, "left")
    value = F.col("_sw_id")
    if on_missing == "error":
        value = F.when(value.isNotNull() | F.col(code_col).isNull(), value).otherwise(
            F.raise_error(F.concat(F.lit("no ID for code "), F.col(code_col))).cast("long")
        )
    columns = [c for c in df.columns if c != id_col]
    return out.select(*columns, value.alias(id_col))


def sync_encode(
    df: DataFrame, dictionary: DataFrame, code_col: str, kind: str, id_col: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """Encode and give unknown codes new IDs; returns the rows and the grown dictionary."""
    grown = allocate_ids(dictionary, df.select(F.col(code_col).alias("code")), kind)
    return encode(df, grown, code_col, id_col), grown


def remove_codes(dictionary: DataFrame, codes: DataFrame) -> DataFrame:
    """The dictionary without some codes (``code``); their IDs are not given out again below the largest one. Unknown codes change nothing."""
    return dictionary.join(broadcast_if_small(codes.select("code")), "code", "left_anti").select(*dictionary.columns)


def decode(df: DataFrame, dictionary: DataFrame, id_col: str, code_col: str = "ts_code", label: str = "stock") -> DataFrame:
    """Add the code of an ID; an unmapped ID reads ``<label>_id_<id>``."""
    lookup = broadcast_if_small(dictionary.select(F.col("id").alias(id_col), F.col("code").alias("_sw_code")))
    unmapped = F.when(F.col(id_col).isNotNull(), F.concat(F.lit(f"{label}_id_"), F.col(id_col).cast("string")))
    out = df.drop(code_col).join(lookup, id_col, "left")
    columns = [c for c in df.columns if c != code_col]
    return out.select(*columns, F.coalesce("_sw_code", unmapped).alias(code_col))


def build_dimensions(entities: DataFrame, existing: dict[str, DataFrame] | None = None) -> dict[str, DataFrame]:
    """Industry and region dictionaries and the entity dimension with their IDs.

    ``entities``: code, industry, region and any attributes.
    """
    existing = existing or {}
    empty = empty_dictionary(entities.sparkSession)
    dims = {
        kind: allocate_ids(existing.get(kind, empty), entities.select(F.col(kind).alias("code")), kind)
        for kind in ("industry", "region")
    }
    stock = allocate_ids(existing.get("stock", empty), entities.select("code"), "stock")
    attributes = entities.dropDuplicates(["code"])
    out = stock.join(attributes, "code", "left")
    for kind in ("industry", "region"):
        out = encode(out, dims[kind], kind)
    return {"stock": out, **dims}


def dict_stats(dictionary: DataFrame, kind: str, ranges: dict = ID_RANGES) -> DataFrame:
    """Count, ends, next ID, free IDs and IDs outside the range."""
    low, high = ranges[kind]
    n = F.count(F.lit(1))
    following = F.coalesce(F.max("id") + 1, F.lit(low))
    return dictionary.agg(
        F.lit(kind).alias("kind"),
        n.alias("id_count"),
        F.min("id").alias("min_id"),
        F.max("id").alias("max_id"),
        following.cast("long").alias("next_id"),
        (F.lit(high) - following + 1).cast("long").alias("remaining"),
        F.coalesce(F.sum((~F.col("id").between(low, high)).cast("long")), F.lit(0)).alias("out_of_range"),
    )


def valid_ids(ids: DataFrame, dictionary: DataFrame, kind: str, ranges: dict = ID_RANGES) -> DataFrame:
    """Flag IDs that lie in the range and have been given out."""
    low, high = ranges[kind]
    given = broadcast_if_small(dictionary.select("id").withColumn("_sw_given", F.lit(True)))
    return ids.join(given, "id", "left").select(
        *ids.columns, (F.col("id").between(low, high) & F.coalesce("_sw_given", F.lit(False))).alias("is_valid")
    )


def check_dict_consistency(
    dims: dict[str, DataFrame], facts: dict[str, tuple[DataFrame, str, str]] | None = None, ranges: dict = ID_RANGES
) -> DataFrame:
    """Totals, null and out-of-range IDs per dictionary and per fact table.

    ``facts``: name to (frame, ID column, kind).
    """
    sources = [(f"{kind}_dictionary", df, "id", kind) for kind, df in dims.items()]
    sources += [(name, df, column, kind) for name, (df, column, kind) in (facts or {}).items()]
    out = None
    for name, df, column, kind in sources:
        low, high = ranges[kind]
        c = F.col(column)
        one = df.agg(
            F.count(F.lit(1)).alias("total"),
            F.coalesce(F.sum(c.isNull().cast("long")), F.lit(0)).alias("null_ids"),
            F.coalesce(F.sum((~c.between(low, high)).cast("long")), F.lit(0)).alias("out_of_range"),
        ).select(F.lit(name).alias("source"), F.lit(kind).alias("kind"), "total", "null_ids", "out_of_range")
        out = one if out is None else out.unionByName(one)
    return out.withColumn("is_consistent", (F.col("out_of_range") == 0) & (F.col("null_ids") == 0))


def universe(dictionary: DataFrame, snapshot: DataFrame | None = None) -> DataFrame:
    """All codes, from a snapshot where one is given."""
    return (dictionary if snapshot is None else snapshot).select("code").distinct()


def lookup(dictionary: DataFrame, code: str) -> DataFrame:
    return dictionary.where(F.col("code") == code)


def content_hash(df: DataFrame) -> DataFrame:
    """Order-free SHA-256 of a table as one row, by a tree of hashes.

    Rows are hashed alone, equal rows are counted, and digests are joined within
    short prefixes, so no step holds more than a slice of the table.
    """
    cells = [F.coalesce(F.concat(F.length(F.col(c).cast("string")).cast("string"), F.lit("="), F.col(c).cast("string")), F.lit("~")) for c in sorted(df.columns)]
    leaf = df.select(F.sha2(F.concat_ws("|", *cells), 256).alias("h")).groupBy("h").agg(F.count(F.lit(1)).alias("n"))
    digests = leaf.select(F.substring("h", 1, 4).alias("p"), F.concat_ws(":", "h", F.col("n").cast("string")).alias("h"))

    def fold(level: DataFrame, *by: str) -> DataFrame:
        joined = F.concat_ws("", F.array_sort(F.collect_list("h")))
        return level.groupBy(*by).agg(F.sha2(joined, 256).alias("h"))

    fine = fold(digests, "p").select(F.substring("p", 1, 2).alias("p"), "h")
    return fold(fold(fine, "p")).select(F.col("h").alias("content_hash"))


VERSION_SCHEMA = T.StructType(
    [
        T.StructField("kind", T.StringType()),
        T.StructField("seq", T.LongType()),
        T.StructField("version", T.StringType()),
        T.StructField("action", T.StringType()),
        T.StructField("content_hash", T.StringType()),
        T.StructField("record_count", T.LongType()),
        T.StructField("created_at", T.StringType()),
        T.StructField("snapshot", T.StringType()),
    ]
)


def version_history(spark: SparkSession, store: str, kind: str | None = None) -> DataFrame:
    """Append-only log of versions, oldest first."""
    path = f"{store}/versions"
    if not fs.has_parquet(spark, path):
        return spark.createDataFrame([], VERSION_SCHEMA)
    log = spark.read.schema(VERSION_SCHEMA).parquet(path)
    return (log if kind is None else log.where(F.col("kind") == kind)).orderBy("kind", "seq")


def current_version(spark: SparkSession, store: str, kind: str):
    """Newest log record of a kind, or None."""
    return version_history(spark, store, kind).orderBy(F.col("seq").desc()).first()


def _append(spark: SparkSession, store: str, record: dict) -> None:
    row = tuple(record[f.name] for f in VERSION_SCHEMA.fields)
    spark.createDataFrame([row], VERSION_SCHEMA).coalesce(1).write.mode("append").parquet(f"{store}/versions")


SLICE, SLICES = "slice_no", 16  # a snapshot is stored in slices by a hash of the code


def _snapshot(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).drop(SLICE)


def _slice_digests(stored: DataFrame) -> DataFrame:
    """Rows and two sums of row hashes of each slice; sums need no order, so no slice is held."""
    columns = sorted(c for c in stored.columns if c != SLICE)
    total = lambda *c: F.sum(F.xxhash64(*c).cast("decimal(20,0)"))
    return stored.groupBy(SLICE).agg(F.count(F.lit(1)).alias("n"), total(*columns).alias("h1"), total(F.lit("second"), *columns).alias("h2"))


def changed_slices(spark: SparkSession, store: str, old: str, new: str) -> list[int]:
    """Slices in which two versions differ, by their stored digests."""
    before, after = (spark.read.parquet(f"{store}/digests/{v}") for v in (old, new))
    seen = before.exceptAll(after).unionByName(after.exceptAll(before)).select(SLICE).distinct()
    return sorted(r[0] for r in seen.collect())


def version_diff(spark: SparkSession, store: str, kind: str, old: str, new: str) -> DataFrame:
    """``code`` and ``action`` (added, removed or changed) between two versions; codes must be unique in each.

    Only the slices whose digests differ are read.
    """
    paths = {r["version"]: r["snapshot"] for r in version_history(spark, store, kind).where(F.col("version").isin(old, new)).collect()}
    if missing := {old, new} - set(paths):
        raise ValueError(f"no version {sorted(missing)} of {kind}")
    slices = changed_slices(spark, store, old, new)

    def rows(version: str, side: str) -> DataFrame:
        df = spark.read.parquet(paths[version])
        content = F.struct(*sorted(c for c in df.columns if c not in ("code", SLICE)))
        return df.where(F.col(SLICE).isin(slices)).select("code", content.alias(side), F.lit(True).alias(f"in_{side}"))

    both = rows(old, "a").join(rows(new, "b"), "code", "full_outer")
    action = F.when(F.col("in_a").isNull(), "added").when(F.col("in_b").isNull(), "removed").when(~F.col("a").eqNullSafe(F.col("b")), "changed")
    return both.select("code", action.alias("action")).where("action IS NOT NULL")


def version_dict(dictionary: DataFrame, store: str, kind: str, created_at: str) -> str:
    """Keep a snapshot of the dictionary and log it; returns the version name."""
    spark = dictionary.sparkSession
    last = current_version(spark, store, kind)
    seq = 1 if last is None else last["seq"] + 1
    version = f"{kind}_{seq:06d}"
    snapshot = f"{store}/snapshots/{version}"
    sliced = dictionary.withColumn(SLICE, F.pmod(F.xxhash64("code"), F.lit(SLICES)).cast("int"))
    sliced.repartition(SLICE).write.mode("overwrite").partitionBy(SLICE).parquet(snapshot)
    _slice_digests(spark.read.parquet(snapshot)).coalesce(1).write.mode("overwrite").parquet(f"{store}/digests/{version}")
    kept = _snapshot(spark, snapshot)
    _append(spark, store, {
        "kind": kind, "seq": seq, "version": version, "action": "create",
        "content_hash": content_hash(kept).first()["content_hash"], "record_count": kept.count(),
        "created_at": created_at, "snapshot": snapshot,
    })
    return version


def rollback_dict(spark: SparkSession, store: str, kind: str, version: str, created_at: str) -> DataFrame:
    """Make an earlier version current again and return its content."""
    found = version_history(spark, store, kind).where(F.col("version") == version).first()
    if found is None:
        raise ValueError(f"no version {version} of {kind}")
    last = current_version(spark, store, kind)
    _append(spark, store, {**found.asDict(), "seq": last["seq"] + 1, "action": "rollback", "created_at": created_at})
    return _snapshot(spark, found["snapshot"])


def current_dict(spark: SparkSession, store: str, kind: str) -> DataFrame:
    """Content of the current version."""
    last = current_version(spark, store, kind)
    return empty_dictionary(spark) if last is None else _snapshot(spark, last["snapshot"])


def sync_status(dims: dict[str, DataFrame], ranges: dict = ID_RANGES) -> DataFrame:
    """Statistics of every dictionary, one row each."""
    out = None
    for kind, df in dims.items():
        one = dict_stats(df.select("code", "id"), kind, ranges)
        out = one if out is None else out.unionByName(one)
    return out
