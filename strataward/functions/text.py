"""Codes, dataset types and hash IDs from text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: path words per dataset type, tested in this order
TYPE_WORDS = (
    ("stock", "daily|day|trade"),
    ("daily_basic", "daily_basic|basic"),
    ("financial", "financial|finance|income|balance|cash"),
    ("index", "index"),
    ("fund", "fund"),
)
HASH_SPACE = 2147483647  # fixed value


def code_from_path(path: Column | str) -> Column:
    """Listing code in a file name, else the value of a ``ts_code=`` path part."""
    p = F.col(path) if isinstance(path, str) else path
    name = F.element_at(F.split(p, "/"), -1)

    def pick(pattern: str, group: int = 1) -> Column:
        return F.nullif(F.regexp_extract(name, pattern, group), F.lit(""))

    # fixed values: how file names spell a listing code, and the market of six bare digits
    under = pick(r"(\d{6}_[A-Z]{2})")
    prefixed, dotted, digits = pick(r"([A-Z]{2}\d{6})"), pick(r"(\d{6}\.[A-Z]{2})"), pick(r"(\d{6})")
    market = F.when(digits.rlike("^[03]"), F.lit(".SZ")).otherwise(F.lit(".SH"))
    from_dir = F.nullif(F.regexp_extract(p, r"(?:^|/)ts_code=([^/]*)", 1), F.lit(""))
    return F.coalesce(
        F.replace(under, F.lit("_"), F.lit(".")),
        F.concat(F.substring(prefixed, 3, 6), F.lit("."), F.substring(prefixed, 1, 2)),
        dotted,
        F.concat(digits, market),
        from_dir,
    )


def infer_type(path: Column | str) -> Column:
    """Dataset type from words in a path; first match wins."""
    low = F.lower(F.col(path) if isinstance(path, str) else path)
    tests = iter(TYPE_WORDS)
    name, words = next(tests)
    out = F.when(low.rlike(words), F.lit(name))
    for name, words in tests:
        out = out.when(low.rlike(words), F.lit(name))
    return out.otherwise(F.lit("unknown"))


def hash_id(code: Column | str) -> Column:
    """Stable number below 2^31 - 1 for a code; not a permanent ID."""
    return F.pmod(F.xxhash64(code), F.lit(HASH_SPACE))
