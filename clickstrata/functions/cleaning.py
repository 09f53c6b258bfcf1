"""Blank handling, validity predicates and small projections (Columns only)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The spellings logs use for "no value" and the id formats accepted downstream.
MISSING_WORDS = ["\\N", "unknown", "没有权限"]
NUMERIC_ID = r"^[\d\-.]+$"
UNSIGNED_ID = r"^[0-9]+$"
SIGNED_ID = r"^-?\d+$"
OCTET = r"(25[0-5]|2[0-4]\d|[01]?\d{1,2})"
IPV4 = "^" + OCTET + r"(\." + OCTET + "){3}$"
CJK_ONLY = r"^[一-龥]+$"


def as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_blank(c: Column | str) -> Column:
    """Null, empty or only spaces."""
    c = as_col(c).cast("string")
    return c.isNull() | (F.trim(c) == "")


def blank_to(c: Column | str, default: object = "-1") -> Column:
    """``c`` with blanks replaced by ``default``."""
    c = as_col(c)
    return F.when(is_blank(c), F.lit(default)).otherwise(c)


def null_if_blank(c: Column | str) -> Column:
    c = as_col(c)
    return F.when(~is_blank(c), c)


def require_numeric_ids(df: DataFrame, cols: Sequence[str], pattern: str = NUMERIC_ID) -> DataFrame:
    """Rows whose every listed id column matches ``pattern``."""
    for name in cols:
        df = df.where(F.col(name).cast("string").rlike(pattern))
    return df


def valid_device_value(c: Column | str, zero_pattern: str = "^[0-]*$") -> Column:
    """True for a usable device value: present, not a missing-word, not all zeros.

    ``zero_pattern`` widens what counts as a dummy, e.g. ``^[0:2-]*$`` also drops
    the placeholder MAC address.
    """
    c = as_col(c)
    return F.coalesce(
        (c != "") & ~c.isin(MISSING_WORDS) & ~c.rlike(zero_pattern),
        F.lit(False),
    )


def valid_ipv4(c: Column | str) -> Column:
    return F.coalesce(as_col(c).rlike(IPV4), F.lit(False))


def max_length(df: DataFrame, limits: dict[str, int]) -> DataFrame:
    """Rows whose string columns stay within ``limits``; nulls do not pass."""
    for name, limit in limits.items():
        df = df.where(F.length(name) <= limit)
    return df


def split_dims(c: Column | str, sep: str = "x") -> tuple[Column, Column]:
    """``'640x320'`` → (``'640'``, ``'320'``); nulls when ``sep`` is absent."""
    c = as_col(c)
    parts = F.split(c, F.lit(sep) if sep.isalnum() else F.lit("\\" + sep), -1)
    has = c.contains(sep)
    return F.when(has, F.get(parts, F.lit(0))), F.when(has, F.get(parts, F.lit(1)))


def truncate_coord(c: Column | str) -> Column:
    """Integer part of a coordinate kept as text; text without a point is unchanged."""
    return F.substring_index(as_col(c), ".", 1)


def floor_coord(c: Column | str) -> Column:
    """Numeric floor of a coordinate; null when it is not a number."""
    return F.floor(as_col(c).try_cast("double"))


def utc_bucket(epoch: Column | str, unit: str) -> Column:
    """Epoch seconds floored to the UTC ``hour`` or ``day``."""
    seconds = {"hour": 3600, "day": 86400}[unit]
    epoch = as_col(epoch).cast("bigint")
    return epoch - F.pmod(epoch, F.lit(seconds).cast("bigint"))


def tag_columns(df: DataFrame, **constants: object) -> DataFrame:
    """Constant columns such as ``time=``, ``hour=``, ``del_=``; a trailing ``_`` is dropped."""
    return df.withColumns({k.rstrip("_"): F.lit(v) for k, v in constants.items()})


def content_click_filter(
    df: DataFrame, log_type: str = "logType", content: str = "contentId", channel: str | None = None
) -> DataFrame:
    """News clicks: type 1 and a content id longer than 32 with ``_``; optionally a Chinese-named channel."""
    df = df.where((F.col(log_type) == "1") & (F.length(content) > 32) & F.col(content).contains("_"))
    if channel is not None:
        df = df.where(F.col(channel).rlike(CJK_ONLY))
    return df


def exclude_values(df: DataFrame, col: str, values: Sequence[object]) -> DataFrame:
    """Rows whose ``col`` is not in ``values``; null ``col`` is dropped as SQL ``NOT IN`` does."""
    return df.where(~F.col(col).isin(list(values)))
