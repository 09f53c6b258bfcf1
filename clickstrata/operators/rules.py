"""Anti-cheat rules: heavy hitters, id lists, suspicious addresses."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.cleaning import as_col, valid_device_value
from ..functions.cleaning import valid_ipv4
from ..functions.identity import ip_prefix_hex, to_md5

# Hourly limits per log, and per id kind for the shared list.
HEAVY_LIMITS = {"click": 50, "imp": 150, "request": 300}
CHEAT_LIMITS = {"imei": 50, "idfa": 50, "ip": 50, "anid": 50, "ip3": 500}
FOURTEEN_ZEROS = "00000000000000"
IP_RULES = {"calls": 20, "few_calls": 5, "resp_ratio": 0.5, "hour_clicks": 3}


def heavy_hitters(
    df: DataFrame, col: str, threshold: int, exclude: Sequence[str] = (), length: int | None = None
) -> DataFrame:
    """Values seen at least ``threshold`` times, with their count; blanks and ``exclude`` never qualify."""
    c = F.col(col)
    df = df.where((c.isNotNull()) & (c.cast("string") != ""))
    if exclude:
        df = df.where(~c.isin(list(exclude)))
    if length is not None:
        df = df.where(F.length(c) == length)
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("cnt")).where(F.col("cnt") >= threshold)


def unpivot_ids(
    df: DataFrame, kinds: Mapping[str, Column | str], keep: Sequence[str] = (), kind_col: str = "kind", value_col: str = "value"
) -> DataFrame:
    """One row per id kind: ``{kind: column}`` → (kept columns, kind, value)."""
    wide = df.select(*keep, *[as_col(c).cast("string").alias(f"_u_{k}") for k, c in kinds.items()])
    long = wide.unpivot(list(keep), [f"_u_{k}" for k in kinds], kind_col, value_col)
    return long.withColumn(kind_col, F.substr(F.col(kind_col), F.lit(4)))


def device_kinds(ip: str = "ip", imei: str = "imei", idfa: str = "idfa", android_id: str = "android_id") -> dict[str, Column]:
    """The id kinds checked for cheating, including the /24 prefix in hex."""
    return {"imei": F.col(imei), "idfa": F.col(idfa), "ip": F.col(ip), "anid": F.col(android_id), "ip3": ip_prefix_hex(ip)}


def valid_ids(df: DataFrame, kind_col: str = "kind", value_col: str = "value") -> DataFrame:
    """Usable values only; an ``ip`` must also be a well-formed address."""
    ok = valid_device_value(value_col)
    return df.where(ok & ((F.col(kind_col) != "ip") | valid_ipv4(value_col)))


def cheat_list(
    sources: Sequence[tuple[str, DataFrame]],
    thresholds: Mapping[str, int] = CHEAT_LIMITS,
    kinds: Mapping[str, Column | str] | None = None,
) -> DataFrame:
    """Ids above their kind's limit in at least one log: (kind, value, cnt = largest qualifying count).

    All logs are counted in one aggregation with one counter per log.
    """
    kinds = kinds or device_kinds()
    parts = [
        valid_ids(unpivot_ids(df.withColumn("_log", F.lit(name)), kinds, keep=["_log"])) for name, df in sources
    ]
    long = reduce(lambda a, b: a.unionByName(b), parts)
    counters = [F.count_if(F.col("_log") == name).alias(f"_c{i}") for i, (name, _) in enumerate(sources)]
    counted = long.groupBy("kind", "value").agg(*counters)
    limit = reduce(
        lambda acc, kv: acc.when(F.col("kind") == kv[0], F.lit(kv[1])), list(thresholds.items()), F.when(F.lit(False), F.lit(0))
    )
    qualified = [F.when(F.col(f"_c{i}") > limit, F.col(f"_c{i}")) for i in range(len(sources))]
    best = F.greatest(*qualified) if len(qualified) > 1 else qualified[0]
    return counted.select("kind", "value", best.alias("cnt")).where(F.col("cnt").isNotNull())


def suspicious_ips(
    df: DataFrame,
    slot: str = "adslocation_id",
    ip: str = "user_ip",
    hour: str = "hour",
    act: str = "act",
    limits: Mapping[str, float] = IP_RULES,
) -> DataFrame:
    """Per slot and address over one day, the addresses breaking a rule, with the metrics that rule concerns.

    condition1: more than 20 calls; condition2: more than 5 calls and fewer than
    half answered; condition3: more than 3 clicks within an hour.
    """
    hourly = df.groupBy(slot, ip, hour).agg(
        F.count_if(F.col(act) == "call").alias("impression"),
        F.count_if(F.col(act) == "resp").alias("resp"),
        F.count_if(F.col(act) == "clk").alias("clicks"),
    )
    daily = hourly.groupBy(slot, ip).agg(
        F.sum("impression").alias("impression"), F.sum("resp").alias("resp"), F.max("clicks").alias("clicks")
    )
    many = F.col("impression") > limits["calls"]
    unanswered = (F.col("impression") > limits["few_calls"]) & (
        F.try_divide(F.col("resp").cast("double"), F.col("impression").cast("double")) < limits["resp_ratio"]
    )
    clicky = F.col("clicks") > limits["hour_clicks"]
    return daily.where(many | unanswered | clicky).select(
        slot,
        ip,
        many.cast("int").alias("condition1"),
        unanswered.cast("int").alias("condition2"),
        clicky.cast("int").alias("condition3"),
        F.when(many | unanswered, F.col("impression")).alias("impression"),
        F.when(unanswered, F.col("resp")).alias("resp"),
        F.when(F.col("clicks") != 0, F.col("clicks")).alias("clicks"),
    )


def device_id_export(
    df: DataFrame, kinds: Mapping[str, Column | str], dummy: str | None = FOURTEEN_ZEROS,
    dummies: Mapping[str, str] | None = None, rehash: bool = False,
) -> DataFrame:
    """Distinct (kind, md5 id) of non-blank ids.

    Placeholders are values containing ``dummy`` and the exact value named per
    kind in ``dummies``.  Values already hashed are kept; ``rehash=True`` hashes
    every value.
    """
    long = unpivot_ids(df, kinds).where(F.col("value").isNotNull() & (F.col("value") != ""))
    if dummy is not None:
        long = long.where(~F.col("value").contains(dummy))
    for kind, value in (dummies or {}).items():
        long = long.where(~((F.col("kind") == kind) & (F.col("value") == value)))
    return long.select("kind", (F.md5("value") if rehash else to_md5("value")).alias("id")).distinct()
