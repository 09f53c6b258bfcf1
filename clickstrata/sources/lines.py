"""Parsers from a single text column to typed columns."""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.requests import pair_value, pairs_to_map, query_pairs, query_param, query_text

Layout = Mapping[str, tuple[int, str]]


def _typed(part: Column, type_: str) -> Column:
    part = F.trim(part)
    return part if type_ == "string" else part.try_cast(type_)


def parse_sep(
    df: DataFrame,
    sep: str,
    layout: Layout,
    min_cols: int = 0,
    exact_cols: int | None = None,
    keep_empty: bool = True,
    value: str = "value",
) -> DataFrame:
    """Delimited text → columns by position: ``{name: (index, type)}``.

    Rows with fewer than ``min_cols`` fields (or not ``exact_cols``) are dropped.
    Unparsable values become null.  ``keep_empty=False`` ignores empty fields at
    the end of the line when counting, as a limitless split does.
    """
    text = F.col(value) if keep_empty else F.regexp_replace(F.col(value), f"(?:{re.escape(sep)})+$", "")
    # The array is materialised once and then read per field.
    fields = df.select(F.split(text, re.escape(sep), -1).alias("_f"))
    if exact_cols is not None:
        fields = fields.where(F.size("_f") == exact_cols)
    elif min_cols:
        fields = fields.where(F.size("_f") >= min_cols)
    return fields.select(*[_typed(F.get("_f", F.lit(i)), t).alias(n) for n, (i, t) in layout.items()])


def parse_tsv(df: DataFrame, layout: Layout, min_cols: int = 0, keep_empty: bool = True, value: str = "value") -> DataFrame:
    """Tab-separated logs; see :func:`parse_sep`."""
    return parse_sep(df, "\t", layout, min_cols=min_cols, keep_empty=keep_empty, value=value)


def parse_marked_kv(
    df: DataFrame, fields: Mapping[str, str], open_: str = "[[[", close: str = "]]]", value: str = "value"
) -> DataFrame:
    """Lines carrying ``[[[k=v&k=v]]]`` → typed record; lines without the marker are dropped."""
    pattern = f"{re.escape(open_)}(.*?){re.escape(close)}"
    marked = df.where(F.col(value).rlike(pattern)).select(
        pairs_to_map(F.regexp_extract(value, pattern, 1)).alias("_m")
    )
    return marked.select(*[_typed(F.col("_m")[name], t).alias(name) for name, t in fields.items()])


def parse_request_query(df: DataFrame, params: Mapping[str, str], request: str = "request") -> DataFrame:
    """Adds one column per query parameter (``{parameter: output name}``) of a request line."""
    cols = [c for c in df.columns if c not in params.values()]
    pairs = df.withColumn("_q", query_pairs(query_text(request)))
    return pairs.select(*cols, *[pair_value("_q", k).alias(out) for k, out in params.items()])


def parse_access_line(df: DataFrame, value: str = "value") -> DataFrame:
    """Nine-field access line → date, hour, ip, url struct, status, time, length, user agent.

    ``url`` holds event, ad, ver, uid, os and msg from the query string.  Lines
    with another field count or an unreadable time are dropped.
    """
    fields = df.select(F.split(value, "\t", -1).alias("f")).where(F.size("f") == 9)
    parts = fields.select(
        "f",
        # The text between "[" and the six-character zone suffix; local log time, no conversion.
        F.try_to_timestamp(
            F.regexp_extract(F.get("f", F.lit(2)), r"\[(\d{2}/[A-Za-z]{3}/\d{4}:\d{2}:\d{2}:\d{2})", 1),
            F.lit("dd/MMM/yyyy:HH:mm:ss"),
        ).alias("t"),
        query_text(F.get("f", F.lit(2))).alias("q"),
    ).where(F.col("t").isNotNull())
    return parts.select(
        F.date_format("t", "yyyy-MM-dd").alias("date"),
        F.date_format("t", "HH").alias("hour"),
        F.get("f", F.lit(0)).alias("ip"),
        F.struct(*[query_param("q", k).alias(k) for k in ("event", "ad", "ver", "uid", "os", "msg")]).alias("url"),
        F.get("f", F.lit(3)).alias("resp_code"),
        F.get("f", F.lit(4)).alias("process_time"),
        F.get("f", F.lit(5)).alias("resp_length"),
        F.get("f", F.lit(7)).alias("user_agent"),
    )
