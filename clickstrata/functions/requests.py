"""Request lines, query strings and creative JSON as Column expressions."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .cleaning import as_col

# URI patterns counted under one name; None keeps the matched text.
URI_RULES = [(r"^/api/v1/sa.*", "/api/v1/sa"), (r"^/vip\d*", None)]


def pairs_to_map(c: Column | str, pair_sep: str = "&", kv_sep: str = "=") -> Column:
    """``k=v&k=v`` text → map.  Parts that are not exactly one pair are dropped; a repeated key keeps its last value."""
    parts = F.split(as_col(c), re.escape(pair_sep), -1)
    pairs = F.filter(
        F.transform(parts, lambda p: F.split(p, re.escape(kv_sep), -1)),
        lambda p: F.size(p) == 2,
    )
    empty = F.create_map().cast("map<string,string>")
    return F.aggregate(
        pairs, empty, lambda seen, p: F.map_concat(F.map_filter(seen, lambda k, _: k != p[0]), F.create_map(p[0], p[1]))
    )


def query_param(query: Column | str, name: str) -> Column:
    """Last value of one parameter of ``k=v&k=v`` text; null when absent.

    The text is cut at every well-formed ``name=value`` pair and the last cut
    taken.  ``query`` is referenced once, so a filter on the result can move
    below the projection without evaluating the text again and again.
    """
    pair = f"&{re.escape(name)}=(?=[^&=]*(?:&|$))"
    after = F.filter(F.split(F.concat(F.lit("&"), as_col(query)), pair, -1), lambda _, i: i > 0)
    return F.substring_index(F.try_element_at(after, F.lit(-1)), "&", 1)


def query_pairs(query: Column | str) -> Column:
    """``k=v&k=v`` text → array of [name, value], parts that are not exactly one pair dropped.

    Several parameters of one text are best taken from this array, kept as a column of its own.
    """
    return F.filter(F.transform(F.split(as_col(query), "&", -1), lambda p: F.split(p, "=", -1)), lambda p: F.size(p) == 2)


def pair_value(pairs: Column | str, name: str) -> Column:
    """Last value of a parameter in :func:`query_pairs`; null when absent."""
    return F.try_element_at(F.filter(as_col(pairs), lambda p: p[0] == name), F.lit(-1))[1]


def query_text(request: Column | str) -> Column:
    """The query string of an HTTP request line, '' without one."""
    return F.regexp_extract(as_col(request), r"\?(.*) ", 1)


def request_query(request: Column | str) -> Column:
    """The query parameters of an HTTP request line as a map; null without a query."""
    text = query_text(request)
    return F.when(text != "", pairs_to_map(text))


def url_query(url: Column | str) -> Column:
    """The query parameters of a plain URL as a map; the fragment is ignored."""
    text = F.regexp_extract(as_col(url), r"\?([^#]*)", 1)
    return F.when(text != "", pairs_to_map(text))


def url_host(url: Column | str) -> Column:
    return F.regexp_extract(as_col(url), r"^[a-z]+://([^/?#]*)", 1)


def url_path(url: Column | str) -> Column:
    return F.regexp_extract(as_col(url), r"^[a-z]+://[^/?#]*([^?#]*)", 1)


def normalize_uri(request: Column | str, rules: Sequence[tuple[str, str | None]] = URI_RULES) -> Column:
    """URI of a three-token request line, folded by ``rules``; null for any other line."""
    tokens = F.split(as_col(request), " +", -1)
    uri = F.get(tokens, F.lit(1))
    folded = F.when(F.size(tokens) != 3, F.lit(None).cast("string"))
    for pattern, name in rules:
        value = F.lit(name) if name is not None else F.regexp_extract(uri, f"({pattern})", 1)
        folded = folded.when(uri.rlike(pattern), value)
    return folded.otherwise(uri)


def creative_image_url(creative_json: Column | str, creative_type: Column | str) -> Column:
    """First image of a type-3 creative, else its ``imgurl``; null for broken JSON."""
    js, kind = as_col(creative_json), as_col(creative_type).cast("string")
    return F.when(kind == "3", F.get_json_object(js, "$.img[0].url")).otherwise(F.get_json_object(js, "$.imgurl"))
