"""Exchange reports: media requests, demand requests, responses, impressions, clicks, wins."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.cleaning import NUMERIC_ID, blank_to, null_if_blank, require_numeric_ids, utc_bucket
from ..operators.dims import DimSpec, lookup_dims
from ..operators.funnel import FactSpec, measure_names, merge_funnel, rollup

# Status codes of demand requests; -2 marks "does not apply".
DEMAND_STATUS = {"dsp_fill_req": "1", "dsp_req_timeout": "201", "dsp_req_parse_error": "202", "dsp_req_invalid_ad": "203", "dsp_req_no_bid": "206"}
NOT_APPLICABLE = "-2"
LOOKED_UP = ["pkg_id", "country_id", "platform_id", "style_id", "mlevel_id"]
DIMS = ["media_id", "posid_id", *LOOKED_UP]
DEMAND_MEASURES = ["dsp_req", "dsp_fill_req", "dsp_floor", "dsp_req_timeout", "dsp_req_parse_error", "dsp_req_invalid_ad", "dsp_req_no_bid"]


def exchange_dims(dims: Mapping[str, DataFrame]) -> list[DimSpec]:
    """Name → id look-ups of raw ``pkg, country, platform, style, media_id`` columns."""
    return [
        DimSpec(dims["pkg"], "pkg", "name", {"pkg_id": "id"}),
        DimSpec(dims["country"], "country", "jsonkey", {"country_id": "id"}),
        DimSpec(dims["platform"], "platform", "jsonkey", {"platform_id": "id"}),
        DimSpec(dims["style"], "style", "jsonkey", {"style_id": "id"}),
        DimSpec(dims["media"], "media_id", "id", {"mlevel_id": "mlevel_id"}),
    ]


def resolve_then_rollup(
    raw: DataFrame, keys: Sequence[str], dims: Sequence[DimSpec], measures: Mapping[str, str]
) -> DataFrame:
    """Look up ids on aggregated rows and aggregate again.

    ``raw`` is already one row per raw key, so the joins see groups rather than
    log lines, and unknown names that fold to one default meet only there.
    """
    return rollup(lookup_dims(raw, dims), keys, list(measures), ops=measures)


def _raw_dims(df: DataFrame) -> dict[str, Column]:
    return {
        "media_id": blank_to("app_id"), "posid_id": blank_to("adsolt_id"), "pkg": F.col("pkg_name"),
        "country": F.col("country"), "platform": F.col("os"), "style": F.col("adsolt_type"),
    }


def media_request_hourly(media_req: DataFrame, dims: Mapping[str, DataFrame]) -> DataFrame:
    """Requests and floor-price sum per hour and resolved dimension."""
    raw_keys = {"hour": utc_bucket("req_time", "hour"), **_raw_dims(media_req)}
    raw = merge_funnel(
        [FactSpec(media_req, raw_keys, {"ssp_req": F.lit(1), "ssp_floor": F.col("req_floor_price").try_cast("double")})],
        list(raw_keys), fill=None,
    )
    return resolve_then_rollup(raw, ["hour", *DIMS], exchange_dims(dims), {"ssp_req": "sum", "ssp_floor": "sum"})


def _per_request(df: DataFrame, measures: Mapping[str, Column], extra: Mapping[str, str]) -> DataFrame:
    """First of two phases: one row per (request, demand source, target, hour), attributes by ``max``."""
    attrs = {"media_id": "app_id", "posid_id": "adsolt_id", "pkg": "pkg_name", "country": "country", "platform": "os", "style": "adsolt_type"}
    attrs |= extra
    keyed = df.withColumns({"hour": utc_bucket("req_time", "hour"), "_dsp": F.col("real_dsp_id"), "_target": F.col("dsp_id")})
    keyed = keyed.select("request_id", "_dsp", "_target", "hour", *[F.col(src).alias(f"a_{n}") for n, src in attrs.items()],
                         *[c for c in df.columns if c not in ("request_id", "hour")])
    one = keyed.groupBy("request_id", "_dsp", "_target", "hour").agg(
        *[F.max(f"a_{n}").alias(n) for n in attrs], *[m.alias(n) for n, m in measures.items()]
    )
    return one.withColumnsRenamed({"_dsp": "dsp_id", "_target": "target_id"})


RAW_KEYS = ["hour", "dsp_id", "target_id", "media_id", "posid_id", "pkg", "country", "platform", "style"]


def request_level_dedup_agg(df: DataFrame, measures: Mapping[str, Column], dims: Mapping[str, DataFrame]) -> DataFrame:
    """Two-phase aggregation: ``measures`` once per request, then summed per resolved dimension."""
    one = _per_request(df, measures, {}).withColumns({"media_id": blank_to("media_id"), "posid_id": blank_to("posid_id")})
    grouped = rollup(one, RAW_KEYS, list(measures))
    return resolve_then_rollup(grouped, ["hour", "dsp_id", "target_id", *DIMS], exchange_dims(dims), {m: "sum" for m in measures})


def _once() -> Column:
    return F.max(F.lit(1)).cast("bigint")


def demand_request_measures() -> dict[str, Column]:
    price = F.col("dsp_bid_price").try_cast("double")
    status = F.col("staus_code")
    # "dsp_req" is one per request whatever the number of rows.
    return {
        "dsp_req": _once(),
        "dsp_floor": F.sum(F.when(status == DEMAND_STATUS["dsp_fill_req"], price)),
        **{name: F.count_if(status == code) for name, code in DEMAND_STATUS.items()},
    }


def response_measures() -> dict[str, Column]:
    return {"dsp_win": _once(), "dsp_win_price": F.max(F.col("dsp_bid").try_cast("double"))}


def impression_measures() -> dict[str, Column]:
    return {
        "imp": _once(), "revenue": F.max(F.col("dsp_final_price").try_cast("double")),
        "cost": F.max(F.col("ssp_final_price").try_cast("double")),
    }


def click_measures() -> dict[str, Column]:
    return {"clk": _once()}


def win_measures() -> dict[str, Column]:
    return {"ssp_win": _once()}


def exchange_hourly(
    logs: Mapping[str, DataFrame], dims: Mapping[str, DataFrame], tag_dim: DataFrame | None = None, size_dim: DataFrame | None = None
) -> DataFrame:
    """The hourly exchange table: media requests plus the five demand-side blocks merged per key.

    Each demand log is reduced to one row per request; all logs then meet on
    their raw names in one aggregation, and ids are looked up once on its rows.

    ``logs`` has ``media_req, dsp_req, media_resp, imp, clk, dsp_win``.  Every
    measure comes from one block; only rows whose ids are all numeric are kept.
    With ``tag_dim`` the demand blocks carry ``tag_id``, with ``size_dim`` the
    responses carry ``adsize_id``; rows without either have ``-1``.
    """
    blank_ids = {c: blank_to(c) for c in ("dsp_id", "target_id", "media_id", "posid_id")}
    optional = (["tag"] if tag_dim is not None else []) + (["size"] if size_dim is not None else [])
    media = logs["media_req"]
    none = {"dsp_id": F.lit(NOT_APPLICABLE), "target_id": F.lit(NOT_APPLICABLE)}
    facts = [FactSpec(
        media, {"hour": utc_bucket("req_time", "hour"), **none, **_raw_dims(media), **{c: F.lit(None).cast("string") for c in optional}},
        {"ssp_req": F.lit(1).cast("bigint"), "ssp_floor": F.col("req_floor_price").try_cast("double")},
    )]
    for name, measures in (
        ("dsp_req", demand_request_measures()), ("media_resp", response_measures()), ("imp", impression_measures()),
        ("clk", click_measures()), ("dsp_win", win_measures()),
    ):
        log, extra = logs[name], {}
        if tag_dim is not None:
            extra["tag"] = "tag_id"
        if size_dim is not None and name == "media_resp":
            log, extra["size"] = log.withColumn("_size", ad_size()), "_size"
        one = _per_request(log, measures, extra)
        keys = {k: blank_ids.get(k, F.col(k)) for k in RAW_KEYS}
        keys |= {c: F.col(c) if c in extra else F.lit(None).cast("string") for c in optional}
        facts.append(FactSpec(one, keys, {m: m for m in measures}))
    raw = merge_funnel(facts, [*RAW_KEYS, *optional], fill=None)
    specs, out = exchange_dims(dims), ["hour", "dsp_id", "target_id", *DIMS]
    for raw_name, dim, name in (("tag", tag_dim, "tag_id"), ("size", size_dim, "adsize_id")):
        if dim is not None:
            specs.append(DimSpec(dim, raw_name, "name", {name: "id"}))
            out.append(name)
    both = resolve_then_rollup(raw, out, specs, {m: "sum" for m in measure_names(facts)})
    both = both.withColumn("time", utc_bucket("hour", "day"))
    return require_numeric_ids(both, ["posid_id", "media_id", "dsp_id", *LOOKED_UP], NUMERIC_ID)


def request_funnel(media_req: DataFrame, dsp_req: DataFrame, media_resp: DataFrame) -> DataFrame:
    """Request → demand request → response, one row per (request, demand source).

    Each log is reduced to its join grain first; requests without a demand
    request keep a null source.
    """
    req = media_req.groupBy("request_id").agg(
        *[F.max(src).alias(n) for n, src in {"media_id": "app_id", "posid_id": "adsolt_id", "pkg": "pkg_name", "country": "country", "platform": "os", "style": "adsolt_type"}.items()]
    )
    demand = dsp_req.groupBy("request_id", "dsp_id").agg(
        _once().alias("dsp_req"),
        F.sum(null_if_blank("dsp_bid_price").try_cast("double")).alias("dsp_floor"),
        *[F.count_if(F.col("staus_code") == code).alias(n) for n, code in DEMAND_STATUS.items()],
    )
    resp = media_resp.groupBy("request_id", "dsp_id").agg(
        _once().alias("dsp_win"), F.max(F.col("dsp_bid").try_cast("double")).alias("dsp_win_price")
    )
    return req.join(demand, "request_id", "left").join(resp, ["request_id", "dsp_id"], "left")


def request_funnel_report(
    logs: Mapping[str, DataFrame], dims: Mapping[str, DataFrame], targets: DataFrame | None = None
) -> DataFrame:
    """Request-grain variant of the hourly table: funnel ∪ impressions ∪ clicks ∪ wins per (request, source),
    then per dimension, plus the request-only rows under source ``-2``.
    """
    funnel = request_funnel(logs["media_req"], logs["dsp_req"], logs["media_resp"])
    attrs = ["media_id", "posid_id", "pkg", "country", "platform", "style"]
    keys = {"request_id": "request_id", "dsp_id": "dsp_id"}
    funnel_measures = {m: m for m in [*attrs, *DEMAND_MEASURES, "dsp_win", "dsp_win_price"]}
    one = F.lit(1).cast("bigint")
    facts = [
        FactSpec(funnel, keys, funnel_measures),
        FactSpec(logs["imp"], keys, {"imp": one, "revenue": F.col("dsp_final_price").try_cast("double"), "cost": F.col("ssp_final_price").try_cast("double")}),
        FactSpec(logs["clk"], keys, {"clk": one}),
        FactSpec(logs["dsp_win"], keys, {"ssp_win": one}),
    ]
    per_request_max = {m: "max" for m in [*attrs, "dsp_req", "dsp_win", "imp", "clk", "ssp_win", "revenue", "cost"]}
    merged = merge_funnel(facts, ["request_id", "dsp_id"], ops=per_request_max, fill=None)
    if targets is not None:
        merged = lookup_dims(merged.withColumnRenamed("dsp_id", "_target"), [DimSpec(targets, "_target", "id", {"dsp_id": "dsp_id"}, default=None)])
    merged = merged.withColumns({"dsp_id": blank_to(F.col("dsp_id").cast("string")), "media_id": blank_to("media_id"), "posid_id": blank_to("posid_id")})
    measures = [*DEMAND_MEASURES, "dsp_win", "dsp_win_price", "imp", "revenue", "cost", "clk", "ssp_win"]
    by_source = resolve_then_rollup(
        rollup(merged, ["dsp_id", *attrs], measures), ["dsp_id", *DIMS], exchange_dims(dims), {m: "sum" for m in measures}
    )
    req_keys = _raw_dims(logs["media_req"])
    requests = logs["media_req"].groupBy("request_id").agg(
        *[F.max(c).alias(n) for n, c in req_keys.items()], F.sum(F.col("req_floor_price").try_cast("double")).alias("ssp_floor")
    )
    only = resolve_then_rollup(
        rollup(requests.withColumn("ssp_req", one), list(req_keys), ["ssp_req", "ssp_floor"]), DIMS, exchange_dims(dims),
        {"ssp_req": "sum", "ssp_floor": "sum"},
    ).withColumn("dsp_id", F.lit(NOT_APPLICABLE))
    return by_source.unionByName(only, allowMissingColumns=True)


def ad_size() -> Column:
    """``width*height`` of a response, null when either side is blank."""
    return F.when(null_if_blank("width").isNotNull() & null_if_blank("height").isNotNull(), F.concat_ws("*", "width", "height"))

