"""Column expressions against hand-checked values."""

from __future__ import annotations

import hashlib

import pytest
from pyspark.sql import functions as F

from clickstrata.operators.features import modes
from clickstrata.functions import aggregates as A
from clickstrata.functions import cleaning as C
from clickstrata.functions import devices as D
from clickstrata.functions import identity as I
from clickstrata.functions import requests as Q


def one(spark, value, fn, type_="string"):
    return spark.createDataFrame([(value,)], f"v {type_}").select(fn("v").alias("o")).first().o


def md5(s):
    return hashlib.md5(s.encode()).hexdigest()


@pytest.mark.parametrize("name,brand", [
    ("HUAWEI P30", "huawei"), ("iPhone 11", "apple"), ("Redmi Note", "redmi"), ("m2 note", "meizu"), ("GREE", "other"), ("", "other"), (None, None),
    ("  OPPO R9  ", "oppo"), ("vivo x9", "vivo"), ("mi 8", "xiaomi"), ("SM-G9500", "samsung"), ("gm1910", "oneplus"), ("xx-al20", "huawei"),
])
def test_brand(spark, name, brand):
    assert one(spark, name, D.brand_of) == brand


def test_brand_defaults(spark):
    assert one(spark, None, lambda c: D.brand_of(c, when_null="unknown")) == "unknown"
    assert one(spark, "gree", lambda c: D.brand_of(c, other="unknown")) == "unknown"


@pytest.mark.parametrize("ua,browser", [
    (None, ""), ("", ""), ("Mozilla/5.0 (X11) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/90.0.1 Safari/537.36", "Chrome90"),
    ("Mozilla/5.0 (Windows NT 6.1; Trident/7.0; rv:11.0) like Gecko", "IE11"), ("Dalvik/2.1.0 (Linux; U; Android 10)", "Dalvik2"),
    ("Mozilla/5.0 (iPhone) AppleWebKit/605.1.15 Version/13.1 Mobile/15E148 Safari/604.1", "Safari13"),
    ("Mozilla/5.0 (iPhone; CPU iPhone OS 13_6_1 like Mac OS X) AppleWebKit/605.1.15 (KHTML, like Gecko) Mobile/15E148", "AppleWebKit605"), ("curl", ""),
])
def test_browser(spark, ua, browser):
    assert one(spark, ua, D.ua_browser) == browser


def test_url_decode(spark):
    assert one(spark, "a%20b%2Fc", D.url_decode) == "a b/c"
    assert one(spark, "bad%zz", D.url_decode) is None


@pytest.mark.parametrize("ip,prefix", [("117.157.198.7", "759dc6"), ("1.17.0.9", "011100"), ("17.1.0.9", "110100"), ("300.1.1.1", None), ("1.2", None), (None, None)])
def test_ip_prefix(spark, ip, prefix):
    assert one(spark, ip, I.ip_prefix_hex) == prefix


@pytest.mark.parametrize("ip,n", [("0.0.0.0", 0), ("1.2.3.4", 16909060), ("255.255.255.255", 4294967295), ("256.1.1.1", None), ("1.2.3", None), ("a.b.c.d", None), (None, None)])
def test_ip_number(spark, ip, n):
    assert one(spark, ip, I.ip_to_long) == n


@pytest.mark.parametrize("v,ok", [("x1", True), ("", False), (None, False), ("\\N", False), ("0000-00", False), ("unknown", False), ("没有权限", False)])
def test_valid_device_value(spark, v, ok):
    assert one(spark, v, C.valid_device_value) is ok


def test_valid_device_value_wider_dummy(spark):
    assert one(spark, "02:00:00:00:00:00", lambda c: C.valid_device_value(c, "^[0:2-]*$")) is False


def test_canonical_ids(spark):
    df = spark.createDataFrame([
        ("1", "000000000000000", "i", "ab-1"), ("1", "861234567890123", "i", "o"), ("1", "", None, "00000000-0000-0000-0000-000000000000"),
        ("2", "x", "IDFA", "o"), ("2", "x", "", "o"), ("3", "x", "i", "o"), ("1", md5("q"), "i", "o"),
    ], "os string, imei string, idfa string, oaid string")
    got = [tuple(r) for r in df.select(I.canonical_device_id("os", "imei", "idfa", "oaid"), I.device_id_type("os", "imei")).collect()]
    assert got == [(md5("ab-1"), 3), (md5("861234567890123"), 1), (None, 3), (md5("IDFA"), 2), (None, 2), (None, 2), (md5("q"), 1)]


def test_visitor_id(spark):
    df = spark.createDataFrame([("1", "an", "if", "ck"), ("2", "", "if", "ck"), ("3", "an", "if", "ck")], "os string, a string, i string, c string")
    assert [r.v for r in df.select(I.anonymous_visitor_id("os", "a", "i", "c").alias("v")).collect()] == ["an", "if", "ck"]


@pytest.mark.parametrize("line,uri", [
    ("GET /vip12.html HTTP/1.1", "/vip12"), ("GET /api/v1/sa?x=1 HTTP/1.1", "/api/v1/sa"), ("bad", None), ("GET  /a?b=1   HTTP/1.1", "/a?b=1"), ("GET /vip HTTP/1.1", "/vip"),
])
def test_uri(spark, line, uri):
    assert one(spark, line, Q.normalize_uri) == uri


def test_query_map_last_value_wins_and_bare_words_drop(spark):
    line = "GET /api/v1/sa?act=call&domain=a.com&act=clk&x&y=1=2&z= HTTP/1.1"
    assert one(spark, line, Q.request_query) == {"domain": "a.com", "act": "clk", "z": ""}
    text = "act=call&domain=a.com&act=clk&x&y=1=2&z=&xact=9&act=7=8"
    for name, value in {"act": "clk", "domain": "a.com", "x": None, "y": None, "z": "", "none": None, "xact": "9"}.items():
        assert one(spark, text, lambda c: Q.query_param(c, name)) == value
    assert one(spark, "GET /plain HTTP/1.1", Q.request_query) is None


def test_creative_image(spark):
    js = '{"img":[{"url":"http://i/1.jpg"}]}'
    assert one(spark, js, lambda c: Q.creative_image_url(c, F.lit(3))) == "http://i/1.jpg"
    assert one(spark, '{"imgurl":"http:\\/\\/o"}', lambda c: Q.creative_image_url(c, F.lit(1))) == "http://o"
    assert one(spark, "not json", lambda c: Q.creative_image_url(c, F.lit(3))) is None


def test_dims_coords_buckets(spark):
    assert [one(spark, "640x320", lambda c, i=i: C.split_dims(c)[i]) for i in (0, 1)] == ["640", "320"]
    assert one(spark, "640", lambda c: C.split_dims(c)[0]) is None
    assert one(spark, "640*320", lambda c: C.split_dims(c, "*")[1]) == "320"
    assert one(spark, "121.47", C.truncate_coord) == "121" and one(spark, "121", C.truncate_coord) == "121"
    assert one(spark, "-0.5", C.floor_coord) == -1
    assert one(spark, 1626926499, lambda c: C.utc_bucket(c, "hour"), "bigint") == 1626926400
    assert one(spark, 1626926499, lambda c: C.utc_bucket(c, "day"), "bigint") == 1626912000


def test_mode_ties_and_blanks(spark):
    names = ["lihua", "zhangsan", "lihua", "wangwu", "wangwu", ""]
    assert modes(spark.createDataFrame([(n,) for n in names], "v string"), [], ["v"]).first().v == "lihua"
    assert modes(spark.createDataFrame([("",), (None,)], "v string"), [], ["v"]).first().v == ""


def test_ratio_and_rounding(spark):
    df = spark.createDataFrame([(1.0, 0.0), (None, 1.0), (1.0, 4.0)], "a double, b double")
    assert [r[0] for r in df.select(A.ratio(F.col("a"), F.col("b"))).collect()] == [None, None, 0.25]
    assert one(spark, 115311.22499999999, lambda c: A.round_places(F.col(c), 2), "double") == 115311.23
