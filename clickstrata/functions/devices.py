"""Handset brand and browser family as rule-driven Column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .cleaning import as_col

# Ordered brand patterns; the whole lower-cased name must match and the first hit wins.
BRAND_RULES = [
    ("huawei", r".*huawei.*|.*-a[a-z]\d{2,3}|.*-tl\d{2,3}|.*-tn\d{2,3}|fig.*|vog.*|dig.*|pic.*|jer.*|sne.*|pra.*|ldn.*|are|fig.*|knt.*|ars.*|jny.*|rne.*|aqm.*|tah.*|art.*|spn.*|clt.*|jef.*|bac.*|ane.*|tas.*|lio.*|fla.*|lya.*|vog.*|pct.*|alp.*|pot.*|eml.*|mha.*|bla.*|sea.*|cdy.*|evr.*|els.*|eva.*|jsn.*|ele.*|par.*|bkl.*|pct.*|jkm.*|vtr.*|sea.*|ana.*|hma.*|vec.*|vky.*|wlz.*|hwi.*|was.*|stf.*|spn.*|ine.*|bnd.*|mar.*|vie.*|dub.*|lld.*|lon.*|glk.*|bln.*|duk.*|trt.*|vog*"),
    ("apple", r"apple|.*iphone.*|ipad.*"),
    ("oppo", r".*oppo.*|p[a-z]{2,4}\d{2,4}|r\d[a-z].*"),
    ("vivo", r".*vivo.*|v\d{2,4}[a-z]{1,3}"),
    ("honor", r".*honor.*|yal.*|col.*|hlk.*|hry.*|bmh.*|oxf.*|ebg.*|tny.*|frd.*|cor.*|rvl.*|bkk.*|lra.*|jmm.*"),
    ("xiaomi", r".*xiaomi.*|^mi .*|mi\d*.*|^mix .*|.*blackshark.*"),
    ("meizu", r"meizu|m\d+ .*|16th.*|pro.*"),
    ("samsung", r"samsung.*|sm|sm-.*"),
    ("redmi", r".*redmi.*"),
    ("oneplus", r".*oneplus.*|gm\d+"),
    ("gionee", r"gionee.*"),
    ("360", r"360.*"),
    ("meitu", r"meitu.*"),
    ("smartisan", r"smartisan.*|os\d+"),
    ("nubia", r"nubia.*"),
    ("leeco", r".*leeco.*|.*letv.*|.*lemobile.*"),
    ("lenovo", r".*lenovo.*"),
    ("hisense", r"hisense.*"),
    ("zte", r"zte.*"),
    ("nokia", r"nokia.*"),
    ("coolpad", r".*coolpad.*"),
    ("realme", r"realme.*"),
    ("motorola", r"motorola.*"),
    ("koobee", r"koobee.*"),
    ("sony", r"sony.*"),
    ("doov", r"doov.*"),
]

# Browser families, most specific token first, each with its version pattern.
BROWSER_RULES = [
    ("MicroMessenger", r"MicroMessenger/(\d+)"),
    ("Edge", r"Edge?/(\d+)"),
    ("Opera", r"(?:OPR|Opera)[/ ](\d+)"),
    ("UCBrowser", r"UCBrowser/(\d+)"),
    ("QQBrowser", r"MQQBrowser/(\d+)"),
    ("Firefox", r"Firefox/(\d+)"),
    ("Chrome", r"(?:Chrome|CriOS)/(\d+)"),
    ("Safari", r"Version/(\d+)[^ ]* (?:Mobile/\S+ )?Safari/"),
    ("IE", r"MSIE (\d+)|Trident/.*rv:(\d+)"),
    ("AppleWebKit", r"AppleWebKit/(\d+)"),
    ("Dalvik", r"Dalvik/(\d+)"),
]


def brand_of(
    producer: Column | str,
    rules: Sequence[tuple[str, str]] = BRAND_RULES,
    other: str = "other",
    when_null: str | None = None,
) -> Column:
    """Brand of a handset name by ordered whole-string rules.

    Blank text is ``other`` (an empty alternative in a rule would otherwise claim
    it for the first brand).  Null stays null unless ``when_null`` is given.
    """
    name = F.lower(F.trim(as_col(producer)))
    result = F.when(name.isNull(), F.lit(when_null)).when(name == "", F.lit(other))
    for brand, pattern in rules:
        result = result.when(name.rlike(f"^(?:{pattern})$"), F.lit(brand))
    return result.otherwise(F.lit(other))


def ua_browser(ua: Column | str, rules: Sequence[tuple[str, str]] = BROWSER_RULES) -> Column:
    """Browser family followed by its major version; '' for a blank or unknown agent."""
    ua = as_col(ua)
    result = F.when(ua.isNull() | (ua == ""), F.lit(""))
    for family, pattern in rules:
        groups = pattern.count("(") - pattern.count("(?:")
        version = F.concat(*[F.coalesce(F.regexp_extract(ua, pattern, i + 1), F.lit("")) for i in range(groups)])
        result = result.when(ua.rlike(pattern), F.concat(F.lit(family), version))
    return result.otherwise(F.lit(""))


def url_decode(c: Column | str) -> Column:
    """Percent-decoding; null instead of an error for broken escapes."""
    return F.try_url_decode(as_col(c))
