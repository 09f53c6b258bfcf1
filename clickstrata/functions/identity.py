"""Device identifiers and IP addresses as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .cleaning import OCTET, as_col, is_blank, valid_ipv4

# Placeholder ids and operating-system codes found in the logs.
ZERO_IMEI = "000000000000000"
ZERO_UUID = "00000000-0000-0000-0000-000000000000"
OS_ANDROID = "1"
OS_IOS = "2"
ID_TYPE_IMEI, ID_TYPE_IDFA, ID_TYPE_OAID = 1, 2, 3
MD5_LENGTH = 32


def _usable(c: Column, dummy: str | None = None) -> Column:
    ok = c.isNotNull() & (c != "")
    return ok & (c != dummy) if dummy else ok


def to_md5(c: Column | str) -> Column:
    """The value itself when it is already 32 characters long, else its md5."""
    c = as_col(c)
    return F.when(F.length(c) == MD5_LENGTH, c).otherwise(F.md5(c))


def plain_and_md5(c: Column | str, upper: bool = False) -> tuple[Column, Column]:
    """(plain value or null when only the hash is known, md5)."""
    c = as_col(c)
    hashed = to_md5(c)
    return F.when(F.length(c) != MD5_LENGTH, c), F.upper(hashed) if upper else hashed


def canonical_device_id(os: str, imei: str, idfa: str, oaid: str) -> Column:
    """One md5 id per device: imei, else oaid, on Android; idfa on iOS; otherwise null."""
    os_, imei_, idfa_, oaid_ = map(as_col, (os, imei, idfa, oaid))
    android = F.when(_usable(imei_, ZERO_IMEI), to_md5(imei_)).when(_usable(oaid_, ZERO_UUID), to_md5(oaid_))
    ios = F.when(_usable(idfa_), to_md5(idfa_))
    return F.when(os_ == OS_ANDROID, android).when(os_ == OS_IOS, ios)


def device_id_type(os: str, imei: str) -> Column:
    """1 imei, 3 oaid (Android without an imei), 2 anything else."""
    os_, imei_ = as_col(os), as_col(imei)
    android = F.when(_usable(imei_, ZERO_IMEI), F.lit(ID_TYPE_IMEI)).otherwise(F.lit(ID_TYPE_OAID))
    return F.when(os_ == OS_ANDROID, android).otherwise(F.lit(ID_TYPE_IDFA))


def ip_prefix_hex(ip: Column | str, octets: int = 3) -> Column:
    """Leading octets in hex, two digits each, so that prefixes stay unambiguous.

    ``117.157.198.7`` → ``759dc6``; null when those octets are malformed.
    """
    ip = as_col(ip)
    digits = [F.split_part(ip, F.lit("."), F.lit(i + 1)).try_cast("int") for i in range(octets)]
    text = F.concat(*[F.lpad(F.lower(F.hex(d)), 2, "0") for d in digits])
    return F.when(ip.rlike("^" + OCTET + r"(\." + OCTET + f"){{{octets - 1}}}" + r"\."), text)


def ip_to_long(ip: Column | str) -> Column:
    """Dotted quad → unsigned 32-bit number as bigint; null when malformed."""
    ip = as_col(ip)
    number = F.aggregate(F.split(ip, r"\."), F.lit(0).cast("bigint"), lambda n, part: n * 256 + part.try_cast("bigint"))
    return F.when(valid_ipv4(ip), number)


def concat_ids(*cols: str) -> Column:
    """Ids glued together with nulls read as empty text."""
    return F.concat(*[F.coalesce(as_col(c), F.lit("")) for c in cols])


def anonymous_visitor_id(os: str, android_id: str, idfa: str, cookie: str) -> Column:
    """App visitors (os 1 or 2) by android id, else idfa; everyone else by cookie."""
    app_id = F.when(~is_blank(android_id), as_col(android_id)).otherwise(as_col(idfa))
    return F.when(as_col(os).isin("1", "2"), app_id).otherwise(as_col(cookie))
