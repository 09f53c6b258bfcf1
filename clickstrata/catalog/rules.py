"""Anti-cheat rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.identity import ZERO_IMEI, ZERO_UUID
from ..operators import rules as H
from .registry import Tables, query
from .stand_ins import DEVICE_CTE, EVENTS_CTE, device_log, events


@query("heavy_hitters", f"WITH {EVENTS_CTE} SELECT CAST(user_id AS VARCHAR) AS id, count(*) AS cnt FROM ev WHERE user_id <> 7 GROUP BY user_id HAVING count(*) >= 70")
def _(t: Tables):
    return H.heavy_hitters(events(t).select(F.col("user_id").cast("string").alias("id")), "id", 70, exclude=["7"])


@query("heavy_hitters_by_length", f"WITH {DEVICE_CTE} SELECT imei, count(*) AS cnt FROM dv WHERE imei <> '000000000000000' AND length(imei) = 15 GROUP BY imei HAVING count(*) >= 60")
def _(t: Tables):
    return H.heavy_hitters(device_log(t), "imei", 60, exclude=[ZERO_IMEI], length=15)


@query("unpivot_ids", f"WITH {DEVICE_CTE} SELECT event_id, 'imei' AS kind, imei AS value FROM dv UNION ALL SELECT event_id, 'idfa', idfa FROM dv UNION ALL SELECT event_id, 'oaid', oaid FROM dv")
def _(t: Tables):
    return H.unpivot_ids(device_log(t), {"imei": "imei", "idfa": "idfa", "oaid": "oaid"}, keep=["event_id"])


LIMITS = {"imei": 25, "idfa": 25, "ip": 2, "anid": 25, "ip3": 2}


@query("cheat_list", f"""WITH {DEVICE_CTE}, u AS (SELECT event_type = 'error' AS f, unnest(['imei', 'idfa', 'ip', 'anid', 'ip3']) AS kind,
  unnest([imei, idfa, ip, android_id, printf('%02x%02x%02x', user_id % 200 + 1, k % 256, user_id * 7 % 256)]) AS value FROM dv),
g AS (SELECT kind, value, f, count(*) AS n FROM u WHERE value IS NOT NULL AND value <> '' AND value <> 'unknown' AND NOT regexp_full_match(value, '[0-]*') GROUP BY ALL)
SELECT kind, value, max(n) AS cnt FROM g WHERE n > CASE kind WHEN 'ip' THEN 2 WHEN 'ip3' THEN 2 ELSE 25 END GROUP BY kind, value""")
def _(t: Tables):
    log = device_log(t)
    return H.cheat_list([("request", log.where("event_type <> 'error'")), ("filtered", log.where("event_type = 'error'"))], LIMITS)


@query("device_id_export", f"""WITH {DEVICE_CTE}, u AS (SELECT unnest(['imei', 'idfa', 'oaid']) AS kind, unnest([imei, idfa, oaid]) AS v FROM dv)
SELECT DISTINCT kind, CASE WHEN length(v) = 32 THEN v ELSE md5(v) END AS id FROM u WHERE v <> '' AND NOT (kind = 'imei' AND v = '000000000000000') AND NOT (kind = 'oaid' AND v = '00000000-0000-0000-0000-000000000000')""")
def _(t: Tables):
    kinds = {"imei": "imei", "idfa": "idfa", "oaid": "oaid"}
    return H.device_id_export(device_log(t), kinds, dummy=None, dummies={"imei": ZERO_IMEI, "oaid": ZERO_UUID})


@query("device_id_export_hours", f"""WITH {DEVICE_CTE}, u AS (SELECT unnest(['IMEI', 'IDFA']) AS kind, unnest([imei, idfa]) AS v FROM dv WHERE day = '2024-01-09' AND hour BETWEEN '03' AND '05' AND app_id NOT IN ('2'))
SELECT DISTINCT kind, md5(v) AS id FROM u WHERE v <> '' AND v NOT LIKE '%00000000000000%'""")
def _(t: Tables):
    from ..functions.cleaning import exclude_values
    from ..sources.scans import read_hour_range

    log = exclude_values(read_hour_range(device_log(t), "2024-01-09", "03", "05", "day", "hour"), "app_id", ["2"])
    return H.device_id_export(log, {"IMEI": "imei", "IDFA": "idfa"}, rehash=True)
