"""URL verdicts against a plain reading of the rules and of the graph."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

import pytest

from clickstrata.llm import link_trust as L
from clickstrata.llm.queries import URL_RULES

SCHEMA = "page_id bigint, url string, html string"


def parts(url):
    m = re.search(r"://([^/?#]*)([^?#]*)", url or "")
    low = lambda s: "".join(c.lower() if "A" <= c <= "Z" else c for c in s)
    return (low(m[1]), m[2]) if m else ("", "")


def plain(pages, rules, s):
    """page rows of (id, host, path, rule, verdict, trust, distrust), by dictionaries."""
    rows = []
    for pid, url, html in pages:
        host, path = parts(url)
        fit = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
        rows.append((pid, host, path, max(fit, key=lambda r: len(r.text), default=None), html or ""))
    weight = Counter()
    for _, host, _, _, html in rows:
        if host:
            for to in {"".join(c.lower() if "A" <= c <= "Z" else c for c in x) for x in re.findall(L.LINK, html)} - {host}:
                weight[host, to] += 1
    hosts = {r[1] for r in rows if r[1]} | {b for _, b in weight}
    bonds = set()
    for h in hosts:
        labels = h.split(".")
        if len(h.encode()) <= 253 and not re.fullmatch(r"[0-9.:]*", h):
            for i in range(1, len(labels) - 1):
                bonds.add((".".join(labels[i - 1 :]), ".".join(labels[i:])))
    for a, b in bonds if s.domain_weight else ():
        weight[a, b] += s.domain_weight
        weight[b, a] += s.domain_weight
    mass = {}
    for kind in ("allow", "block"):
        per, of = Counter(r[1] for r in rows if r[1]), Counter(r[1] for r in rows if r[1] and r[3] and r[3].verdict == kind)
        given = 10**9 // 100 * (100 - s.damping)
        seed = {h: given * of[h] // n for h, n in per.items() if given * of[h] // n}
        total, out = Counter(), defaultdict(list)
        for (a, b), w in weight.items():
            a, b = (a, b) if kind == "allow" else (b, a)
            total[a] += w
            out[a].append((b, w))
        m = dict(seed)
        for _ in range(s.rounds):
            new = Counter(seed)
            for a, x in m.items():
                for b, w in out[a]:
                    new[b] += x * (s.damping * 10**4 * w // total[a]) // 10**6
            m = new
        mass[kind] = m
    floor = 10**9 // 100 * (100 - s.damping) // 100 * s.floor
    result = []
    for pid, host, path, rule, _ in rows:
        t, d = mass["allow"].get(host, 0), mass["block"].get(host, 0)
        verdict = rule.verdict if rule else "block" if d > t and d >= floor else "allow"
        result.append((pid, host, path, rule.text if rule else None, verdict, t, d))
    return sorted(result, key=repr)


PAGES = [
    (1, "https://good.com/a", '<a href="https://friend.org/x">f</a> <a HREF = \'//Other.ORG:80/\'>o</a> <a href="/in">i</a>'),
    (2, "http://bad.example.com/en/1", '<a href="http://friend.org">x</a>'),
    (3, "http://www.example.com/en/1?x", ""),
    (4, "http://sub.www.example.com/en/", None),
    (5, "http://a.net/es/1#top", '<img src=//cdn.spam.org/x.png>'),
    (6, "http://a.net/fr/1", None),
    (7, "http://a.net/de/1", ""),
    (8, "http://farm.org/1", '<a href="http://a.net/es/1">1</a><a href="http://bad.example.com/en/2">2</a>'),
    (9, "http://farm.org/2", '<a href="http://a.net/">1</a>'),
    (10, "http://b.farm.org/2", '<a href="http://a.net/">1</a>'),
    (11, None, '<a href="http://a.net/">1</a>'),
    (12, "", None), (13, "no scheme", None), (14, "http://", None), (15, "http:///p", None), (16, "HTTP://UPPER.COM/En/?q#f", None),
    (17, "http://com", None), (18, "http://com/", None), (19, "http://example.com/en/x", None), (20, "http://notexample.com/en/x", None),
    (21, "http://x.net:80/es/1", None), (22, "x://y://z.com/", None), (None, "http://friend.org/", None), (None, "http://friend.org/", None),
    (1, "https://good.com/a", '<a href="https://friend.org/x">f</a>'), (1, "http://farm.org/3", None),
    (23, "http://10.0.0.1/", '<a href="http://11.0.0.1/">n</a>'), (24, "http://" + "a." * 40000 + "com/x", None), (25, "http://Ünï.org/é", "<a href='http://ünï.net/'>"),
    (26, "http://friend.org/", "x" * 300_000 + '<a href="http://a.net">'),
]


@pytest.mark.parametrize("settings", [L.Settings(rounds=3), L.Settings(rounds=3, domain_weight=0, together=5), L.Settings(rounds=0), L.Settings(rounds=4, damping=60, domain_weight=3, floor=10)])
def test_verdicts(spark, settings):
    pages = spark.createDataFrame(PAGES, SCHEMA).repartition(3)
    for name in ("host", "path", "rule", "verdict", "trust", "src", "mass", "id", "kind"):
        pages = pages.selectExpr("*", f"'mine' as {name}")
    got = sorted((tuple(r) for r in L.url_verdicts(pages, URL_RULES, settings).collect()), key=repr)
    assert got == plain(PAGES, URL_RULES, settings)


def test_farm_is_blocked_and_friend_is_not():
    rows = plain(PAGES, URL_RULES, L.Settings())
    verdict = {host: v for _, host, _, rule, v, _, _ in rows if rule is None}
    assert verdict["farm.org"] == "block" and verdict["b.farm.org"] == "block"
    assert verdict["friend.org"] == "allow" and verdict[""] == "allow"


def test_empty_table(spark):
    out = L.url_verdicts(spark.createDataFrame([], SCHEMA), URL_RULES, L.Settings(rounds=2))
    assert out.columns == ["page_id", "host", "path", "rule", "verdict", "trust", "distrust"] and out.count() == 0


def test_hot_host_and_no_rules(spark):
    rows = [(i, f"http://{'hot' if i % 3 else f'h{i % 50}'}.org/{i}", '<a href="http://hot.org/">' if i % 3 == 0 else None) for i in range(3000)]
    out = L.url_verdicts(spark.createDataFrame(rows, SCHEMA), [], L.Settings(rounds=2))
    assert {tuple(r) for r in out.select("rule", "verdict", "trust", "distrust").distinct().collect()} == {(None, "allow", 0, 0)}
    assert out.count() == 3000


def test_masses_stay_within_64_bits(spark):
    graph = spark.createDataFrame([("trust", "a", "b", 850_000)], "kind string, src string, dst string, share bigint")
    seed = spark.createDataFrame([("trust", "a", 9 * 10**18)], "kind string, host string, mass bigint")
    got = {r["host"]: r["trust"] for r in L.host_masses(graph, seed, L.Settings(rounds=1)).collect()}
    assert got["b"] == 9 * 10**18 * 850_000 // 10**6
