"""URL filters: the longest rule that fits, else trust and distrust carried over the graph of hosts.

Rules name a host and the beginning of a path.  Pages that no rule fits are judged by their host:
personalised PageRank spreads trust from hosts with allowed pages along links, and distrust from
hosts with blocked pages against the links, so that who links to a blocked host inherits it.

All sums are of whole numbers, so reruns agree to the last digit whatever the order of rows.
Only built-in functions are used; the graph is one row per pair of hosts, counted before the shuffle,
so a host with a third of all pages is a few rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickstrata.llm.common import stored

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Host and path of a URL; the first "://" counts.
URL_PARTS = r"://([^/?#]*)([^?#]*)"
#: The host of a link to another site in a page's markup.
LINK = r"""(?:[Hh][Rr][Ee][Ff]|[Ss][Rr][Cc])[\x20\x09-\x0D]*=[\x20\x09-\x0D]*["']?[\x20\x09-\x0D]*(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#"'<>\x20\x09-\x0D]+)"""
#: Longer names are no domains (RFC 1035), nor are addresses: they have no parent domain.
NAME_LENGTH = 253
ADDRESS = r"^[0-9.:]*$"
#: Mass of a host all of whose pages are allowed (or blocked), and parts that shares are told in.
UNIT, PARTS = 10**9, 10**6


@dataclass(frozen=True)
class Rule:
    """``verdict`` for the pages of ``host`` and its subdomains whose path starts with ``path``."""

    verdict: str
    host: str
    path: str = "/"

    @property
    def text(self) -> str:
        return self.host + self.path


@dataclass(frozen=True)
class Settings:
    """``damping``: percent of a host's mass that goes on; ``rounds`` of it.  ``domain_weight``: links that
    stand for the bond between a host and its parent domain, each way (0: none).  ``floor``: a host is
    blocked when its distrust exceeds its trust and reaches this percent of what a wholly blocked host
    without links has.  ``together``: rounds computed in one job before a table is written."""

    damping: int = 85
    rounds: int = 8
    domain_weight: int = 1
    floor: int = 50
    together: int = 2


def lowered(c: Column) -> Column:
    """A-Z to a-z, other letters as they are."""
    return F.translate(c, UPPER, LOWER)


def with_rule(pages: DataFrame, rules: Sequence[Rule], url: str = "url") -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` and ``rule_verdict``; a null URL or one without "://" has an empty host and path.

    Of several rules that fit the longest wins; the rules are a list in the program, tried in that order.
    """
    def fits(r: Rule) -> Column:
        return ((F.col("host") == r.host) | F.endswith("host", F.lit("." + r.host))) & F.startswith("path", F.lit(r.path))

    ordered = sorted(rules, key=lambda r: (len(r.text), len(r.host)), reverse=True)
    part = lambda i: F.coalesce(F.regexp_extract(url, URL_PARTS, i), F.lit(""))
    rows = pages.withColumns({"host": lowered(part(1)), "path": part(2)})
    pick = lambda value: F.coalesce(*[F.when(fits(r), value(r)) for r in ordered], F.lit(None).cast("string"))
    return rows.withColumns({"rule": pick(lambda r: r.text), "rule_verdict": pick(lambda r: r.verdict)})


def host_links(pages: DataFrame, html: str = "html") -> DataFrame:
    """``src, dst, w``: on how many pages of one host another one is linked."""
    linked = F.when(F.contains(html, F.lit("//")), F.array_distinct(F.transform(F.regexp_extract_all(html, F.lit(LINK), F.lit(1)), lowered)))
    pairs = pages.where("host <> ''").select(F.col("host").alias("src"), F.explode(linked).alias("dst"))
    return pairs.where("src <> dst").groupBy("src", "dst").agg(F.count(F.lit(1)).alias("w"))


def domain_links(hosts: DataFrame, weight: int) -> DataFrame:
    """``src, dst, w`` from each host to its parent domain, from that to its own, and back; a last label alone is no domain."""
    names = hosts.where((F.octet_length("host") <= NAME_LENGTH) & ~F.rlike("host", F.lit(ADDRESS))).select(F.split("host", r"\.").alias("labels"))
    names = names.where(F.size("labels") >= 3)
    steps = names.select("labels", F.explode(F.sequence(F.lit(1), F.size("labels") - 2)).alias("i"))
    tail = lambda i: F.array_join(F.slice("labels", i, F.size("labels")), ".")
    pairs = steps.select(tail(F.col("i")).alias("a"), tail(F.col("i") + 1).alias("b")).distinct()
    return pairs.select(F.inline(F.array(
        F.struct(F.col("a").alias("src"), F.col("b").alias("dst"), F.lit(weight).cast("bigint").alias("w")),
        F.struct(F.col("b").alias("src"), F.col("a").alias("dst"), F.lit(weight).cast("bigint").alias("w")),
    )))


def host_graph(pages: DataFrame, settings: Settings, html: str = "html") -> DataFrame:
    """``kind, src, dst, share``: how many of ``PARTS`` of a host's trust (along a link) or distrust (against it) goes to another."""
    links = stored(host_links(pages, html), "host-links")
    if settings.domain_weight:
        hosts = pages.where("host <> ''").select("host").union(links.select("dst")).distinct()
        links = links.union(domain_links(hosts, settings.domain_weight))
    both = links.select(F.inline(F.array(
        F.struct(F.lit("trust").alias("kind"), F.col("src"), F.col("dst"), F.col("w")),
        F.struct(F.lit("distrust").alias("kind"), F.col("dst").alias("src"), F.col("src").alias("dst"), F.col("w")),
    )))
    edges = both.groupBy("kind", "src", "dst").agg(F.sum("w").alias("w"))
    out = edges.groupBy("kind", "src").agg(F.sum("w").alias("total"))
    per_link = F.expr(f"({settings.damping * (PARTS // 100)} * w) div total")
    return stored(edges.join(out, ["kind", "src"]).select("kind", "src", "dst", per_link.alias("share")), "host-graph")


def seeds(pages: DataFrame, settings: Settings) -> DataFrame:
    """``kind, host, mass`` that hosts are given anew each round: their part of pages that rules allow or block."""
    counts = pages.where("host <> ''").groupBy("host").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("rule_verdict") == "allow").alias("allowed"), F.count_if(F.col("rule_verdict") == "block").alias("blocked"),
    )
    given = UNIT // 100 * (100 - settings.damping)
    both = counts.select("host", F.inline(F.array(
        F.struct(F.lit("trust").alias("kind"), F.expr(f"({given} * allowed) div n").alias("mass")),
        F.struct(F.lit("distrust").alias("kind"), F.expr(f"({given} * blocked) div n").alias("mass")),
    )))
    return stored(both.where("mass > 0").select("kind", "host", "mass"), "host-seeds")


def host_masses(graph: DataFrame, seed: DataFrame, settings: Settings) -> DataFrame:
    """``host, trust, distrust`` after the rounds; hosts that nothing reaches are absent."""
    # floor(mass * share / PARTS) without leaving 64 bits
    passed = F.expr(f"(mass div {PARTS}) * share + ((mass % {PARTS}) * share) div {PARTS}")
    mass = seed
    for i in range(1, settings.rounds + 1):
        at = mass.select("kind", F.col("host").alias("src"), "mass")
        moved = graph.join(at, ["kind", "src"]).select("kind", F.col("dst").alias("host"), passed.alias("mass"))
        mass = moved.union(seed).groupBy("kind", "host").agg(F.sum("mass").alias("mass"))
        if i % settings.together == 0 or i == settings.rounds:
            mass = stored(mass, "host-mass")
    of = lambda kind: F.sum(F.when(F.col("kind") == kind, F.col("mass")).otherwise(0)).alias(kind)
    return mass.groupBy("host").agg(of("trust"), of("distrust"))


def url_verdicts(pages: DataFrame, rules: Sequence[Rule], settings: Settings = Settings(), id_col: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """One row per page: ``id_col, host, path, rule, verdict, trust, distrust``.

    ``verdict`` is the rule's, else "block" if the host's distrust exceeds its trust and reaches the floor,
    else "allow"; so pages without a host, and hosts that neither trust nor distrust reaches, are allowed.
    Null markup has no links.  Rows that repeat an identifier, or have none, are judged each by its own URL.
    Other columns are left out.
    """
    own = pages.select(F.col(id_col).alias("id"), F.col(url).alias("url"), F.col(html).alias("html"))
    rows = with_rule(own, rules)
    masses = host_masses(host_graph(rows, settings), seeds(rows, settings), settings)
    floor = UNIT // 100 * (100 - settings.damping) // 100 * settings.floor
    trust, distrust = (F.coalesce(F.col(c), F.lit(0).cast("bigint")) for c in ("trust", "distrust"))
    verdict = F.coalesce("rule_verdict", F.when((distrust > trust) & (distrust >= floor), "block").otherwise("allow"))
    out = rows.drop("html", "url").join(masses, "host", "left")
    return out.select(F.col("id").alias(id_col), "host", "path", "rule", verdict.alias("verdict"), trust.alias("trust"), distrust.alias("distrust"))


def duckdb_sql(rules: Sequence[Rule], settings: Settings = Settings()) -> str:
    """The same over the table ``pages``, round by round."""
    quoted = LINK.replace("'", "''")
    low = lambda c: f"translate({c}, '{UPPER}', '{LOWER}')"
    values = ", ".join(f"('{r.verdict}', '{r.host}', '{r.path}')" for r in rules)
    given, per = UNIT // 100 * (100 - settings.damping), settings.damping * (PARTS // 100)
    rounds = []
    for i in range(1, settings.rounds + 1):
        before = "seed" if i == 1 else f"m{i - 1}"
        rounds.append(f"""m{i} AS MATERIALIZED (SELECT kind, host, CAST(sum(mass) AS BIGINT) AS mass FROM (
  SELECT g.kind, g.dst AS host, (m.mass * CAST(g.share AS HUGEINT)) // {PARTS} AS mass FROM graph g JOIN {before} m ON g.kind = m.kind AND g.src = m.host
  UNION ALL SELECT kind, host, mass FROM seed) GROUP BY kind, host)""")
    return f"""WITH parts AS (SELECT page_id, html, coalesce({low(f"regexp_extract(url, '{URL_PARTS}', 1)")}, '') AS host, coalesce(regexp_extract(url, '{URL_PARTS}', 2), '') AS path FROM pages),
rl(verdict, rhost, rpath) AS (VALUES {values}),
fit AS (SELECT p.host, p.path, arg_max(rhost || rpath, (length(rhost || rpath), length(rhost))) AS rule, arg_max(verdict, (length(rhost || rpath), length(rhost))) AS rv
  FROM (SELECT DISTINCT host, path FROM parts) p JOIN rl ON (p.host = rhost OR ends_with(p.host, '.' || rhost)) AND starts_with(p.path, rpath) GROUP BY 1, 2),
pg AS MATERIALIZED (SELECT p.*, rule, rv FROM parts p LEFT JOIN fit f ON p.host = f.host AND p.path = f.path),
lk AS MATERIALIZED (SELECT host AS src, dst, count(*) AS w FROM (SELECT host, unnest(list_distinct(list_transform(regexp_extract_all(html, '{quoted}', 1), lambda x: {low('x')}))) AS dst FROM pg WHERE host <> '' AND contains(html, '//')) WHERE host <> dst GROUP BY 1, 2),
hosts AS (SELECT host FROM pg WHERE host <> '' UNION SELECT dst FROM lk),
lab AS (SELECT string_split(host, '.') AS l FROM hosts WHERE strlen(host) <= {NAME_LENGTH} AND NOT regexp_matches(host, '{ADDRESS}')),
dom AS (SELECT DISTINCT array_to_string(l[i:], '.') AS a, array_to_string(l[i + 1:], '.') AS b FROM (SELECT l, unnest(range(1, len(l) - 1)) AS i FROM lab WHERE len(l) >= 3)),
links AS (SELECT src, dst, w FROM lk UNION ALL SELECT a, b, {settings.domain_weight} FROM dom UNION ALL SELECT b, a, {settings.domain_weight} FROM dom),
edges AS (SELECT kind, src, dst, sum(w) AS w FROM (SELECT 'trust' AS kind, src, dst, w FROM links UNION ALL SELECT 'distrust', dst, src, w FROM links) GROUP BY 1, 2, 3),
graph AS MATERIALIZED (SELECT kind, src, dst, ({per} * w) // sum(w) OVER (PARTITION BY kind, src) AS share FROM edges),
cnt AS (SELECT host, count(*) AS n, count(*) FILTER (WHERE rv = 'allow') AS allowed, count(*) FILTER (WHERE rv = 'block') AS blocked FROM pg WHERE host <> '' GROUP BY host),
seed AS MATERIALIZED (SELECT * FROM (SELECT 'trust' AS kind, host, {given} * allowed // n AS mass FROM cnt UNION ALL SELECT 'distrust', host, {given} * blocked // n FROM cnt) WHERE mass > 0),
{', '.join(rounds)},
fin AS (SELECT host, CAST(coalesce(sum(mass) FILTER (WHERE kind = 'trust'), 0) AS BIGINT) AS trust, CAST(coalesce(sum(mass) FILTER (WHERE kind = 'distrust'), 0) AS BIGINT) AS distrust FROM m{settings.rounds} GROUP BY host)
SELECT page_id, p.host, path, rule, coalesce(rv, CASE WHEN coalesce(distrust, 0) > coalesce(trust, 0) AND distrust >= {given // 100 * settings.floor} THEN 'block' ELSE 'allow' END) AS verdict,
  coalesce(trust, 0) AS trust, coalesce(distrust, 0) AS distrust FROM pg p LEFT JOIN fin f ON p.host = f.host"""
