"""License scans: ordered signature rules behind a keyword prefilter, with built-in functions only.

A text's words are numbered once, as in ``" mit:4  license:5 "``, so that a rule is one
regular expression and every match carries its place.  A word owns the
space on either side of it, which lets adjacent matches stand next to each other.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Phrases of the base scan and their labels.
BASE = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}

# Names of licenses.  A blank stands between words, punctuation is
# none: "GPL-3.0" reads "gpl 3 0".  Label, a literal that every match holds, name.
FAMILIES = [
    ("gpl-2.0", "2", r"(?:gnu )?(?:gpl|general public license)(?: version)? v?2(?: 0)?(?: only| or later)?"),
    ("gpl-3.0", "3", r"(?:gnu )?(?:gpl|general public license)(?: version)? v?3(?: 0)?(?: only| or later)?"),
    ("gpl-2.0", "gplv2", r"(?:gnu )?gplv2"),
    ("gpl-3.0", "gplv3", r"(?:gnu )?gplv3"),
    ("gpl", "general public licen", r"(?:gnu )?general public licen[cs]e"),
    ("gpl", "gpl", r"(?:gnu )?gpl licen[cs]e"),
    ("lgpl-2.1", "2 1", r"(?:gnu )?(?:lgpl|lesser general public license)(?: version)? v?2 1(?: only| or later)?"),
    ("lgpl-3.0", "3", r"(?:gnu )?(?:lgpl|lesser general public license)(?: version)? v?3(?: 0)?(?: only| or later)?"),
    ("lgpl", "lesser general public licen", r"(?:gnu )?lesser general public licen[cs]e"),
    ("lgpl", "library general public licen", r"(?:gnu )?library general public licen[cs]e"),
    ("lgpl", "lgpl", r"(?:gnu )?lgpl(?: licen[cs]e)?"),
    ("agpl-3.0", "3", r"(?:gnu )?(?:agpl|affero general public license)(?: version)? v?3(?: 0)?(?: only| or later)?"),
    ("agpl", "affero general public licen", r"(?:gnu )?affero general public licen[cs]e"),
    ("agpl", "agpl", r"(?:gnu )?agpl(?: licen[cs]e)?"),
    ("gfdl", "free documentation licen", r"(?:gnu )?free documentation licen[cs]e"),
    ("apache-2.0", "2", r"apache(?: software)?(?: licen[cs]e)?(?: version)? v?2(?: 0)?(?: licen[cs]e)?"),
    ("apache-1.1", "1 1", r"apache(?: software)? licen[cs]e(?: version)? v?1 1"),
    ("apache", "apache", r"apache(?: software)? licen[cs]e"),
    ("mit", "mit licen", r"mit licen[cs]e"),
    ("mit-0", "mit", r"mit (?:0|no attribution)(?: licen[cs]e)?"),
    ("x11", "x11", r"x11 licen[cs]e"),
    ("bsd-2-clause", "bsd", r"(?:simplified bsd|bsd (?:2|two) clause|(?:2|two) clause bsd)(?: licen[cs]e)?"),
    ("bsd-3-clause", "bsd", r"(?:(?:new|revised|modified) bsd|bsd (?:3|three) clause|(?:3|three) clause bsd)(?: licen[cs]e)?"),
    ("bsd-4-clause", "bsd", r"(?:original bsd|bsd (?:4|four) clause|(?:4|four) clause bsd)(?: licen[cs]e)?"),
    ("0bsd", "bsd", r"(?:0bsd|zero clause bsd)(?: licen[cs]e)?"),
    ("bsd", "bsd", r"bsd(?: style)? licen[cs]e"),
    ("isc", "isc licen", r"isc licen[cs]e"),
    ("zlib", "zlib", r"zlib(?: libpng)? licen[cs]e"),
    ("mpl-1.1", "1 1", r"(?:mpl|mozilla public license)(?: version)? v?1 1"),
    ("mpl-2.0", "2", r"(?:mpl|mozilla public license)(?: version)? v?2(?: 0)?"),
    ("mpl", "mozilla public licen", r"mozilla public licen[cs]e"),
    ("epl-1.0", "1", r"(?:epl|eclipse public license)(?: version)? v?1(?: 0)?"),
    ("epl-2.0", "2", r"(?:epl|eclipse public license)(?: version)? v?2(?: 0)?"),
    ("epl", "eclipse public licen", r"eclipse public licen[cs]e"),
    ("cddl-1.0", "cddl", r"cddl(?: version)? v?1(?: 0)?"),
    ("cddl", "common development and distribution licen", r"common development and distribution licen[cs]e"),
    ("eupl-1.2", "1 2", r"(?:eupl|european union public license)(?: version)? v?1 2"),
    ("eupl", "european union public licen", r"european union public licen[cs]e"),
    ("bsl-1.0", "boost", r"boost software licen[cs]e(?:(?: version)? v?1(?: 0)?)?"),
    ("artistic-2.0", "artistic", r"artistic licen[cs]e(?: version)? v?2(?: 0)?"),
    ("artistic", "artistic licen", r"artistic licen[cs]e"),
    ("unlicense", "unlicense", r"(?:the )?unlicense(?: license)?"),
    ("wtfpl", "wtfpl", r"wtfpl(?: licen[cs]e)?"),
    ("ofl-1.1", "open font licen", r"(?:sil )?open font licen[cs]e(?:(?: version)? v?1 1)?"),
    ("psf-2.0", "python software foundation licen", r"python software foundation licen[cs]e(?:(?: version)? v?2(?: 0)?)?"),
    ("openssl", "openssl licen", r"openssl licen[cs]e"),
    ("php-3.01", "php licen", r"php licen[cs]e(?:(?: version)? v?3 01)?"),
    ("ruby", "ruby licen", r"ruby licen[cs]e"),
    ("postgresql", "postgresql licen", r"postgresql licen[cs]e"),
    ("ms-pl", "microsoft public licen", r"microsoft public licen[cs]e"),
    ("ms-rl", "microsoft reciprocal licen", r"microsoft reciprocal licen[cs]e"),
    ("odbl-1.0", "open database licen", r"open database licen[cs]e(?:(?: version)? v?1(?: 0)?)?"),
    ("odc-by-1.0", "open data commons attribution", r"open data commons attribution(?: licen[cs]e)?"),
    ("pddl-1.0", "public domain dedication and licen", r"public domain dedication and licen[cs]e"),
    ("sspl-1.0", "server side public licen", r"server side public licen[cs]e"),
    ("busl-1.1", "business source licen", r"business source licen[cs]e(?:(?: version)? v?1 1)?"),
    ("elastic-2.0", "elastic licen", r"elastic licen[cs]e(?:(?: version)? v?2(?: 0)?)?"),
    ("open-rail", "rail", r"(?:creativeml )?open ?rail(?: m)?(?: licen[cs]e)?"),
    ("cc0-1.0", "cc0", r"cc0(?: 1 0)?(?: universal)?"),
    ("cc-by-nc-nd", "by nc nd", r"cc by nc nd(?: [1-4] [05])?"),
    ("cc-by-nc-sa", "by nc sa", r"cc by nc sa(?: [1-4] [05])?"),
    ("cc-by-nc", "by nc", r"cc by nc(?: [1-4] [05])?"),
    ("cc-by-nd", "by nd", r"cc by nd(?: [1-4] [05])?"),
    ("cc-by-sa", "by sa", r"cc by sa(?: [1-4] [05])?"),
    ("cc-by", "cc by", r"cc by(?: [1-4] [05])?"),
    ("cc-by-nc-nd", "noncommercial", r"(?:creative commons )?attribution noncommercial noderiv(?:ative)?s(?: [1-4] [05])?"),
    ("cc-by-nc-sa", "noncommercial", r"(?:creative commons )?attribution noncommercial sharealike(?: [1-4] [05])?"),
    ("cc-by-nc", "noncommercial", r"(?:creative commons )?attribution noncommercial(?: [1-4] [05])?"),
    ("cc-by-sa", "sharealike", r"(?:creative commons )?attribution sharealike(?: [1-4] [05])?"),
    ("cc-by", "creative commons attribution", r"creative commons attribution(?: licen[cs]e)?(?: [1-4] [05])?"),
    ("cc", "creative commons", r"creative commons(?: licen[cs]e)?"),
]

# Sentences that grant or withhold rights without naming a license.
SENTENCES = [
    ("mit", "permission is hereby granted free of charge", r"permission is hereby granted free of charge to any person"),
    ("isc", "permission to use copy modify and", r"permission to use copy modify and (?:or )?distribute this software"),
    ("bsd", "redistribution and use in source and binary forms", r"redistribution and use in source and binary forms"),
    ("gpl", "redistribute it and or modify it under the terms", r"redistribute it and or modify it under the terms"),
    ("public-domain", "public domain", r"(?:released|dedicated|placed) (?:in|into|to) the public domain"),
    ("public-domain", "public domain", r"public domain"),
    ("proprietary", "all rights reserved", r"all rights reserved"),
    ("proprietary", "proprietary and confidential", r"proprietary and confidential"),
    ("proprietary", "may not be reproduced", r"may not be reproduced(?: in any form)?"),
    ("non-commercial", "commercial use", r"(?:non commercial use only|not for commercial use)"),
]

# Priority, certainty and wording around a name.
FORMS = [
    (4, 1.0, r"spdx license identifier {name}"),
    (3, 0.95, r"(?:re)?licen[cs]ed (?:to you )?under (?:the )?(?:terms of (?:the )?)?{name}"),
    (3, 0.95, r"(?:released|distributed|published|available) under (?:the )?(?:terms of (?:the )?)?{name}"),
    (2, 0.8, r"{name}"),
]

#: Every rule's match holds one of these; few texts do.
ROOTS = ["licen", "cc", "gpl", "creative", "attribution", "apache", "bsd", "public", "permission", "redistribut", "rights", "proprietary", "reproduced", "commercial", "mpl", "epl", "cddl", "eupl", "wtfpl", "rail", "mit"]


@dataclass(frozen=True)
class Rule:
    number: int
    label: str
    level: int
    certainty: float
    keyword: str
    regex: str


def numbered(pattern: str) -> str:
    """A pattern over plain words as one over numbered words."""
    return " " + pattern.replace(" ", r":\d+  ") + r":\d+ "


def rules() -> list[Rule]:
    """All rules, the first of equals going first."""
    plain = [(level, sure, label, key, form.format(name=name)) for level, sure, form in FORMS for label, key, name in FAMILIES]
    plain += [(3, 0.9, label, key, text) for label, key, text in SENTENCES]
    return [Rule(i, label, level, sure, key, numbered(p)) for i, (level, sure, label, key, p) in enumerate(plain)]


def plain_words(text: Column) -> Column:
    """Words of ASCII letters, digits and all other alphabets, A-Z in lower case, one blank between them."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.trim(F.regexp_replace(F.translate(text, upper, lower), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", " "))


def numbered_words(words: Column) -> Column:
    return F.array_join(F.transform(F.split(words, " "), lambda w, i: F.concat(F.lit(" "), w, F.lit(":"), i.cast("string"), F.lit(" "))), "")


def _start(match: Column) -> Column:
    return F.regexp_extract(match, r":(\d+) ", 1).cast("bigint")


def _places(text: Column, regex: Column) -> Column:
    return F.regexp_extract_all(text, regex, F.lit(0))


def _rule_table(wanted: list[Rule]) -> Column:
    one = lambda r: F.struct(F.lit(r.number).alias("number"), F.lit(r.label).alias("label"), F.lit(r.level).alias("level"), F.lit(r.certainty).alias("certainty"), F.lit(r.keyword).alias("keyword"), F.lit(r.regex).alias("regex"))
    return F.array(*[one(r) for r in wanted])


def _verdict(hits: Column) -> Column:
    """Labels and best certainty of the detections that no other one suppresses.

    Detections come in the order of start, longer and higher ones first; so one is contained in an
    earlier one that ranks no lower exactly when the furthest end among those is not before its own.
    """
    levels = sorted({level for level, _, _ in FORMS})
    start = F.struct(*[F.lit(-1).cast("bigint").alias(f"end{n}") for n in levels], F.array().cast("array<string>").alias("labels"), F.lit(0.0).alias("score"))

    def step(acc: Column, hit: Column) -> Column:
        contained = F.lit(False)
        for n in levels:
            contained = contained | ((hit["level"] <= n) & (acc[f"end{n}"] >= hit["end"]))
        return F.struct(
            *[F.when(hit["level"] == n, F.greatest(acc[f"end{n}"], hit["end"])).otherwise(acc[f"end{n}"]).alias(f"end{n}") for n in levels],
            F.when(contained, acc["labels"]).otherwise(F.array_union(acc["labels"], F.array(hit["label"]))).alias("labels"),
            F.when(contained, acc["score"]).otherwise(F.greatest(acc["score"], hit["certainty"])).alias("score"),
        )

    return F.aggregate(F.array_sort(hits), start, step)


RESULTS = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]


def license_scan(docs: DataFrame, text_col: str = "text", wanted: list[Rule] | None = None) -> DataFrame:
    """``docs`` with :data:`RESULTS`, text by text, without a shuffle.

    n_base places of base phrases, first_word and last_word their smallest and largest start,
    base_labels and labels comma-joined; score the certainty of the surest detection.
    Null and empty texts have no words, no labels and score 0.  Only texts
    that hold a root are numbered, and of the rules only those whose keyword the text holds run.
    Columns of ``docs`` with the names of results are replaced.
    """
    table = _rule_table(rules() if wanted is None else wanted)
    rows = docs.drop(*RESULTS).withColumn("words__", plain_words(F.coalesce(F.col(text_col), F.lit(""))))
    gate = F.lit(False)
    for root in ROOTS:
        gate = gate | F.contains(F.col("words__"), F.lit(root))
    rows = rows.withColumn("n_words", F.when(F.col("words__") == "", 0).otherwise(F.length("words__") - F.length(F.replace("words__", F.lit(" "), F.lit(""))) + 1).cast("bigint"))
    rows = rows.withColumn("words__", F.when(gate, F.col("words__")))
    rows = rows.withColumn("numbered__", F.when(F.col("words__").isNotNull(), numbered_words(F.col("words__"))))
    text, words = F.col("numbered__"), F.col("words__")
    base = F.array(*[F.struct(F.lit(label).alias("label"), F.transform(_places(text, F.lit(numbered(phrase))), _start).alias("starts")) for phrase, label in BASE.items()])
    hit = lambda rule: lambda m: F.struct(  # noqa: E731  negative where larger goes first
        _start(m).alias("start"), (-F.regexp_extract(m, r":(\d+) $", 1).cast("bigint")).alias("minus_end"), (-rule["level"]).alias("minus_level"), rule["number"].alias("number"),
        F.regexp_extract(m, r":(\d+) $", 1).cast("bigint").alias("end"), rule["level"].alias("level"), rule["label"].alias("label"), rule["certainty"].alias("certainty"),
    )
    candidates = F.filter(table, lambda r: F.contains(words, r["keyword"]))
    hits = F.flatten(F.transform(candidates, lambda r: F.transform(_places(text, r["regex"]), hit(r))))
    rows = rows.withColumn("base__", F.when(text.isNotNull(), base)).withColumn("hits__", F.when(text.isNotNull(), hits))
    rows = rows.withColumn("verdict__", F.when(F.size("hits__") > 0, _verdict(F.col("hits__")))).withColumn("starts__", F.flatten(F.col("base__.starts")))
    found = F.transform(F.filter(F.col("base__"), lambda b: F.size(b["starts"]) > 0), lambda b: b["label"])
    joined = lambda a: F.coalesce(F.array_join(F.array_sort(F.array_distinct(a)), ","), F.lit(""))
    return rows.select(
        *docs.drop(*RESULTS).columns, "n_words", F.greatest(F.size("starts__"), F.lit(0)).cast("bigint").alias("n_base"),
        F.array_min("starts__").alias("first_word"), F.array_max("starts__").alias("last_word"),
        joined(found).alias("base_labels"), joined(F.concat(found, F.coalesce(F.col("verdict__.labels"), F.array().cast("array<string>")))).alias("labels"),
        F.coalesce(F.col("verdict__.score"), F.lit(0.0)).alias("score"),
    )


def duckdb_sql(wanted: list[Rule] | None = None) -> str:
    """The scan of ``documents`` in DuckDB, from the same rules."""
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    values = ",\n  ".join(f"({r.number}, {quote(r.label)}, {r.level}, {r.certainty}::DOUBLE, {quote(r.keyword)}, {quote(r.regex)})" for r in (rules() if wanted is None else wanted))
    base = ", ".join(f"({quote(numbered(p))}, {quote(label)})" for p, label in BASE.items())
    return rf"""
WITH rules(number, label, level, certainty, keyword, regex) AS (VALUES
  {values}
), base(regex, label) AS (VALUES {base}
), w AS (
  SELECT doc_id, trim(regexp_replace(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+', ' ', 'g')) AS words FROM documents
), n AS (
  SELECT doc_id, words, CASE WHEN words = '' THEN 0 ELSE len(string_split(words, ' ')) END AS n_words,
         array_to_string(list_transform(string_split(words, ' '), lambda w, i: ' ' || w || ':' || (i - 1) || ' '), '') AS numbered FROM w
), b AS (
  SELECT doc_id, label, regexp_extract(m, ':(\d+) ', 1)::BIGINT AS start
  FROM (SELECT doc_id, label, unnest(regexp_extract_all(numbered, regex)) AS m FROM n, base)
), bb AS (
  SELECT doc_id, count(*) AS n_base, min(start) AS first_word, max(start) AS last_word, list(DISTINCT label) AS found FROM b GROUP BY doc_id
), h AS (
  SELECT *, regexp_extract(m, ':(\d+) ', 1)::BIGINT AS s, regexp_extract(m, ':(\d+) $', 1)::BIGINT AS e
  FROM (SELECT doc_id, number, label, level, certainty, unnest(regexp_extract_all(numbered, regex)) AS m FROM n, rules WHERE contains(words, keyword))
), k AS (
  SELECT doc_id, list(DISTINCT label) AS found, max(certainty) AS score FROM h
  WHERE NOT EXISTS (SELECT 1 FROM h AS o WHERE o.doc_id = h.doc_id AND o.level >= h.level AND o.s <= h.s AND o.e >= h.e
                    AND (o.s, -o.e, -o.level, o.number) < (h.s, -h.e, -h.level, h.number))
  GROUP BY doc_id
)
SELECT n.doc_id, n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
       coalesce(array_to_string(list_sort(bb.found), ','), '') AS base_labels,
       coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(bb.found, []), coalesce(k.found, [])))), ','), '') AS labels,
       coalesce(score, 0.0::DOUBLE) AS score
FROM n LEFT JOIN bb USING (doc_id) LEFT JOIN k USING (doc_id)
"""
