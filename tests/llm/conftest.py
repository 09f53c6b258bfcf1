from __future__ import annotations

import pytest

DOC = "doc_id bigint, text string, lang string, source string, n_chars bigint"
#: Columns named like results and like inner columns of the operators.
CLASH = ["kept", "score", "size", "n_words", "labels", "predicted", "copies", "id", "digest", "count", "rank", "component_id", "text_sha256", "length"]


@pytest.fixture(scope="session")
def frame(spark):
    """Documents of (doc_id, text[, source]) with clashing extra columns."""
    def make(rows, clash: bool = True):
        full = [(r[0], r[1], None, r[2] if len(r) > 2 else "s", None) for r in rows]
        df = spark.createDataFrame(full, DOC).repartition(3)
        return df.selectExpr(*df.columns, *[f"'mine' as {c}" for c in CLASH]) if clash else df

    return make


@pytest.fixture(scope="session")
def hard():
    """Nulls, blanks, ties, repeated rows, other alphabets, one very long text."""
    prose = " ".join(f"word{i} is not word{i * 7 % 13}" for i in range(60))
    long = " ".join(f"w{i * i % 99991}" for i in range(60_000))
    return [
        (1, None), (2, ""), (3, " \t\n\x0b\x0c\r "), (None, "nobody's text"), (None, "nobody's text"), (None, None),
        (4, prose), (5, prose), (5, prose), (6, prose.replace(" ", "\n")), (7, prose + " end"), (8, prose.upper()), (9, long), (10, long), (11, "Ünï ñandú 漢字 é"), (12, "one"), (13, "one"), (14, "MIT License; GNU General  Public-License v2 and CC BY"),
        (15, "same same same same same same same same same same same same"),
    ]
