"""Statistics of whole texts, computed over Arrow batches, and bounded labelled samples of them."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickstrata.llm.wordarrays import Words, mixed

#: Characters counted as symbols.
SYMBOLS = "#*$%&|<>"
#: Words in a window that counts as repeated.
WINDOW = 5

_IS_SYMBOL = np.zeros(256, bool)
_IS_SYMBOL[list(SYMBOLS.encode())] = True
_IS_UPPER = np.zeros(256, bool)
_IS_UPPER[65:91] = True
_IS_DIGIT = np.zeros(256, bool)
_IS_DIGIT[48:58] = True
_IS_MARK = np.zeros(256, bool)
_IS_MARK[list(b".,;:!?")] = True
_IS_SHOUT = np.zeros(256, bool)
_IS_SHOUT[list(b"!?")] = True
_STARTS_CHAR = np.ones(256, bool)
_STARTS_CHAR[0x80:0xC0] = False
_SPACES = " \t\n\v\f\r"


def repeated_words(words: list, k: int = WINDOW) -> int:
    """Words that lie in a window of ``k`` words found twice or more, the first included."""
    seen: dict[tuple, int] = {}
    covered = np.zeros(len(words) + 1, np.int64)
    for i in range(len(words) - k + 1):
        window = tuple(words[i : i + k])
        first = seen.setdefault(window, i)
        if first != i:
            covered[i] += 1
            covered[i + k] -= 1
            if first >= 0:
                covered[first] += 1
                covered[first + k] -= 1
                seen[window] = -1
    return int((np.cumsum(covered)[:-1] > 0).sum())


def _repeats(words: Words, hashes: np.ndarray) -> np.ndarray:
    """:func:`repeated_words` of every row.

    Rows whose windows all hash differently repeat nothing; the others are counted on
    the words themselves, so equal hashes of different windows do no harm.
    """
    out = np.zeros(words.rows, np.int64)
    keys, at = words.windows(hashes, WINDOW)
    if not len(keys):
        return out
    row = words.row[at]
    keys = mixed(keys ^ mixed(row.astype(np.uint64)))  # windows of different rows differ
    ordered = np.sort(keys)
    twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    if not len(twice):
        return out
    place = np.minimum(np.searchsorted(twice, keys), len(twice) - 1)
    doubtful = np.unique(row[twice[place] == keys])
    raw = words.data.tobytes()
    for i in doubtful.tolist():
        lo, hi = words.bounds[i], words.bounds[i + 1]
        out[i] = repeated_words([raw[a:b] for a, b in zip(words.starts[lo:hi].tolist(), words.ends[lo:hi].tolist())])
    return out


def _duplicate_lines(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    raw, out = data.tobytes(), np.zeros(len(offsets) - 1, np.int64)
    for i, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
        lines = [x for x in raw[a:b].split(b"\n") if x.strip(_SPACES.encode())]
        out[i] = len(lines) - len(set(lines))
    return out


#: Names of :func:`base_statistics`, all long.
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
#: Names of the columns of :func:`features`.
FEATURES = [
    "log_words", "word_length", "symbols_per_word", "dup_line_share", "repeat_share", "upper_share", "digit_share",
    "marks_per_word", "shouts_per_word", "distinct_share", "words_per_line", "non_ascii_share", "short_word_share",
]


def base_statistics(words: Words, hashes: np.ndarray) -> dict[str, np.ndarray]:
    """Counts of every row: words, code points in words, symbols, duplicate lines, words in repeated windows."""
    starts_char = _STARTS_CHAR[words.data]
    return {
        "n_words": words.counts,
        "word_chars": words.per_row(starts_char & words.ink),
        "n_symbols": words.per_row(_IS_SYMBOL[words.data]),
        "n_dup_lines": _duplicate_lines(words.data, words.offsets),
        "n_repeat_words": _repeats(words, hashes),
    }


def features(words: Words, hashes: np.ndarray, base: dict[str, np.ndarray]) -> np.ndarray:
    """A row of :data:`FEATURES` for every text; those of an empty text are zero."""
    data, n = words.data, np.maximum(words.counts, 1).astype(float)
    # 40 bits of hash per word are plenty for a share; a block has fewer than 2**24 rows
    key = np.sort((words.row.astype(np.uint64) << np.uint64(40)) | (hashes >> np.uint64(24)))
    first = key[np.concatenate(([True], key[1:] != key[:-1]))] if len(key) else key
    distinct = np.bincount((first >> np.uint64(40)).astype(np.int64), minlength=words.rows)
    lines = words.per_row(data == 10) + 1
    chars = np.maximum(words.per_row(words.ink), 1)
    lengths = words.ends - words.starts
    short = np.bincount(words.row[lengths <= 3], minlength=words.rows)
    columns = [
        np.log1p(words.counts), base["word_chars"] / n, base["n_symbols"] / n, base["n_dup_lines"] / lines, base["n_repeat_words"] / n,
        words.per_row(_IS_UPPER[data]) / chars, words.per_row(_IS_DIGIT[data]) / chars, words.per_row(_IS_MARK[data]) / n,
        words.per_row(_IS_SHOUT[data]) / n, distinct / n, words.counts / lines, words.per_row(data >= 0x80) / chars, short / n,
    ]
    return np.stack(columns, axis=1).astype(np.float64)


def in_training_fold(id_col: Column) -> Column:
    """True for rows whose label may be learned: crc32 of the identifier's text modulo 3 is not 1."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % 3 != 1


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, rows: int, id_col: str = "doc_id") -> DataFrame:
    """``docs`` with ``label__`` for at most ``rows`` labelled identifiers of the training fold.

    The identifiers with the smallest hash are taken, so the sample is the same on
    every run.  It holds ``rows`` identifiers at most, whence the broadcast.
    """
    known = labels.filter(F.col(label).isNotNull() & F.col(id_col).isNotNull() & in_training_fold(F.col(id_col)))
    known = known.groupBy(F.col(id_col).alias("id__")).agg(F.max(label).alias("label__"))
    known = known.orderBy(F.xxhash64("id__"), "id__").limit(rows)
    return docs.join(F.broadcast(known), docs[id_col] == F.col("id__")).drop("id__")
