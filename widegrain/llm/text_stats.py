"""Counts over one whole text that the quality operators build on."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

#: the counts, in this order
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_upper", "n_digits", "n_marks",
          "n_lines", "n_stops")
_BLANKS = " \t\n\x0b\x0c\r"


def counts(text: str) -> tuple[int, ...]:
    """Words are runs of bytes other than [\\x20\\x09-\\x0D]. ``n_repeat_words``
    counts words inside three-word windows that the text holds twice or more,
    ``n_dup_lines`` lines with a word that equal an earlier line."""
    raw = text.encode()
    words = raw.split()
    word_chars = len(text) - sum(text.count(c) for c in _BLANKS)
    windows = list(zip(words, words[1:], words[2:], strict=False))
    repeated = 0
    seen: set = set()
    again = {w for w in windows if w in seen or seen.add(w)}
    if again:
        covered = -1
        for i, w in enumerate(windows):
            if w in again:
                repeated += i + 2 - max(covered, i - 1)
                covered = i + 2
    earlier: set = set()
    dup_lines = 0
    lines = text.split("\n")
    for line in lines:
        if line in earlier:
            dup_lines += bool(line.strip(_BLANKS))
        else:
            earlier.add(line)
    upper = len(raw) - len(raw.translate(None, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
    digits = len(raw) - len(raw.translate(None, b"0123456789"))
    marks = len(raw) - len(raw.translate(None, b"!?|"))
    stops = len(raw) - len(raw.translate(None, b".,;:"))
    return (len(words), word_chars, sum(text.count(c) for c in "#*$%&|<>"), dup_lines, repeated, upper, digits, marks,
            len(lines), stops)


def text_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with the text replaced by its counts (null: those of no text,
    which has one empty line); columns named like a count are replaced."""
    passed = [c for c in docs.columns if c != text_col and c.lower() not in COUNTS]
    schema = StructType([docs.schema[c] for c in passed] + [StructField(c, LongType()) for c in COUNTS])
    names = schema.names

    def run(batches):
        for batch in batches:
            rows = [counts(t or "") for t in batch.column(len(passed)).to_pylist()]
            made = [pa.array([r[k] for r in rows], pa.int64()) for k in range(len(COUNTS))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(passed)], *made], names=names)

    return docs.select(*passed, F.col(text_col).cast("string").alias("__text")).mapInArrow(run, schema)
