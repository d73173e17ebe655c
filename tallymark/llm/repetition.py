"""Quality rules from repetition coverage.

Rolling hashes of several n-gram lengths, in numpy, mark the words that stand in an n-gram found twice or more in the
same text; what counts is the share of the words' characters that they cover, and their share in repeated lines.

Defined cases: null or wordless texts have zero counts, fail the base rule and are not kept; repeated rows are judged
row by row; a null doc_id stays null; columns other than doc_id and text are ignored; an empty table gives an empty
result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .common import sliced, table, texts, windows, word_hashes

#: Largest share of the words' characters that may lie inside repeated n-grams, by n-gram length in words (fixed values).
MOST_COVERED = {5: 0.40, 6: 0.38, 8: 0.36, 10: 0.34}
#: Largest share of word characters that may lie in lines equal to an earlier one.
MOST_IN_LINES = 0.30
SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"

SCHEMA = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long,"
    " base_failed boolean, kept boolean, line_share double, worst_ngram int, worst_share double"
)


def covered(hashes: np.ndarray, k: int) -> np.ndarray:
    """Which words stand in a k-word window that occurs twice or more."""
    n = hashes.size
    w = windows(hashes, k)
    if w.size < 2:
        return np.zeros(n, bool)
    order = np.argsort(w, kind="stable")
    s = w[order]
    same = s[1:] == s[:-1]
    if not same.any():
        return np.zeros(n, bool)
    hit = np.zeros(w.size, bool)
    hit[order[1:][same]] = True
    hit[order[:-1][same]] = True
    edge = np.zeros(n + 1, np.int32)
    starts = hit.nonzero()[0]
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + k, -1)
    return np.cumsum(edge[:n]) > 0


def measure(text: str) -> tuple:
    """The columns of SCHEMA after doc_id, for one text."""
    data = text.encode()
    words = data.split()
    n = len(words)
    word_chars = len(text) - sum(map(text.count, SPACES))
    symbols = sum(map(text.count, SYMBOLS))
    seen: set[str] = set()
    dup_lines = dup_chars = 0
    for line in text.split("\n"):
        if line.strip(SPACES):
            if line in seen:
                dup_lines += 1
                dup_chars += len(line) - sum(map(line.count, SPACES))
            seen.add(line)
    repeat, worst, share = 0, 0, 0.0
    if n:
        h = word_hashes(words)
        size = np.fromiter(map(len, words if len(data) == len(text) else map(bytes.decode, words)), np.int64, n)
        for k in MOST_COVERED:
            mark = covered(h, k)
            if k == 8:
                repeat = int(mark.sum())
            x = float(size[mark].sum()) / word_chars
            if worst == 0 or x / MOST_COVERED[k] > share / MOST_COVERED[worst]:
                worst, share = k, x
    line_share = dup_chars / word_chars if word_chars else 0.0
    failed = n < 20 or 100 * repeat > 30 * n
    kept = not failed and share <= MOST_COVERED.get(worst, 1.0) and line_share <= MOST_IN_LINES
    return n, word_chars, symbols, dup_lines, repeat, failed, kept, line_share, worst, share


def _judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = [pa.int64()] * 5 + [pa.bool_(), pa.bool_(), pa.float64(), pa.int32(), pa.float64()]
    for batch in sliced(batches):
        cols = list(zip(*map(measure, texts(batch)), strict=True)) or [()] * len(kinds)
        names = [x.split()[0] for x in SCHEMA.split(",")]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), *(pa.array(c, t) for c, t in zip(cols, kinds, strict=True))], names=names)


def repetition_rules(docs: DataFrame) -> DataFrame:
    """A row of counts and the verdict for each row of docs (doc_id, text)."""
    return docs.select("doc_id", "text").mapInArrow(_judge, SCHEMA)


def op3_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = repetition_rules(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
