"""Quality rules on repetition within a text, from a suffix array over its words.

Per text (words are runs of bytes other than ASCII white space; a null text has none):
word and symbol counts, repeated lines, and words in 5-word windows found twice or more.
A text fails the base rules if it has fewer than 10 words or if more than 20% of its words lie
in such windows.

The verdict on the rest: the words of repeated 5-word windows, the only ones that longer
repeats can hold, are suffix-sorted by prefix doubling. The longest common prefix of
neighbours in that order comes from the doubling's ranks; the longer of the two beside a suffix is
the longest repeat starting there. Repeats of at least ``MIN_REPEAT`` words are united;
a text goes if they cover more than ``MAX_COVERED`` of its word characters or if one of them is longer than
``MAX_REPEAT`` words.

Every row is judged by itself, so rows repeated or with a null doc_id or other columns
of any name change nothing; no rows give no rows; n_words 0 fails the base rules.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carespan.llm import texts
from carespan.llm.storage import documents, ship

WIDTH = 5
MIN_WORDS = 10
MAX_REPEATED_PERCENT = 20
MIN_REPEAT = 8  # words
MAX_COVERED = 0.2  # of the characters in words
MAX_REPEAT = 100  # words

SYMBOL = np.zeros(256, bool)
SYMBOL[list(b"#*$%&|<>")] = True
CODE_POINT = np.ones(256, bool)
CODE_POINT[0x80:0xC0] = False


def _covered(starts: np.ndarray, lengths: np.ndarray, n: int) -> np.ndarray:
    """Which of n places lie in one of the spans."""
    edges = np.zeros(n + 1, np.int64)
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + lengths, -1)
    return np.cumsum(edges[:n]) > 0


def repeated_words(hashes: np.ndarray, rows: np.ndarray, n_rows: int, width: int = WIDTH) -> np.ndarray:
    """Words in windows of ``width`` words that their row has twice or more."""
    n = len(hashes)
    if n < width:
        return np.zeros(n, bool)
    sums = np.zeros(n - width + 1, np.uint64)
    for k in range(width):
        sums += hashes[k : n - width + 1 + k] * texts._PLACES[k]
    starts = np.flatnonzero(rows[: n - width + 1] == rows[width - 1 :])
    values, owners = texts.mix(sums[starts]), rows[starts]
    order = texts.sort_within_rows(values, owners, n_rows)
    values, owners = values[order], owners[order]
    again = np.zeros(len(order), bool)
    again[1:] = (values[1:] == values[:-1]) & (owners[1:] == owners[:-1])
    again[:-1] |= again[1:]
    found = starts[order[again]]
    return _covered(found, np.full(len(found), width), n)


def longest_repeats(hashes: np.ndarray, rows: np.ndarray, within: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(word index, words) of the longest repeat that starts at each word of ``within``.

    Repeats lie in one row and in one run of neighbouring words of ``within``.
    """
    at = np.flatnonzero(within)
    m = len(at)
    if m == 0:
        return at, np.zeros(0, np.int64)
    heads = np.flatnonzero(np.concatenate([[True], (at[1:] != at[:-1] + 1) | (rows[at[1:]] != rows[at[:-1]])]))
    sizes = np.diff(np.append(heads, m))
    end = np.repeat(heads + sizes, sizes)
    order = np.lexsort((hashes[at], rows[at]))
    new = np.ones(m, bool)
    new[1:] = (hashes[at][order][1:] != hashes[at][order][:-1]) | (rows[at][order][1:] != rows[at][order][:-1])
    rank = np.empty(m, np.int64)
    rank[order] = np.cumsum(new)
    rounds, length = [rank], 1
    index = np.arange(m)
    while length < sizes.max() and not new.all():
        beyond = index + length
        second = np.where(beyond < end, rank[np.minimum(beyond, m - 1)], 0)
        key = rank * (m + 1) + second
        order = np.argsort(key, kind="stable")
        new = np.ones(m, bool)
        new[1:] = key[order][1:] != key[order][:-1]
        rank = np.empty(m, np.int64)
        rank[order] = np.cumsum(new)
        rounds.append(rank)
        length *= 2
    a, b = order[:-1].copy(), order[1:].copy()
    common = np.zeros(max(m - 1, 0), np.int64)
    for k in range(len(rounds) - 1, -1, -1):
        x, y = a + common, b + common
        inside = (x < end[a]) & (y < end[b])
        x, y = np.minimum(x, m - 1), np.minimum(y, m - 1)
        same = inside & (rounds[k][x] == rounds[k][y])
        step = np.minimum(1 << k, np.minimum(end[a] - x, end[b] - y))
        common += np.where(same, step, 0)
    best = np.zeros(m, np.int64)
    np.maximum.at(best, a, common)
    np.maximum.at(best, b, common)
    return at, best


def _repeated_lines(text: str) -> int:
    lines = [line for line in text.split("\n") if line.strip(" \t\x0b\x0c\r")]
    return len(lines) - len(set(lines))


_MEASURES = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "repeat_chars long, longest_repeat long"
)


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lines = [_repeated_lines(t) if t else 0 for t in batch.column("text").to_pylist()]
        for first, last, data, offsets in texts.chunks(batch.column("text")):
            n = last - first
            found = texts.words(data, offsets)
            hashes = texts.word_hashes(data, found)
            points = np.concatenate([[0], np.cumsum(CODE_POINT[data])])
            symbols = np.concatenate([[0], np.cumsum(SYMBOL[data])])
            chars = points[found.ends] - points[found.starts]
            repeated = repeated_words(hashes, found.rows, n)
            at, length = longest_repeats(hashes, found.rows, repeated)
            long = length >= MIN_REPEAT
            united = _covered(at[long], length[long], len(hashes))
            longest = np.zeros(n, np.int64)
            np.maximum.at(longest, found.rows[at], length)

            def per_row(values):
                return np.bincount(found.rows, weights=values, minlength=n).astype(np.int64)

            yield pa.record_batch(
                [batch.column("doc_id").slice(first, n)]
                + [
                    pa.array(x)
                    for x in (
                        found.counts.astype(np.int64),
                        per_row(chars),
                        symbols[offsets[1:]] - symbols[offsets[:-1]],
                        np.array(lines[first:last], np.int64),
                        per_row(repeated),
                        per_row(chars * united),
                        longest,
                    )
                ],
                names=["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "repeat_chars", "longest_repeat"],
            )


def _judged(measures: DataFrame) -> DataFrame:
    failed = f"n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEATED_PERCENT} * n_words"
    good = f"repeat_chars <= {MAX_COVERED} * word_chars AND longest_repeat <= {MAX_REPEAT}"
    return measures.withColumn("base_failed", F.expr(failed)).withColumn("kept", F.expr(f"NOT base_failed AND {good}"))


def repetition_rules(docs: DataFrame) -> DataFrame:
    """Measures, base_failed and kept of every row."""
    ship(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return _judged(docs.mapInArrow(_measure, _MEASURES))


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the rules keep, all columns as they are.

    Judged and written in the same pass over the texts: no join, so repeated ids do no harm.
    """
    ship(docs.sparkSession)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = pa.array(np.arange(batch.num_rows))
            rows = pa.record_batch([ids, batch.column("text")], names=["doc_id", "text"])
            parts = [pa.Table.from_batches([m]) for m in _measure(iter([rows]))]
            if not parts:
                continue
            m = {k: v.to_numpy() for k, v in zip(parts[0].column_names, pa.concat_tables(parts).columns)}
            failed = (m["n_words"] < MIN_WORDS) | (100 * m["n_repeat_words"] > MAX_REPEATED_PERCENT * m["n_words"])
            good = (m["repeat_chars"] <= MAX_COVERED * m["word_chars"]) & (m["longest_repeat"] <= MAX_REPEAT)
            yield batch.filter(pa.array(~failed & good))

    return docs.mapInArrow(judge, docs.schema)


def op3_suffix_array_quality(spark, folder: str) -> DataFrame:
    return repetition_rules(documents(spark, folder))
