"""Benchmark decontamination by greedy string tiling.

Words are lower-cased (A-Z) runs without ASCII white space. A document and a benchmark item
that share a seed, a run of ``MIN_TILE`` words, are tiled: the longest common runs of words not yet
marked on either side are marked, longest first, until none of MIN_TILE words is left. The
tiles may stand in any order, so reordered passages count. An item leaks into a document if
the tiles cover at least ``COVERAGE`` of its words; an item shorter than MIN_TILE words leaks if the document
holds it whole.

The runs are found by running Karp-Rabin: hashes of all windows of the search length come
from prefix sums, windows of both sides are matched through a sorted table, matches are
extended word by word and the search length is halved whenever no longer match is left.
Only the words of a document that lie in a seed of the item take part, the others are
gaps between them, and an item whose seeds cover too little is left out at once: tiles
lie within seeds.

The benchmark is the query set. It goes to the tasks in blocks of at most ``BLOCK_CHARS``
characters (one pass over the documents for each), so what is broadcast
doesn't grow with either table; documents are never shuffled. The number of matched pairs is not
capped. Words and seeds are compared as 64-bit hashes.

Nulls, ties and odd rows: null or empty texts share nothing; rows with equal ids on either side are
each looked at; an item repeated under one id leaks once for each row; a null doc_id stays null; among equally long
matches the first in the item, then in the document, is marked first; other columns are
ignored; an empty table on either side gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carespan.llm import texts
from carespan.llm.storage import documents, kept, ship

MIN_TILE = 5
COVERAGE = 0.6
BLOCK_CHARS = 16_000_000


def _window_sums(hashes: np.ndarray, width: int) -> np.ndarray:
    """Mixed Karp-Rabin hash of every run of ``width`` words."""
    up, down = texts.powers(len(hashes) + 1)
    sums = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(hashes * up[: len(hashes)], out=sums[1:])
    at = np.arange(len(hashes) - width + 1)
    return texts.mix((sums[at + width] - sums[at]) * down[at])


def _free_windows(marked: np.ndarray, width: int) -> np.ndarray:
    used = np.concatenate([[0], np.cumsum(marked)])
    return np.flatnonzero(used[width:] == used[: len(used) - width])


def tiles(item: np.ndarray, text: np.ndarray, shortest: int = MIN_TILE) -> list[tuple[int, int, int]]:
    """(place in item, place in text, words) of the greedy tiling of two arrays of word hashes."""
    marked = [np.zeros(len(item), bool), np.zeros(len(text), bool)]
    out: list[tuple[int, int, int]] = []
    length = max(shortest, min(len(item), len(text)) // 2)
    while length >= shortest:
        if length > min(len(item), len(text)):
            length = length // 2 if length > shortest else 0
            length = max(length, shortest) if length else 0
            continue
        free = [_free_windows(m, length) for m in marked]
        table = _window_sums(item, length)[free[0]]
        found = _window_sums(text, length)[free[1]]
        order = np.argsort(table, kind="stable")
        table = table[order]
        first, last = np.searchsorted(table, found), np.searchsorted(table, found, side="right")
        matches = []
        done: set[tuple[int, int]] = set()
        for w in np.flatnonzero(last > first):
            j = int(free[1][w])
            for k in order[first[w] : last[w]]:
                i = int(free[0][k])
                if (i - 1, j - 1) in done:  # inside a longer match met before
                    done.add((i, j))
                    continue
                done.add((i, j))
                n = length
                while (
                    i + n < len(item) and j + n < len(text) and not marked[0][i + n] and not marked[1][j + n] and item[i + n] == text[j + n]
                ):
                    n += 1
                matches.append((-n, i, j))
        if matches and -min(matches)[0] > 2 * length:
            length = -min(matches)[0]  # much longer ones first
            continue
        blocked = False
        for n, i, j in sorted(matches):
            n = -n
            if marked[0][i : i + n].any() or marked[1][j : j + n].any():
                blocked = True
                continue
            marked[0][i : i + n] = marked[1][j : j + n] = True
            out.append((i, j, n))
        if blocked:
            continue  # what is left of the blocked ones may be as long still
        length = max(shortest, length // 2) if length > shortest else 0
    return out


class Benchmark:
    """A block of items with their seeds in a sorted table."""

    def __init__(self, ids: list, column: pa.Array):
        self.ids, self.items = ids, []
        seeds, owners, places = [], [], []
        for first, _, data, offsets in texts.chunks(column):
            data = texts.LOWER[data]
            found = texts.words(data, offsets)
            hashes = texts.word_hashes(data, found)
            for k, (a, n) in enumerate(zip(found.firsts, found.counts)):
                words = hashes[a : a + n]
                self.items.append(words)
                if n:
                    width = min(MIN_TILE, n)
                    got = _seed_hashes(words, width)
                    seeds.append(got)
                    owners.append(np.full(len(got), first + k))
                    places.append(np.arange(len(got)))
        self.widths = sorted({min(MIN_TILE, len(w)) for w in self.items if len(w)})
        seeds = np.concatenate(seeds or [np.zeros(0, np.uint64)])
        order = np.argsort(seeds, kind="stable")
        self.seeds = seeds[order]
        self.owners = np.concatenate(owners or [np.zeros(0, np.int64)])[order]
        self.places = np.concatenate(places or [np.zeros(0, np.int64)])[order]


def _seed_hashes(hashes: np.ndarray, width: int) -> np.ndarray:
    sums = np.full(len(hashes) - width + 1, width, np.uint64)
    for k in range(width):
        sums += hashes[k : len(hashes) - width + 1 + k] * texts._PLACES[k]
    return texts.mix(sums)


def _leaks_of(hashes: np.ndarray, rows: np.ndarray, bench: Benchmark) -> Iterator[tuple[int, int, list]]:
    """(row, item, tiles) of the rows' leaks."""
    hit_at, hit_item, hit_place, hit_width = [], [], [], []
    for width in bench.widths:
        if len(hashes) < width:
            continue
        sums = _seed_hashes(hashes, width)
        first = np.searchsorted(bench.seeds, sums)
        some = np.flatnonzero((bench.seeds[np.minimum(first, len(bench.seeds) - 1)] == sums) & (rows[: len(sums)] == rows[width - 1 :]))
        count = np.searchsorted(bench.seeds, sums[some], side="right") - first[some]
        at = np.repeat(some, count)
        index = np.repeat(first[some], count) + np.arange(len(at)) - np.repeat(np.cumsum(count) - count, count)
        hit_at.append(at)
        hit_item.append(bench.owners[index])
        hit_place.append(bench.places[index])
        hit_width.append(np.full(len(at), width))
    if not hit_at or not sum(map(len, hit_at)):
        return
    at, item, place, width = map(np.concatenate, (hit_at, hit_item, hit_place, hit_width))
    order = np.lexsort((at, item, rows[at]))
    at, item, place, width = at[order], item[order], place[order], width[order]
    pair = np.concatenate([[True], (rows[at[1:]] != rows[at[:-1]]) | (item[1:] != item[:-1])])
    bounds = np.append(np.flatnonzero(pair), len(at))
    for a, b in zip(bounds[:-1], bounds[1:]):
        k, row, w = int(item[a]), int(rows[at[a]]), int(width[a])
        words = bench.items[k]
        if len(words) < MIN_TILE:
            yield row, k, [(0, int(at[a]), len(words))]
            continue
        covered = np.zeros(len(words) + 1, np.int64)
        np.add.at(covered, place[a:b], 1)
        np.add.at(covered, place[a:b] + w, -1)
        if (np.cumsum(covered[:-1]) > 0).sum() < COVERAGE * len(words):
            continue
        spots = np.unique((at[a:b, None] + np.arange(w)).ravel())
        gaps = np.flatnonzero(np.diff(spots) > 1) + 1
        text = hashes[spots]
        if len(gaps):  # a gap is a word that the item doesn't have
            text = np.insert(text, gaps, texts.mix(np.arange(len(gaps), dtype=np.uint64) + np.uint64(0x5EED) + words.sum(dtype=np.uint64)))
            spots = np.insert(spots, gaps, -1)
        found = tiles(words, text)
        if sum(n for _, _, n in found) >= COVERAGE * len(words):
            yield row, k, [(i, int(spots[j]), n) for i, j, n in found]


_LEAK = "doc_id long, item_id long, item_words long, covered_words long, n_tiles long, longest_tile long, coverage double"


def _blocks(benchmark: DataFrame) -> Iterator[Benchmark]:
    """The items in blocks of bounded size, one at a time."""
    sized = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").where("text IS NOT NULL")
    chars = sized.agg(F.sum(F.length("text")).alias("n")).first().n or 0
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(max(1, -(-chars // BLOCK_CHARS))))
    blocks = kept(sized.withColumn("block", block), "benchmark")
    for (block,) in sorted(blocks.select("block").distinct().collect()):
        table = blocks.where(F.col("block") == block).select("item_id", "text").orderBy("item_id", "text").toArrow()
        yield Benchmark(table["item_id"].to_pylist(), pa.array(table["text"].to_pylist(), pa.string()))


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """A row for each pair of a document and a benchmark item that leaks into it."""
    spark = ship(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    out = None
    for block in _blocks(benchmark):
        shared = spark.sparkContext.broadcast(block)

        def search(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            bench = shared.value
            for batch in batches:
                ids = batch.column("doc_id").to_pylist()
                found = []
                for first, _, data, offsets in texts.chunks(batch.column("text")):
                    data = texts.LOWER[data]
                    words = texts.words(data, offsets)
                    for row, k, marks in _leaks_of(texts.word_hashes(data, words), words.rows, bench):
                        n, sizes = len(bench.items[k]), [x for _, _, x in marks]
                        found.append((ids[first + row], bench.ids[k], n, sum(sizes), len(sizes), max(sizes), sum(sizes) / n))
                names = ["doc_id", "item_id", "item_words", "covered_words", "n_tiles", "longest_tile", "coverage"]
                kinds = [pa.int64()] * 6 + [pa.float64()]
                columns = zip(*found) if found else [[]] * 7
                yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, kinds)], names=names)

        part = docs.mapInArrow(search, _LEAK)
        out = part if out is None else out.unionByName(part)
    return out if out is not None else spark.createDataFrame([], _LEAK)


def without_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of docs that no benchmark item leaks into, columns as they are."""
    spark = ship(docs.sparkSession)
    for block in _blocks(benchmark):
        shared = spark.sparkContext.broadcast(block)

        def clean(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            bench = shared.value
            for batch in batches:
                keep = np.ones(batch.num_rows, bool)
                for first, _, data, offsets in texts.chunks(batch.column("text")):
                    data = texts.LOWER[data]
                    words = texts.words(data, offsets)
                    for row, _, _ in _leaks_of(texts.word_hashes(data, words), words.rows, bench):
                        keep[first + row] = False
                yield batch.filter(pa.array(keep))

        docs = docs.mapInArrow(clean, docs.schema)
    return docs


def op8_string_tiling_leaks(spark, folder: str) -> DataFrame:
    return leaks(documents(spark, folder), spark.read.parquet(f"{folder}/benchmark.parquet"))
