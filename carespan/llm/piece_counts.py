"""Word-piece counts by a linear longest-match automaton, without building the pieces.

A word (a run of bytes other than ASCII white space) is cut greedily: the longest piece that
may begin a word, then the longest ones that may go on; a word that can't be cut so is one unknown piece.
The vocabulary is a trie over bytes with a root for beginnings and one for continuations. Each node
has a failure link and the number of pieces popped on the way: when no child
fits, the greedy cut of what has been read so far ends in the link's node after that many pieces. So a word
is read once, and only counts are added up.

Distinct words of a chunk run through the automaton side by side, a byte at a time, as arrays;
a task keeps the counts of up to ``REMEMBERED`` words (told apart by 64-bit hashes).

The vocabulary file is a sentencepiece model: pieces marked as word beginnings begin words, all
others go on; control, unknown and byte pieces are left out. The file's path is a parameter.

Nulls, ties and odd rows: a null or blank text has no words and no pieces; every row
counts by itself, whatever its doc_id; other columns are ignored; no rows give no rows.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carespan.llm import texts
from carespan.llm.storage import documents, ship

REMEMBERED = 1 << 20
BEGIN, GO_ON, DEAD = 0, 1, -1
WORD_MARK = "▁"


class Automaton:
    """The trie with failure links; ``keys`` are node * 256 + byte in order, ``to`` the children."""

    def __init__(self, begins: Iterable[bytes], goes_on: Iterable[bytes]):
        children: list[dict[int, int]] = [{}, {}]
        whole = [False, False]
        for root, pieces in ((BEGIN, begins), (GO_ON, goes_on)):
            for piece in pieces:
                at = root
                for byte in piece:
                    if byte not in children[at]:
                        children[at][byte] = len(children)
                        children.append({})
                        whole.append(False)
                    at = children[at][byte]
                whole[at] = at > GO_ON
        link, pops = [DEAD] * len(children), [0] * len(children)
        queue = deque((BEGIN, GO_ON))
        while queue:
            parent = queue.popleft()
            for byte, child in children[parent].items():
                queue.append(child)
                if whole[child]:
                    link[child], pops[child] = GO_ON, 1
                    continue
                at, popped = link[parent], pops[parent]
                while at != DEAD and byte not in children[at]:
                    popped += pops[at]
                    at = link[at]
                if at != DEAD:
                    link[child], pops[child] = children[at][byte], popped
        edges = sorted((node << 8 | byte, child) for node, own in enumerate(children) for byte, child in own.items())
        self.keys = np.array([k for k, _ in edges] or [-1], np.int64)
        self.to = np.array([c for _, c in edges] or [0], np.int64)
        self.link, self.pops = np.array(link, np.int64), np.array(pops, np.int64)

    def count(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pieces of each word data[start:end], and whether it is one unknown piece."""
        node = np.full(len(starts), BEGIN, np.int64)
        count = np.zeros(len(starts), np.int64)
        lengths = ends - starts
        order = np.argsort(lengths, kind="stable")
        done = np.searchsorted(lengths[order], np.arange(int(lengths.max(initial=0)) + 1), side="right")
        for place in range(len(done) - 1):
            live = order[done[place] :]
            live = live[node[live] != DEAD]
            byte = data[starts[live] + place]
            while len(live):
                key = node[live] << 8 | byte
                at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
                fits = self.keys[at] == key
                node[live[fits]] = self.to[at[fits]]
                live, byte = live[~fits], byte[~fits]
                live, byte = self._fail(node, count, live, byte)
        live = np.flatnonzero((node != GO_ON) & (node != DEAD) & (lengths > 0))
        while len(live):
            live, _ = self._fail(node, count, live, live)
            live = live[node[live] != GO_ON]
        unknown = node == DEAD
        return np.where(unknown, 1, count), unknown

    def _fail(self, node, count, live, byte):
        count[live] += self.pops[node[live]]
        node[live] = self.link[node[live]]
        alive = node[live] != DEAD
        return live[alive], byte[alive]


@cache
def automaton(path: str) -> Automaton:
    """The automaton of a vocabulary file, built once in a worker process."""
    begins, goes_on = vocabulary(path)
    return Automaton([p.encode() for p in begins], [p.encode() for p in goes_on])


def vocabulary(path: str) -> tuple[list[str], list[str]]:
    """Pieces that begin words and pieces that go on."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    pieces = [
        model.id_to_piece(i)
        for i in range(model.get_piece_size())
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))
    ]
    begins = [p[1:] for p in pieces if p.startswith(WORD_MARK) and len(p) > 1]
    return begins, [p for p in pieces if not p.startswith(WORD_MARK)]


def piece_counts(docs: DataFrame, vocabulary_path: str) -> DataFrame:
    """(doc_id, n_words, n_pieces, n_unknown) of every row."""
    ship(docs.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = automaton(vocabulary_path)
        known: dict[int, int] = {}
        for batch in batches:
            for first, last, data, offsets in texts.chunks(batch.column("text")):
                found = texts.words(data, offsets)
                names, at, back = np.unique(texts.word_hashes(data, found), return_index=True, return_inverse=True)
                names = names.tolist()
                if len(known) > REMEMBERED:
                    known.clear()
                fresh = np.array([k for k, name in enumerate(names) if name not in known], np.int64)
                pieces, unknown = machine.count(data, found.starts[at[fresh]], found.ends[at[fresh]])
                for k, value in zip(fresh.tolist(), (2 * pieces + unknown).tolist()):
                    known[names[k]] = value
                value = np.array([known[name] for name in names], np.int64)[back]
                n = last - first
                yield pa.record_batch(
                    [
                        batch.column("doc_id").slice(first, n),
                        pa.array(found.counts.astype(np.int64)),
                        *(pa.array(np.bincount(found.rows, weights=w, minlength=n).astype(np.int64)) for w in (value >> 1, value & 1)),
                    ],
                    names=["doc_id", "n_words", "n_pieces", "n_unknown"],
                )

    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return docs.mapInArrow(count, "doc_id long, n_words long, n_pieces long, n_unknown long")


def op7_longest_match_counts(spark, folder: str) -> DataFrame:
    import public_tokenizers

    return piece_counts(documents(spark, folder), public_tokenizers.path("piece_bpe_32k.model"))
