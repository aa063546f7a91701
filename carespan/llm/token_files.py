"""Token ids as flat files of unsigned integers with 64-bit document offsets.

Documents are range-partitioned by doc_id and sorted, so partitions follow one another. Each
task encodes its texts and writes one shard of two files into the shared folder:

* ``.bin``: the ids one after another, little-endian, 16 bits wide if the vocabulary fits, else 32;
* ``.idx``: a header (magic, id width, documents, ids), the doc_ids with their null marks, and
  64-bit offsets of the documents' first ids within the shard, with the end as the last.

A shard's name is new for every attempt and only the manifest's rows count, so a task that is
run again harms nothing. The base of a shard, the number of all ids before it, is a
prefix sum over the manifest (a row for each shard). Readers map the files
into memory where the folder is a local or mounted one and read them through pyarrow's
file systems elsewhere.

Encoding is the tokenizers library's. The byte-level pattern never joins a character that is no
white space with white space behind it, so a text is cut there and each distinct cut piece is encoded
once in a worker process (they are told apart by 64-bit hashes, see texts.py). The library takes a special token's own text
for that token wherever it stands; such a text has no white space, so it lies in one piece and stays what it is there. Pieces without
it are encoded many in one call, parted by it; a tokenizer of another kind encodes whole texts.

Nulls, ties and odd rows: a null text has only the end id; rows with a null doc_id come
first; rows with equal ids come by text, each with its own entry; other columns are ignored; no rows make no
shards.
"""

from __future__ import annotations

import json
import re
import struct
import uuid
import zlib
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from carespan.llm import texts
from carespan.llm.storage import documents, file_system, kept, ship
from carespan.session import fresh_path

END_ID = 2
MAGIC = b"CSTOKID1"
_HEADER = "<8sIIQQ"
REMEMBERED = 1 << 19  # distinct pieces a worker process keeps (about 30 MB); beyond, the more used half stays

# White space of the byte-level pattern is cut off only behind characters that surely are none:
# printable ASCII, and two-byte characters from U+00C0 on.
_SOLID = np.zeros(256, bool)
_SOLID[0x21:0x7F] = True


def _pieces(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and rows of pieces: white space and what follows it up to the next white space."""
    n = len(data)
    space = ~texts.WORD_BYTE[data]
    solid = _SOLID[data]
    two = np.zeros(n, bool)
    two[1:] = (data[1:] >= 0x80) & (data[1:] < 0xC0) & (data[:-1] >= 0xC3) & (data[:-1] < 0xE0)
    cut = np.zeros(n + 1, bool)
    cut[1:n] = space[1:] & (solid | two)[:-1]
    cut[offsets] = True
    cut[n] = True
    edges = np.flatnonzero(cut)
    starts, ends = edges[:-1], edges[1:]
    return starts, ends, np.searchsorted(offsets, starts, side="right") - 1


class Encoder:
    """Ids of texts by the file's tokenizer."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            kind = json.load(f)
        pre = kind.get("pre_tokenizer") or {}
        self.cuts = kind.get("normalizer") is None and pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space")
        added = kind.get("added_tokens") or ()
        plain = not any(t["lstrip"] or t["rstrip"] or t["single_word"] or re.search(r"\s", t["content"]) for t in added)
        self.cuts = self.cuts and plain
        # Alone, and no end of it a beginning of it: between two pieces it is found there and nowhere else.
        marks = [(t["content"], t["id"]) for t in added]
        parts = self.cuts and len(marks) == 1 and not any(marks[0][0].startswith(marks[0][0][k:]) for k in range(1, len(marks[0][0])))
        self.mark = marks[0] if parts else None
        self.width = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4
        self.forget()

    def forget(self) -> None:
        self.keys, self.place = np.zeros(0, np.uint64), np.zeros(0, np.int64)  # sorted keys, index of each
        self.flat = np.zeros(0, np.uint32)
        self.begins, self.sizes, self.uses = (np.zeros(0, np.int64) for _ in range(3))

    def _stretch(self, index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the pieces one after another, and how many each has."""
        sizes = self.sizes[index]
        until = np.cumsum(sizes)
        total = int(until[-1]) if len(until) else 0
        return self.flat[np.repeat(self.begins[index] - (until - sizes), sizes) + np.arange(total)], sizes

    def _prune(self) -> None:
        """Keep the more used half of the pieces."""
        keep = np.sort(np.argsort(self.uses, kind="stable")[len(self.uses) - REMEMBERED // 2 :])
        moved = np.full(len(self.uses), -1, np.int64)
        moved[keep] = np.arange(len(keep))
        stays = moved[self.place] >= 0
        self.keys, self.place = self.keys[stays], moved[self.place[stays]]
        self.flat, self.sizes = self._stretch(keep)
        self.begins, self.uses = np.cumsum(self.sizes) - self.sizes, self.uses[keep] // 2

    def _ids(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pieces one after another, and how many each has; the mark parts them within one call."""
        if self.mark is not None and not any(self.mark[0] in p for p in pieces):
            text, number = self.mark
            (found,) = self.tokenizer.encode_batch_fast([text.join(pieces)], add_special_tokens=False)
            ids = np.array(found.ids, np.uint32)
            parts = np.flatnonzero(ids == number)
            if len(parts) == len(pieces) - 1:
                edges = np.concatenate([[-1], parts, [len(ids)]])
                return np.delete(ids, parts), np.diff(edges) - 1
        each = [e.ids for e in self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)]
        return np.array([i for ids in each for i in ids], np.uint32), np.array([len(x) for x in each], np.int64)

    def _learn(self, keys: np.ndarray, pieces: list[str]) -> None:
        if not pieces:
            return
        own = np.array([self.mark is not None and self.mark[0] in p for p in pieces])
        if own.any() and not own.all():
            for some in (~own, own):
                self._learn(keys[some], [pieces[k] for k in np.flatnonzero(some)])
            return
        ids, sizes = self._ids(pieces)
        at = np.searchsorted(self.keys, keys)
        self.place = np.insert(self.place, at, len(self.sizes) + np.arange(len(keys)))
        self.keys = np.insert(self.keys, at, keys)
        self.begins = np.concatenate([self.begins, len(self.flat) + np.cumsum(sizes) - sizes])
        self.sizes = np.concatenate([self.sizes, sizes])
        self.uses = np.concatenate([self.uses, np.zeros(len(sizes), np.int64)])
        self.flat = np.concatenate([self.flat, ids])

    def _known(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(self.keys):
            return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return at, self.keys[at] == keys

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the rows in order, and how many each row has."""
        n = len(offsets) - 1
        if not self.cuts:
            rows = [data[a:b].tobytes().decode() for a, b in zip(offsets[:-1], offsets[1:])]
            found = [e.ids for e in self.tokenizer.encode_batch_fast(rows, add_special_tokens=False)]
            return np.array([i for ids in found for i in ids], np.uint32), np.array([len(x) for x in found], np.int64)
        if len(data) == 0:
            return np.zeros(0, np.uint32), np.zeros(n, np.int64)
        if len(self.keys) > REMEMBERED:
            self._prune()
        starts, ends, rows = _pieces(data, offsets)
        keys = texts.mix(texts.span_hashes(texts.prefix_hashes(data), starts, ends) + (ends - starts).astype(np.uint64))
        distinct, first, back = np.unique(keys, return_index=True, return_inverse=True)
        fresh = np.flatnonzero(~self._known(distinct)[1])
        raw = data.tobytes()
        at = first[fresh]
        self._learn(distinct[fresh], [raw[a:b].decode() for a, b in zip(starts[at].tolist(), ends[at].tolist())])
        index = self.place[self._known(distinct)[0]][back]
        self.uses += np.bincount(index, minlength=len(self.uses))
        ids, sizes = self._stretch(index)
        return ids, np.bincount(rows, weights=sizes, minlength=n).astype(np.int64)


@cache
def encoder_of(path: str) -> Encoder:
    """The file's encoder, kept with its pieces by a worker process from task to task."""
    return Encoder(path)


def _shard_writer(folder: str, tokenizer_path: str, end_id: int) -> Callable:
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(tokenizer_path)
        kind = np.dtype("<u2" if encoder.width == 2 and end_id < 1 << 16 else "<u4")
        system, root = file_system(folder)
        name, part, out = f"shard-{uuid.uuid4().hex}", None, None
        ids, counts = [], []
        for batch in batches:
            if batch.num_rows == 0:
                continue
            if out is None:
                part = batch.column("part")[0].as_py()
                system.create_dir(root, recursive=True)
                out = system.open_output_stream(f"{root}/{name}.bin")
            ids.append(batch.column("doc_id"))
            for _, _, data, offsets in texts.chunks(batch.column("text")):
                found, sizes = encoder.encode(data, offsets)
                ends = np.cumsum(sizes)
                out.write(np.insert(found, ends, end_id).astype(kind).tobytes())
                counts.append(sizes + 1)
        if out is None:
            return
        out.close()
        ids, counts = pa.chunked_array(ids).combine_chunks(), np.concatenate(counts)
        offsets = np.concatenate([[0], np.cumsum(counts)]).astype("<u8")
        with system.open_output_stream(f"{root}/{name}.idx") as f:
            f.write(struct.pack(_HEADER, MAGIC, kind.itemsize, 0, len(counts), int(offsets[-1])))
            f.write(ids.fill_null(0).to_numpy().astype("<i8").tobytes())
            f.write(ids.is_valid().to_numpy(zero_copy_only=False).astype(np.uint8).tobytes())
            f.write(offsets.tobytes())
        yield pa.record_batch(
            [pa.array([x]) for x in (part, f"{folder}/{name}", len(counts), int(offsets[-1]))],
            names=["part", "shard", "n_docs", "n_ids"],
        )

    return write


def write_token_files(docs: DataFrame, folder: str, tokenizer_path: str, end_id: int = END_ID) -> DataFrame:
    """Write the shards; the manifest (part, shard, n_docs, n_ids, base) of those that count."""
    ship(docs.sparkSession)
    ordered = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        .repartitionByRange("doc_id")
        .sortWithinPartitions("doc_id", "text")
        .withColumn("part", F.spark_partition_id())
        .select("part", "doc_id", "text")
    )
    shards = ordered.mapInArrow(_shard_writer(folder, tokenizer_path, end_id), "part long, shard string, n_docs long, n_ids long")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return kept(shards, "manifest").withColumn("base", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


def _bytes(system, path: str):
    """The file's content, mapped where it is local."""
    if isinstance(system, pa.fs.LocalFileSystem):
        return pa.memory_map(path).read_buffer()
    with system.open_input_file(path) as f:
        return f.read_buffer()


class Shard:
    """One shard's documents, read in place."""

    def __init__(self, path: str):
        system, root = file_system(path)
        index = _bytes(system, f"{root}.idx")
        magic, width, _, n, total = struct.unpack(_HEADER, index.slice(0, struct.calcsize(_HEADER)).to_pybytes())
        if magic != MAGIC:
            raise ValueError(f"{path}.idx is not an index of token files")
        place = struct.calcsize(_HEADER)
        self.doc_ids = np.frombuffer(index, "<i8", n, place)
        self.known = np.frombuffer(index, np.uint8, n, place + 8 * n).astype(bool)
        self.offsets = np.frombuffer(index, "<u8", n + 1, place + 9 * n).astype(np.int64)
        content = _bytes(system, f"{root}.bin")
        self.ids = np.frombuffer(content, f"<u{width}", total)

    def __len__(self) -> int:
        return len(self.doc_ids)

    def __getitem__(self, k: int) -> np.ndarray:
        return self.ids[self.offsets[k] : self.offsets[k + 1]]


def read_token_files(manifest: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document in the shards."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, base in zip(batch.column("shard").to_pylist(), batch.column("base").to_pylist()):
                shard = Shard(path)
                for a in range(0, len(shard), 8192):
                    b = min(a + 8192, len(shard))
                    sums = [zlib.crc32(shard[k].astype("<u4").tobytes()) for k in range(a, b)]
                    yield pa.record_batch(
                        [
                            pa.array(shard.doc_ids[a:b], mask=~shard.known[a:b]),
                            pa.array(shard.offsets[a:b] + base),
                            pa.array(np.diff(shard.offsets[a : b + 1])),
                            pa.array(sums, pa.int64()),
                        ],
                        names=["doc_id", "start", "n_tokens", "ids_crc32"],
                    )

    spread = manifest.select("shard", "base").repartition(max(1, manifest.count()))
    return spread.mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def tokenize(spark: SparkSession, docs: DataFrame, tokenizer_path: str | None = None) -> DataFrame:
    """Write the token files of ``docs`` to the shared folder and read their digests."""
    if tokenizer_path is None:
        import public_tokenizers

        tokenizer_path = public_tokenizers.path("byte_bpe_50k.json")
    return read_token_files(write_token_files(docs, fresh_path(spark, "llm-tokens"), tokenizer_path))


def op2_token_files(spark, folder: str) -> DataFrame:
    return tokenize(spark, documents(spark, folder))
