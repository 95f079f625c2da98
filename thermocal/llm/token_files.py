"""Token ids as binary files with Elias-Fano document boundaries.

Documents are range-partitioned and sorted by id; each task encodes its documents and
writes one shard: ``<n>.ids`` (the ids of all its documents, one behind the other, little-endian,
2 bytes each if the vocabulary allows, else 4) and ``<n>.idx`` (an Elias-Fano list of the
documents' ends in the shard and the documents' ids). The shards' token counts, one row a
shard, give each shard its place in the whole array. No task holds more than a batch of
texts plus eight bytes for each document of its shard.

Files are written under a name of the attempt and renamed when complete, so a repeated
or speculative task leaves the same shard. The folder must be one that all executors
share (``spark.checkpoint.dir`` names one); it is opened through ``pyarrow.fs``.

Encoding calls the tokenizer once for each distinct white-space-free piece of text and
keeps what it returned in a bounded table: the tokenizers meant here drop white space
and never join across it (``pieces=False`` encodes whole texts with any tokenizer).

Defined results: null and empty texts hold only the end id; null ids come first; rows
that share an id are ordered by text; an empty table gives no shard and no rows.
"""

from __future__ import annotations

import os
import re
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import elias_fano
from .common import ship_package

_ENCODERS: dict[tuple, Encoder] = {}
_NO_ID = -(1 << 63)
_LATIN = [chr(c) for c in range(0xC0, 0x100) if c not in (0xD7, 0xF7)]
#: No apostrophe (some tokenizers cut at 's), no "<" (special tokens), no other sign above ASCII.
_PLAIN = re.compile("[!-&(-;=-~À-ÖØ-öø-ÿ]+")
_PARTS = re.compile("[a-zà-öø-ÿß]+|[0-9]|[^0-9a-zà-öø-ÿß]+")


def filesystem(folder: str) -> tuple[pafs.FileSystem, str]:
    if "://" in folder or folder.startswith("file:"):
        return pafs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", folder))
    return pafs.LocalFileSystem(), folder


class Encoder:
    """UTF-8 text -> ids, remembering the ids of up to ``memory`` pieces, and of as many words in them.

    A piece of ASCII and Latin-1 letters, digits and ASCII signs is cut where the tokenizer's own
    splitting cuts it (letters, single digits, runs of the rest), and the words go to the library's model
    directly, in lower case and in its byte alphabet; whatever else goes through
    the whole tokenizer. ``plain`` says whether a probe found both ways equal; if not, all
    pieces go through the whole tokenizer.
    """

    def __init__(self, path: str, pieces: bool = True, memory: int = 1_000_000):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.tokenizer, self.pieces, self.memory = Tokenizer.from_file(path), pieces, memory
        self.known: dict[bytes, bytes] = {}
        self.words: dict[str, bytes] = {}
        self.plain = False
        if pieces:
            byte = self.tokenizer.pre_tokenizer.pre_tokenize_str if self.tokenizer.pre_tokenizer else None
            self.alphabet = {ord(c): "".join(p for p, _ in byte(c)) for c in _LATIN} if byte else {}
            probe = ["Plain", "thh.", "a1b22,", "$%%%x", "ÉTÉ", "años(ñ)", "größe-", "x.y,z", "ÀÿÖØ"]
            self.plain = [self._model_ids(p) for p in probe] == self._ids(probe)

    def _ids(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _model_ids(self, piece: str) -> list[int]:
        return [t.id for w in _PARTS.findall(piece.lower()) for t in self.tokenizer.model.tokenize(w.translate(self.alphabet))]

    def encode(self, text: bytes, dtype) -> bytes:
        if not self.pieces:
            return np.array(self._ids([text.decode()])[0], dtype).tobytes()
        pieces = text.split()  # of bytes: at ASCII white space alone
        ids = [*map(self.known.get, pieces)]
        if None in ids:
            if len(self.known) > self.memory:
                self.known.clear()
                ids = [None] * len(pieces)
            self._learn(dict.fromkeys(p for p, i in zip(pieces, ids) if i is None), dtype)
            ids = map(self.known.__getitem__, pieces)
        return b"".join(ids)

    def _learn(self, pieces: dict[bytes, None], dtype) -> None:
        if len(self.words) > self.memory:
            self.words.clear()
        words, other = self.words, []
        for p in pieces:
            s = p.decode()
            if not (self.plain and _PLAIN.fullmatch(s)):
                other.append((p, s))
                continue
            out = []
            for w in _PARTS.findall(s.lower()):
                got = words.get(w)
                if got is None:
                    got = words[w] = np.array([t.id for t in self.tokenizer.model.tokenize(w.translate(self.alphabet))], dtype).tobytes()
                out.append(got)
            self.known[p] = b"".join(out)
        if other:
            for (p, _), ids in zip(other, self._ids([s for _, s in other])):
                self.known[p] = np.array(ids, dtype).tobytes()


def encoder_of_worker(path: str, pieces: bool, width: int) -> Encoder:
    """This worker process's encoder; what it remembers outlives a task. (A module function is
    pickled by name, so it sees the worker's own table, not a copy.)"""
    key = path, pieces, width
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(path, pieces)
    return _ENCODERS[key]


def vocabulary_size(tokenizer_path: str) -> int:
    from tokenizers import Tokenizer
    return Tokenizer.from_file(tokenizer_path).get_vocab_size(with_added_tokens=True)


def _writer(folder: str, tokenizer_path: str, end_id: int, width: int, pieces: bool):
    dtype = np.dtype(f"<u{width}")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of_worker(tokenizer_path, pieces, width)
        end = np.array([end_id], dtype).tobytes()
        store, base = filesystem(folder)
        store.create_dir(base, recursive=True)
        n, attempt = TaskContext.get().partitionId(), uuid.uuid4().hex
        name, out = f"{n:06d}", None
        ends, ids, total = [], [], 0
        for b in batches:
            for doc, text in zip(b.column("i"), b.column("t")):
                if out is None:
                    out = store.open_output_stream(f"{base}/{name}.ids.{attempt}")
                got = encoder.encode(text.as_py() or b"", dtype)
                out.write(got)
                out.write(end)
                total += len(got) // width + 1
                ends.append(total)
                ids.append(doc.as_py())
        if out is None:
            return
        out.close()
        lists = elias_fano.encode(np.array(ends, np.uint64))
        null = np.packbits(np.array([i is None for i in ids], np.uint8), bitorder="little").tobytes()
        keys = np.array([_NO_ID if i is None else i for i in ids], "<i8").tobytes()
        with store.open_output_stream(f"{base}/{name}.idx.{attempt}") as idx:
            idx.write(len(lists).to_bytes(8, "little") + lists + null + keys)
        for kind in ("ids", "idx"):
            store.move(f"{base}/{name}.{kind}.{attempt}", f"{base}/{name}.{kind}")
        yield pa.RecordBatch.from_pydict({"shard": [n], "docs": [len(ends)], "tokens": [total]},
                                         pa.schema([("shard", pa.int32()), ("docs", pa.int64()), ("tokens", pa.int64())]))
    return write


def write_token_files(docs: DataFrame, folder: str, tokenizer_path: str, *, id_col: str = "doc_id",
                      text_col: str = "text", end_id: int = 1, pieces: bool = True) -> list[dict]:
    """Write the shards; returns the manifest: (shard, docs, tokens, start, width) in id order."""
    ship_package(docs.sparkSession)
    width = 2 if max(vocabulary_size(tokenizer_path) - 1, end_id) < 1 << 16 else 4
    # the text's hash spreads rows that share an id, in ties and between shards
    rows = (docs.select(F.col(f"`{id_col}`").cast("long").alias("i"), F.col(f"`{text_col}`").alias("t"))
            .withColumn("h", F.xxhash64("t")))
    rows = rows.repartitionByRange("i", "h").sortWithinPartitions(F.col("i").asc_nulls_first(), "h", "t")
    rows = rows.select("i", F.col("t").cast("binary").alias("t"))
    done = rows.mapInArrow(_writer(folder, tokenizer_path, end_id, width, pieces), "shard int, docs bigint, tokens bigint")
    manifest, start = [], 0
    for r in sorted(done.collect()):  # one row a shard
        manifest.append({"shard": r["shard"], "docs": r["docs"], "tokens": r["tokens"], "start": start, "width": width})
        start += r["tokens"]
    return manifest


class Shard:
    """Random access to one shard's documents."""

    def __init__(self, folder: str, shard: int, width: int):
        self.store, base = filesystem(folder)
        self.path, self.dtype = f"{base}/{shard:06d}.ids", np.dtype(f"<u{width}")
        with self.store.open_input_stream(f"{base}/{shard:06d}.idx") as f:
            data = f.read()
        n = int.from_bytes(data[:8], "little")
        self.ends = elias_fano.EliasFano(data[8:8 + n])
        at = 8 + n + (len(self.ends) + 7) // 8
        self.null = np.unpackbits(np.frombuffer(data[8 + n:at], np.uint8), bitorder="little")
        self.keys = np.frombuffer(data, "<i8", len(self.ends), at)

    def __len__(self) -> int:
        return len(self.ends)

    def bounds(self, i: int) -> tuple[int, int]:
        return (self.ends.select(i - 1) if i else 0), self.ends.select(i)

    def doc_id(self, i: int) -> int | None:
        return None if self.null[i] else int(self.keys[i])

    def tokens(self, i: int) -> np.ndarray:
        start, end = self.bounds(i)
        with self.store.open_input_file(self.path) as f:
            return np.frombuffer(f.read_at((end - start) * self.dtype.itemsize, start * self.dtype.itemsize), self.dtype)

    def __iter__(self):
        """(doc_id, start in the shard, ids) in order, over one stream."""
        with self.store.open_input_stream(self.path, buffer_size=1 << 20) as f:
            start = 0
            for i, end in enumerate(self.ends):
                yield self.doc_id(i), start, np.frombuffer(f.read((end - start) * self.dtype.itemsize), self.dtype)
                start = end
            if f.read(1):
                raise ValueError(f"{self.path} is longer than its boundaries")


def _reader(folder: str):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in b.to_pylist():
                rows = []
                for doc, start, ids in Shard(folder, row["shard"], row["width"]):
                    rows.append({"doc_id": doc, "start": row["start"] + start, "n_tokens": len(ids),
                                 "ids_crc32": zlib.crc32(ids.astype("<u4").tobytes())})
                    if len(rows) == 4096:
                        yield pa.RecordBatch.from_pylist(rows, _READ)
                        rows = []
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, _READ)
    return read


_READ = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])


def read_token_files(spark: SparkSession, folder: str, manifest: list[dict]) -> DataFrame:
    """One row a document, from the files: doc_id, start, n_tokens, ids_crc32."""
    ship_package(spark)
    schema = "shard int, docs bigint, tokens bigint, start bigint, width int"
    shards = spark.createDataFrame([tuple(m[k] for k in ("shard", "docs", "tokens", "start", "width")) for m in manifest], schema)
    shards = shards.repartition(max(1, len(manifest)))
    return shards.mapInArrow(_reader(folder), "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")
