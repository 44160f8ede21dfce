"""Token ids in seekable binary files: independent zstandard frames, a trailing
seek table with a checksum per frame, and an index of documents.

File: data frames (whole documents, about ``frame_bytes`` of ids each, with
zstandard's own content checksum), then an index frame (skippable, holds an
Arrow table doc_id, frame, first, n_tokens compressed by zstandard), then the
seek table (skippable) in the public seekable format: per frame compressed
size, decompressed size and the low half of the XXH64 of its content; at the
very end the number of frames, a descriptor and the format's magic number.
A reader takes the footer, the index and only the frames it needs.

Ids are little-endian, two bytes each if the vocabulary allows, else four.

Encoding: the tokenizer's result does not depend on what stands across a space
or line break, so each piece between them is encoded by the tokenizers library
once per Python worker and remembered (a bounded dictionary; once it is full,
other pieces are encoded once per batch).  A full stop or comma after an ASCII letter is a piece of its own for the same reason.  This
holds for tokenizers that drop white space (``white_space_dropped``); others
encode whole texts.

Defined cases: null and empty texts have the end id only; null doc_ids come
first; rows that repeat a doc_id stand next to each other, ordered by text; an
empty table gives no file and an empty report; other columns are ignored.
"""

from __future__ import annotations

import os
import struct
import sys
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bound_batches, shared_folder, small_batches
from .storage import new_file, random_access, read_range

# The public seekable format of zstandard.
SKIPPABLE_SEEK_TABLE = 0x184D2A5E
SKIPPABLE_INDEX = 0x184D2A5D
SEEKABLE_MAGIC = 0x8F92EAB1
HAS_CHECKSUMS = 0x80

MANIFEST = "part int, path string, documents long, tokens long, bytes long, width int"
REPORT = "doc_id long, start long, n_tokens long, ids_crc32 long"


class Encoder:
    """Texts to ids of a ``tokenizers`` file, as little-endian bytes."""

    def __init__(self, path: str, white_space_dropped: bool = True, remember: int = 400_000) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs one task per core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.width = 2 if self.tokenizer.get_vocab_size(with_added_tokens=True) <= 1 << 16 else 4
        self.code = {2: "H", 4: "I"}[self.width]
        self.white_space_dropped = white_space_dropped
        self.remember = remember
        self.known: dict[str, bytes] = {"": b""}
        # which ids end a word, if the vocabulary marks word ends
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        self.word_ends = None
        if suffix and white_space_dropped:
            vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
            self.word_ends = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
            self.word_ends[[i for token, i in vocabulary.items() if token.endswith(suffix)]] = True

    def _bytes(self, ids: list[int]) -> bytes:
        coded = array(self.code, ids)
        if sys.byteorder == "big":
            coded.byteswap()
        return coded.tobytes()

    def _encode(self, texts: list[str]) -> list[bytes]:
        return [self._bytes(e.ids) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _encode_pieces(self, pieces: list[str]) -> dict[str, bytes]:
        """Ids of pieces without white space.  Words of letters go 256 to a text:
        each has one id that ends a word, its last."""
        out: dict[str, bytes] = {}
        # (the lower-case form of the dotted capital I is not all letters)
        plain = [w for w in pieces if w.isalpha() and "\u0130" not in w] if self.word_ends is not None else []
        groups = [plain[i : i + 256] for i in range(0, len(plain), 256)]
        for group, e in zip(groups, self.tokenizer.encode_batch_fast([" ".join(g) for g in groups], add_special_tokens=False), strict=True):
            ids = np.array(e.ids, dtype=f"<u{self.width}")
            ends = (np.flatnonzero(self.word_ends[ids]) + 1) * self.width
            if len(ends) != len(group) or ends[-1] != len(ids) * self.width:
                continue
            coded, at = ids.tobytes(), 0
            for word, to in zip(group, ends.tolist(), strict=True):
                out[word] = coded[at:to]
                at = to
        rest = [w for w in pieces if w not in out]
        out.update(zip(rest, self._encode(rest), strict=True))
        return out

    def __call__(self, texts: list[str], end_id: int) -> list[bytes]:
        end = self._bytes([end_id])
        if not self.white_space_dropped:
            return [ids + end for ids in self._encode(texts)]
        get, out, open_texts = self.known.get, [], []
        for t in texts:
            words = t.replace("\n", " ").split(" ")
            ids = list(map(get, words))
            if None in ids:
                open_texts.append((len(out), words, ids))
                out.append(b"")
            else:
                out.append(b"".join(ids) + end)
        if open_texts:
            found = self._new_pieces({w for _, words, ids in open_texts for w, x in zip(words, ids, strict=True) if x is None})
            for at, words, ids in open_texts:
                out[at] = b"".join([found[w] if x is None else x for w, x in zip(words, ids, strict=True)]) + end
        return out

    def _new_pieces(self, words: set[str]) -> dict[str, bytes]:
        known = self.known
        stems = {w: w[:-1] for w in words if w[-1] in ".," and len(w) > 1 and w[-2].isascii() and w[-2].isalpha()}
        needed = (words - stems.keys()) | {x for x in stems.values() if x not in known} | ({".", ","} - known.keys())
        found = self._encode_pieces(list(needed))
        for w, stem in stems.items():
            found[w] = (found.get(stem) or known[stem]) + (found.get(w[-1]) or known[w[-1]])
        if len(known) + len(found) <= self.remember:
            known.update(found)
        return found


@lru_cache(maxsize=2)
def shared_encoder(path: str, white_space_dropped: bool) -> Encoder:
    """One encoder per Python worker, which runs many tasks one after another."""
    return Encoder(path, white_space_dropped)


class TokenFileWriter:
    def __init__(self, out: pa.NativeFile, width: int, frame_bytes: int = 1 << 18, level: int = 3) -> None:
        self.out, self.width, self.frame_bytes = out, width, frame_bytes
        self.zstd = zstandard.ZstdCompressor(level=level, write_checksum=True, write_content_size=True)
        self.held: list[bytes] = []
        self.held_bytes = 0
        self.table = bytearray()
        self.frames = 0
        self.size = 0
        self.tokens = 0
        self.index: dict[str, list] = {"doc_id": [], "frame": [], "first": [], "n_tokens": []}

    def add(self, doc_id: int | None, ids: bytes) -> None:
        for name, value in (("doc_id", doc_id), ("frame", self.frames), ("first", self.held_bytes // self.width), ("n_tokens", len(ids) // self.width)):
            self.index[name].append(value)
        self.held.append(ids)
        self.held_bytes += len(ids)
        self.tokens += len(ids) // self.width
        if self.held_bytes >= self.frame_bytes:
            self._frame()

    def _entry(self, written: bytes, content: bytes) -> None:
        self.out.write(written)
        self.size += len(written)
        self.table += struct.pack("<III", len(written), len(content), xxhash.xxh64_intdigest(content) & 0xFFFFFFFF)
        self.frames += 1

    def _frame(self) -> None:
        if self.held:
            content = b"".join(self.held)
            self._entry(self.zstd.compress(content), content)
            self.held, self.held_bytes = [], 0

    def close(self) -> None:
        self._frame()
        index = pa.table(self.index, schema=pa.schema([("doc_id", pa.int64()), ("frame", pa.int32()), ("first", pa.int64()), ("n_tokens", pa.int64())]))
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, index.schema.with_metadata({"width": str(self.width)})) as stream:
            stream.write_table(index.replace_schema_metadata({"width": str(self.width)}))
        packed = self.zstd.compress(sink.getvalue().to_pybytes())
        self._entry(struct.pack("<II", SKIPPABLE_INDEX, len(packed)) + packed, b"")
        footer = struct.pack("<IBI", self.frames, HAS_CHECKSUMS, SEEKABLE_MAGIC)
        tail = struct.pack("<II", SKIPPABLE_SEEK_TABLE, len(self.table) + len(footer)) + bytes(self.table) + footer
        self.out.write(tail)
        self.size += len(tail)


class TokenFileReader:
    """Reads the footer, the seek table and the index; frames on request."""

    def __init__(self, f: pa.NativeFile) -> None:
        self.f = f
        size = f.size()
        frames, _, magic = struct.unpack("<IBI", read_range(f, size - 9, 9))
        if magic != SEEKABLE_MAGIC:
            raise ValueError("no seek table at the end of the file")
        table = read_range(f, size - 9 - 12 * frames, 12 * frames)
        self.entries = np.frombuffer(table, dtype="<u4").reshape(frames, 3)
        self.offsets = np.concatenate([[0], np.cumsum(self.entries[:, 0], dtype=np.int64)])
        packed = read_range(f, int(self.offsets[-2]), int(self.entries[-1, 0]))
        kind, length = struct.unpack("<II", packed[:8])
        if kind != SKIPPABLE_INDEX or length != len(packed) - 8:
            raise ValueError("no index frame before the seek table")
        self.zstd = zstandard.ZstdDecompressor()
        self.index = pa.ipc.open_stream(self.zstd.decompress(packed[8:])).read_all()
        self.dtype = np.dtype(f"<u{int(self.index.schema.metadata[b'width'])}")
        self._last: tuple[int, np.ndarray] | None = None

    def frame(self, k: int) -> np.ndarray:
        """Ids of one frame, checked against the table's checksum."""
        if self._last is None or self._last[0] != k:
            size, full, check = map(int, self.entries[k])
            content = self.zstd.decompress(read_range(self.f, int(self.offsets[k]), size), max_output_size=full)
            if len(content) != full or xxhash.xxh64_intdigest(content) & 0xFFFFFFFF != check:
                raise ValueError(f"frame {k} does not match its checksum")
            self._last = (k, np.frombuffer(content, dtype=self.dtype))
        return self._last[1]

    def documents(self, rows: list[int] | None = None) -> Iterator[tuple[int | None, np.ndarray]]:
        """(doc_id, ids) of the index rows asked for, or of all."""
        t = self.index if rows is None else self.index.take(pa.array(rows, pa.int64()))
        for doc_id, frame, first, n in zip(*(t.column(c).to_pylist() for c in ("doc_id", "frame", "first", "n_tokens")), strict=True):
            yield doc_id, self.frame(frame)[first : first + n]

    def find(self, doc_ids: set[int]) -> Iterator[tuple[int | None, np.ndarray]]:
        """Documents by id; only their frames are read."""
        yield from self.documents([i for i, d in enumerate(self.index.column("doc_id").to_pylist()) if d in doc_ids])


def _write_part(folder: str, tokenizer: str, end_id: int, frame_bytes: int, white_space_dropped: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        path = f"{folder}/part-{part:06d}.tok.zst"
        rows = (b for b in small_batches(batches) if b.num_rows)
        first = next(rows, None)
        if first is None:
            return
        encode = shared_encoder(tokenizer, white_space_dropped)
        documents = 0
        with new_file(path) as out:
            writer = TokenFileWriter(out, encode.width, frame_bytes)
            batch: pa.RecordBatch | None = first
            while batch is not None:
                texts = [t or "" for t in batch.column(1).to_pylist()]
                for doc_id, ids in zip(batch.column(0).to_pylist(), encode(texts, end_id), strict=True):
                    writer.add(doc_id, ids)
                documents += batch.num_rows
                batch = next(rows, None)
            writer.close()
        yield pa.RecordBatch.from_pylist(
            [{"part": part, "path": path, "documents": documents, "tokens": writer.tokens, "bytes": writer.size, "width": encode.width}],
            schema=pa.schema([("part", pa.int32()), ("path", pa.string()), ("documents", pa.int64()), ("tokens", pa.int64()), ("bytes", pa.int64()), ("width", pa.int32())]),
        )

    return run


def write_token_files(docs: DataFrame, folder: str, tokenizer: str, end_id: int = 1, frame_bytes: int = 1 << 18,
                      white_space_dropped: bool = True) -> list[dict]:
    """Writes the ids of all texts in ascending doc_id order, one file per
    range of ids.  Returns the manifest in file order: one entry per file,
    with the number of ids in all files before it (``start``)."""
    bound_batches(docs.sparkSession)
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        .repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id", "text")
    )
    written = ordered.mapInArrow(_write_part(folder, tokenizer, end_id, frame_bytes, white_space_dropped), MANIFEST).collect()
    manifest, start = [], 0
    for row in sorted(written, key=lambda r: r["part"]):  # one row per file
        manifest.append(row.asDict() | {"start": start})
        start += row["tokens"]
    return manifest


def _report_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            with random_access(path) as f:
                reader = TokenFileReader(f)
                at, out = start, {"doc_id": [], "start": [], "n_tokens": [], "ids_crc32": []}
                for doc_id, ids in reader.documents():
                    for name, value in (("doc_id", doc_id), ("start", at), ("n_tokens", len(ids)), ("ids_crc32", zlib.crc32(ids.astype("<u4").tobytes()))):
                        out[name].append(value)
                    at += len(ids)
            yield pa.RecordBatch.from_pydict(out, schema=pa.schema([(c.split()[0], pa.int64()) for c in REPORT.split(", ")]))


def read_report(spark: SparkSession, manifest: list[dict]) -> DataFrame:
    """One row per document, read back from the files."""
    files = spark.createDataFrame([(m["path"], m["start"]) for m in manifest], "path string, start long")
    return files.repartition(max(1, len(manifest)), "path").mapInArrow(_report_parts, REPORT)


def token_file_report(docs: DataFrame, tokenizer: str, end_id: int = 1, folder: str | None = None, **options) -> DataFrame:
    """Writes the files (by default below the shared folder) and reads them back."""
    spark = docs.sparkSession
    return read_report(spark, write_token_files(docs, folder or shared_folder(spark, "token-files"), tokenizer, end_id, **options))
