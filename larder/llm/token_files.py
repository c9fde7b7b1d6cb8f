"""Token ids in binary files of independent zstandard frames.

A file holds data frames (little-endian unsigned 32-bit ids), one skippable
frame with the index of its documents, and a last skippable frame with the seek
table of the public seekable zstandard layout: sizes and a checksum per frame,
then the frame count and a magic number.  Any zstandard reader can unpack such a
file; one that knows the tables unpacks only the frames of the documents asked for.
"""

from __future__ import annotations

import functools
import operator
import re
import string
import struct
import uuid
import zlib
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from larder.llm.common import Memo
from larder.session import scratch_path

# Fixed values of the seekable layout.
SKIPPABLE = 0x184D2A50
SEEK_TABLE = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1
HAS_CHECKSUMS = 0x80

FRAME_IDS = 1 << 16  # ids in a frame, a document longer than that goes over several
LEVEL = 3
CACHED_PIECES = 400_000  # per worker, twice
RANGE_CHARS = 16  # of a text, that may set the bounds of a file

_INDEX = np.dtype([("doc_id", "<i8"), ("has_id", "u1"), ("start", "<u8"), ("n", "<u8")])


# --- encoding -----------------------------------------------------------------

_TWO_SPACES = re.compile(r"\s\s")
_LONE_SPACE = re.compile(r"(?<=\S) (?=\S)")
_ID = operator.attrgetter("id")
_LETTERS = re.compile("[A-Za-zÀ-ÖØ-öø-ɏ]+")


def _byte_names() -> dict[int, str]:
    """How byte-level vocabularies spell bytes: printable ones as themselves, others as the next free characters."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = (b for b in range(256) if b not in shown)
    return {b: chr(b) for b in shown} | {b: chr(256 + n) for n, b in enumerate(hidden)}


class _Pieces(Memo):
    """Ids of text pieces, as bytes, filled from the tokenizer on demand.

    The tokenizer splits before it merges: a lone space opens a new part, a lone
    line feed is a part, and marks after a letter open one.  So pieces cut there
    can be encoded apart from their surroundings, and one of letters only is a
    part, which goes straight to the merges.  ``cut`` are the marks that no special
    token of the tokenizer holds.
    """

    def __init__(self, encode, merge, cut: str, lead: str = ""):
        super().__init__(CACHED_PIECES)
        self.encode, self.merge, self.cut, self.lead = encode, merge, cut, lead
        self.marks: dict[str, bytes] = {}

    def make(self, piece: str) -> bytes:
        if _LETTERS.fullmatch(piece):
            return self.merge(self.lead + piece)
        core = piece.rstrip(self.cut)
        if core == piece or not core or not core[-1].isalpha():
            return self.encode(self.lead + piece)
        marks = piece[len(core):]
        if marks not in self.marks:
            if len(marks) > 3:
                return self[core] + self.encode(marks)
            self.marks[marks] = self.encode(marks)
        return self[core] + self.marks[marks]


class Encoder:
    """``encode(text)`` gives exactly what the tokenizers library gives, as little-endian uint32 bytes."""

    # Encoded both ways at the start; a tokenizer that splits in another way encodes whole texts.
    PROBES = ("The été of 3.14 don't, we'll -- see:\nLine (two)...  x\t\u00a0y", " Ärger\n\nb1a2 C_d e-f", "a'b 'tis '' \"q\"! ###")

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model, self.names = self.tokenizer.model, str.maketrans({chr(b): name for b, name in _byte_names().items()})
        self.space = " ".translate(self.names)
        special = "".join(token.content for token in self.tokenizer.get_added_tokens_decoder().values())
        cut = "".join(mark for mark in string.punctuation if mark not in special)
        self.first, self.later = _Pieces(self._whole, self._merged, cut), _Pieces(self._whole, self._merged, cut, " ")
        self.line_feed = self._whole("\n")
        if any(self.encode(text) != self._whole(text) for text in self.PROBES):
            self.encode = self._whole

    def _whole(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _merged(self, part: str) -> bytes:
        if part.isascii():  # letters, with a space before them or not
            spelled = part if part[0] != " " else self.space + part[1:]
        else:
            spelled = part.encode().decode("latin-1").translate(self.names)
        return array("I", map(_ID, self.model.tokenize(spelled))).tobytes()

    def encode(self, text: str) -> bytes:
        if not text:
            return b""
        if _TWO_SPACES.search(text):  # runs of white space stay inside pieces
            first, *later = _LONE_SPACE.split(text)
            return self.first[first] + b"".join(map(self.later.__getitem__, later))
        parts: list[bytes] = []
        for line in text.split("\n"):
            if parts:
                parts.append(self.line_feed)
            first, *later = line.split(" ")
            parts.append(self.first[first] if first else b"")
            parts.extend(map(self.later.__getitem__, later))
        return b"".join(parts)


@functools.cache
def encoder(path: str) -> Encoder:
    return Encoder(path)


# --- one file -----------------------------------------------------------------


class Writer:
    """Appends documents to a stream; ``close`` adds the tables."""

    def __init__(self, stream):
        import zstandard

        self.stream = stream
        self.pack = zstandard.ZstdCompressor(level=LEVEL).compress
        self.waiting: list[bytes] = []
        self.n_waiting = 0
        self.n_ids = 0
        self.frames: list[tuple[int, int, int]] = []
        self.docs: list[tuple] = []

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self.docs.append((doc_id or 0, doc_id is not None, self.n_ids, len(ids) // 4))
        self.n_ids += len(ids) // 4
        self.waiting.append(ids)
        self.n_waiting += len(ids) // 4
        if self.n_waiting >= FRAME_IDS:
            self._flush()

    def _flush(self) -> None:
        import xxhash

        ids = memoryview(b"".join(self.waiting))
        for at in range(0, len(ids), FRAME_IDS * 4):
            part = ids[at : at + FRAME_IDS * 4]
            packed = self.pack(part)
            self.frames.append((len(packed), len(part), xxhash.xxh64_intdigest(part) & 0xFFFFFFFF))
            self.stream.write(packed)
        self.waiting, self.n_waiting = [], 0

    def close(self) -> None:
        self._flush()
        index = np.array(self.docs, _INDEX).tobytes()
        index = struct.pack("<Q", len(self.docs)) + self.pack(index)
        self.stream.write(struct.pack("<II", SKIPPABLE, len(index)) + index)
        table = b"".join(struct.pack("<III", *f) for f in self.frames)
        table += struct.pack("<IBI", len(self.frames), HAS_CHECKSUMS, SEEKABLE_MAGIC)
        self.stream.write(struct.pack("<II", SEEK_TABLE, len(table)) + table)
        self.stream.close()


class Reader:
    """Reads documents of one file (a seekable binary stream)."""

    def __init__(self, stream):
        import zstandard

        self.stream = stream
        self.unpack = zstandard.ZstdDecompressor().decompress
        size = stream.seek(0, 2)
        n, flags, magic = struct.unpack("<IBI", self._at(size - 9, 9))
        if magic != SEEKABLE_MAGIC or not flags & HAS_CHECKSUMS:
            raise ValueError("no seek table with checksums")
        table = np.frombuffer(self._at(size - 9 - 12 * n, 12 * n), "<u4").reshape(n, 3).astype(np.int64)
        self.offsets = np.concatenate([[0], np.cumsum(table[:, 0])])
        self.ids_upto = np.concatenate([[0], np.cumsum(table[:, 1]) // 4])
        self.checksums = table[:, 2]
        self.unpacked = table[:, 1]
        start = int(self.offsets[-1])
        kind, length = struct.unpack("<II", self._at(start, 8))
        if kind != SKIPPABLE:
            raise ValueError("no document index")
        body = self._at(start + 8, length)
        (n_docs,) = struct.unpack("<Q", body[:8])
        packed = self.unpack(body[8:], max_output_size=max(1, n_docs * _INDEX.itemsize))
        self.docs = np.frombuffer(packed, _INDEX, count=n_docs)

    def _at(self, offset: int, n: int) -> bytes:
        self.stream.seek(offset)
        return self.stream.read(n)

    def frame(self, k: int) -> bytes:
        import xxhash

        raw = self._at(int(self.offsets[k]), int(self.offsets[k + 1] - self.offsets[k]))
        ids = self.unpack(raw, max_output_size=int(self.unpacked[k]))
        if xxhash.xxh64_intdigest(ids) & 0xFFFFFFFF != self.checksums[k]:
            raise ValueError(f"frame {k} is damaged")
        return ids

    def read(self, rows: Iterable[int]) -> Iterator[bytes]:
        """The ids of documents by their place in the index; only their frames are unpacked."""
        held, ids = -1, b""
        for row in rows:
            start = int(self.docs["start"][row])
            stop = start + int(self.docs["n"][row])
            k, parts = int(np.searchsorted(self.ids_upto, start, "right")) - 1, []
            while start < stop:
                if k != held:
                    held, ids = k, self.frame(k)
                base, end = int(self.ids_upto[k]), min(stop, int(self.ids_upto[k + 1]))
                parts.append(ids[(start - base) * 4 : (end - base) * 4])
                start, k = end, k + 1
            yield b"".join(parts)


# --- many files ---------------------------------------------------------------


def _open(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


MANIFEST = "shard int, file string, n_docs long, n_ids long"


def write_token_files(docs: DataFrame, target: str, tokenizer: str, end_id: int = 0, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Write all documents in ascending key order; returns the manifest (shard, file, n_docs, n_ids).

    Files go to ``target``, a folder all executors reach.  Every task attempt
    writes files of its own; the manifest names those of the attempts that
    counted, so a retry after a lost executor leaves nothing double.  Null texts
    are empty (only the end id), null keys come first, rows with equal keys are
    ordered by text, repeated rows are written as often as they occur.  Ranges are
    set by the key and the first characters of the text, so their sample stays small.
    """
    spark = docs.sparkSession

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        bpe, end = encoder(tokenizer), struct.pack("<I", end_id)
        out, name, shard = None, "", TaskContext.get().partitionId()
        for batch in batches:
            for doc_id, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if out is None:
                    name = f"ids-{shard:06d}-{uuid.uuid4().hex}.zst"
                    files, path = _open(target)
                    files.create_dir(path, recursive=True)
                    out = Writer(files.open_output_stream(f"{path}/{name}", compression=None))
                out.add(doc_id, bpe.encode(value or "") + end)
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_pydict(
                {"shard": pa.array([shard], pa.int32()), "file": [name], "n_docs": [len(out.docs)], "n_ids": [out.n_ids]}
            )

    keyed = docs.select(F.col(key).cast("long").alias("k"), F.col(text).alias("t"), F.substring(text, 1, RANGE_CHARS).alias("h"))
    ordered = keyed.repartitionByRange("k", "h").sortWithinPartitions("k", "t").select("k", "t")
    manifest = f"{target}/manifest"
    ordered.mapInArrow(encode, MANIFEST).write.parquet(manifest)
    return spark.read.schema(MANIFEST).parquet(manifest)


def read_token_files(manifest: DataFrame, source: str) -> DataFrame:
    """Every document of the files: ``doc_id, start, n_tokens, ids_crc32``, from the stored ids.

    ``start`` counts the ids of all documents before.  The running sum over the
    manifest has one row per file.
    """

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, path = _open(source)
        for batch in batches:
            for name, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                with files.open_input_file(f"{path}/{name}") as stream:
                    reader = Reader(stream)
                    crcs = [zlib.crc32(ids) for ids in reader.read(range(len(reader.docs)))]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(reader.docs["doc_id"], mask=reader.docs["has_id"] == 0),
                            pa.array(reader.docs["start"].astype("i8") + base),
                            pa.array(reader.docs["n"].astype("i8")),
                            pa.array(crcs, pa.int64()),
                        ],
                        names=["doc_id", "start", "n_tokens", "ids_crc32"],
                    )

    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    files = manifest.select("file", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("base"))
    spread = files.repartition(max(1, manifest.sparkSession.sparkContext.defaultParallelism * 4))
    return spread.mapInArrow(decode, "doc_id long, start long, n_tokens long, ids_crc32 long")


def read_documents(source: str, file: str, rows: list[int]) -> list[np.ndarray]:
    """Some documents of one file, by their place in it; other frames stay packed."""
    files, path = _open(source)
    with files.open_input_file(f"{path}/{file}") as stream:
        return [np.frombuffer(ids, "<u4") for ids in Reader(stream).read(rows)]


def token_files(docs: DataFrame, tokenizer: str, end_id: int = 0, target: str | None = None) -> DataFrame:
    """Write the files, then read every document back from them."""
    spark: SparkSession = docs.sparkSession
    target = target or scratch_path(spark, "ids")
    return read_token_files(write_token_files(docs, target, tokenizer, end_id), target)
