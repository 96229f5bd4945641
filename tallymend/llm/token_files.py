"""Token ids in seekable files: independent zstandard frames and a trailing seek table.

One file, from its start:

    frame*       a zstandard frame of ids (little-endian 32 bit), then padding
    index        skippable: (key, first id, number of ids) of every document
    seek table   skippable: (offset, stored bytes, ids, crc32 of the ids' bytes) of every
                 frame; then where the index lies, the file's number and a magic

Everything but the frames of ids is skippable, so any zstandard reader gives the
plain ids. A reader that wants some documents reads the tail, then only the
frames that hold them, and checks each frame it has read.

Spark's text writer stores the rows of a task as they are, with its commit
protocol: a lost task leaves nothing behind. It ends each row with a line end;
the format makes that byte part of a skippable frame.

Documents are range-partitioned by key, so file after file they ascend. Rows of
one key are ordered by their text's hash; null keys come first. A null or empty
text is the end id alone. Repeated rows are documents of their own; extra
columns are not stored; an empty table gives no documents.
"""

from __future__ import annotations

import os
import re
import struct
import uuid
import zlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallymend.llm.byte_bpe import sliced
from tallymend.llm.common import Memory, shuffle_partitions
from tallymend.plans.durable import checkpoint_folder

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
END_ID = 2
# Bytes of ids in a frame; a longer document takes several.
FRAME = 1 << 18
# Rows that a worker holds as texts, and bytes of pieces that a task remembers.
ROWS = 256
REMEMBERED = 64 << 20

# Fixed values of the format.
LINE_END = b"\n"
SKIPPABLE = 0x184D2A50
MAGIC = b"TLMDIDS1"
FRAME_ENTRY = np.dtype([("offset", "<u8"), ("stored", "<u4"), ("ids", "<u4"), ("crc", "<u4")])
INDEX_ENTRY = np.dtype([("key", "<i8"), ("null", "u1"), ("first", "<u8"), ("ids", "<u8")])
TAIL = struct.Struct("<QIIQ8s")  # index offset, index bytes, frames, file number, magic


# --- encoding words


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in a byte-level vocabulary."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class WordEncoder:
    """Ids of a text, piece by piece: a token never crosses a piece.

    In Latin text the tokenizer's pieces are runs of letters, single digits and
    runs of marks, after lower-casing; equal pieces have equal ids, so the
    library's model spells a piece that is remembered once. A text with other characters,
    contractions or special tokens goes through the library word by word: its
    pieces never cross a blank or a line end.
    """

    LATIN = re.compile("[\n\t\x20-&(-\x7eÀ-ÿ]*").fullmatch
    PIECES = re.compile("[a-zß-öø-ÿ]+|[0-9]|[^\\sa-zß-öø-ÿ0-9]+").findall

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self._model = self.library.model
        self._letters = [letter for _, letter in sorted(byte_letters().items())]
        self._pieces = Memory(self._encode_piece, REMEMBERED)
        self._words = Memory(self._encode_word, REMEMBERED // 8)

    def forget(self) -> None:
        """Empty the memories: Spark keeps its Python workers from task to task."""
        for memory in (self._pieces, self._words):
            memory.clear()

    def _encode_piece(self, piece: str) -> bytes:
        # Visible ASCII characters are written as they are.
        spelled = piece
        if not piece.isascii():
            spelled = "".join(map(self._letters.__getitem__, piece.encode()))
        ids = [t.id for t in self._model.tokenize(spelled)]
        return struct.pack(f"<{len(ids)}I", *ids)

    def _encode_word(self, word: str) -> bytes:
        ids = self.library.encode(word, add_special_tokens=False).ids if word else []
        return np.array(ids, "<u4").tobytes()

    def encode(self, text: str | None) -> bytes:
        text = text or ""
        # Special tokens are the only ones that are matched before the pieces.
        if self.LATIN(text) and "<|" not in text:
            return b"".join(map(self._pieces.__getitem__, self.PIECES(text.lower())))
        return b"".join(map(self._words.__getitem__, text.replace("\n", " ").split(" ")))


@lru_cache(maxsize=2)
def word_encoder(path: str = VOCABULARY) -> WordEncoder:
    return WordEncoder(path)


# --- one file


def skippable(payload: bytes) -> bytes:
    """A skippable frame whose last byte is the line end that the writer adds."""
    return struct.pack("<II", SKIPPABLE, len(payload) + len(LINE_END)) + payload


def file_rows(documents: Iterable[tuple[int | None, bytes]], number: int) -> Iterator[bytes]:
    """The rows of one file; each is followed by a line end when it is stored."""
    pack = zstandard.ZstdCompressor(level=3, write_content_size=True).compress
    frames, index, offset, held, first = [], [], 0, bytearray(), 0

    def frame(data: bytes) -> bytes:
        nonlocal offset
        stored = pack(data)
        frames.append((offset, len(stored), len(data) // 4, zlib.crc32(data)))
        row = stored + skippable(b"")
        offset += len(row) + len(LINE_END)
        return row

    for key, data in documents:
        if held and len(held) + len(data) > FRAME:
            yield frame(bytes(held))
            held.clear()
        index.append((key or 0, key is None, first, len(data) // 4))
        first += len(data) // 4
        held += data
        while len(held) > FRAME:
            yield frame(bytes(held[:FRAME]))
            del held[:FRAME]
    if not index:
        return
    if held:
        yield frame(bytes(held))
    row = skippable(pack(np.array(index, INDEX_ENTRY).tobytes()))
    yield row
    tail = TAIL.pack(offset + 8, len(row) - 8, len(frames), number, MAGIC)
    yield skippable(np.array(frames, FRAME_ENTRY).tobytes() + tail)


class TokenFile:
    """Reads one file given as bytes, or as any object that slices like bytes."""

    def __init__(self, data):
        self.data = data
        end = len(data) - len(LINE_END)
        at, size, frames, self.number, magic = TAIL.unpack(bytes(data[end - TAIL.size : end]))
        if magic != MAGIC:
            raise ValueError("not a token file")
        end -= TAIL.size
        self.frames = np.frombuffer(
            bytes(data[end - frames * FRAME_ENTRY.itemsize : end]), FRAME_ENTRY
        )
        self.index = np.frombuffer(
            zstandard.ZstdDecompressor().decompress(bytes(data[at : at + size])), INDEX_ENTRY
        )
        self.ends = np.cumsum(self.frames["ids"], dtype="i8")

    @property
    def n_ids(self) -> int:
        return int(self.ends[-1]) if len(self.ends) else 0

    def _frame(self, i: int) -> bytes:
        entry = self.frames[i]
        at = int(entry["offset"])
        data = zstandard.ZstdDecompressor().decompress(
            bytes(self.data[at : at + int(entry["stored"])])
        )
        if zlib.crc32(data) != entry["crc"]:
            raise ValueError(f"frame {i} of file {self.number} is damaged")
        return data

    def documents(self, keys: set | None = None) -> Iterator[tuple[int | None, int, bytes]]:
        """(key, first id, ids) of all documents, or of those in ``keys``."""
        last = (-1, b"")
        for key, null, first, count in self.index.tolist():
            name = None if null else key
            if keys is not None and name not in keys:
                continue
            at = int(np.searchsorted(self.ends, first, side="right"))
            parts, need, skip = [], count, first - (int(self.ends[at - 1]) if at else 0)
            while need:
                if last[0] != at:
                    last = (at, self._frame(at))
                part = last[1][4 * skip : 4 * (skip + need)]
                parts.append(part)
                need, skip, at = need - len(part) // 4, 0, at + 1
            yield name, first, b"".join(parts)


# --- tables


def write_tokens(
    docs: DataFrame,
    folder: str,
    key: str = "doc_id",
    text: str = "text",
    vocabulary: str = VOCABULARY,
    end_id: int = END_ID,
    files: int | None = None,
) -> None:
    """Store the ids of every document in ``folder``, ascending by key from file to file."""
    end = np.array([end_id], "<u4").tobytes()
    ordered = docs.select(
        F.col(key).cast("long").alias("key"),
        F.col(text).alias("text"),
        F.xxhash64(text).alias("tie"),
    )
    files = files or shuffle_partitions(docs.sparkSession)
    ordered = ordered.repartitionByRange(files, "key", "tie").sortWithinPartitions("key", "tie", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_encoder(vocabulary)

        def documents():
            for batch in sliced(batches, ROWS):
                keys, texts = batch.column("key").to_pylist(), batch.column("text").to_pylist()
                for name, body in zip(keys, texts, strict=True):
                    yield name, encoder.encode(body) + end

        try:
            for row in file_rows(documents(), TaskContext.get().partitionId()):
                yield pa.RecordBatch.from_pydict({"value": pa.array([row], pa.binary())})
        finally:
            encoder.forget()

    rows = ordered.mapInArrow(run, "value binary")
    # A cast of binary to string keeps the bytes; the writer stores them unchanged.
    rows.select(F.col("value").cast("string")).write.option("lineSep", LINE_END.decode()).text(folder)


def read_tokens(spark: SparkSession, folder: str, keys: Iterable | None = None) -> DataFrame:
    """(key, start, ids) of the stored documents, or of those in ``keys``.

    ``start`` counts the ids of all documents before; ``ids`` are little-endian
    32-bit integers. With ``keys`` only the frames that hold them are unpacked.
    """
    wanted = None if keys is None else set(keys)
    stored = spark.read.format("binaryFile").load(folder).select("content").where("length > 0")

    def sizes(batches):
        for batch in batches:
            found = [TokenFile(memoryview(data.as_buffer())) for data in batch.column("content")]
            yield pa.RecordBatch.from_pydict(
                {"file": [f.number for f in found], "n": [f.n_ids for f in found]}
            )

    def documents(batches):
        for batch in batches:
            for data in batch.column("content"):
                file = TokenFile(memoryview(data.as_buffer()))
                rows, held = [], 0
                for row in file.documents(wanted):
                    rows.append(row)
                    held += len(row[2])
                    if held > 1 << 24:
                        yield _rows(file.number, rows)
                        rows, held = [], 0
                yield _rows(file.number, rows)

    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    # One row of two numbers per file, and the number of files is a parameter.
    begins = stored.mapInArrow(sizes, "file long, n long").select(
        "file", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("begin")
    )
    found = stored.mapInArrow(documents, "file long, key long, first long, ids binary")
    return found.join(F.broadcast(begins), "file").select(
        "key", (F.col("begin") + F.col("first")).alias("start"), "ids"
    )


def _rows(number: int, rows: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            pa.array([number] * len(rows), pa.int64()),
            pa.array([r[0] for r in rows], pa.int64()),
            pa.array([r[1] for r in rows], pa.int64()),
            pa.array([r[2] for r in rows], pa.binary()),
        ],
        ["file", "key", "first", "ids"],
    )


def new_folder(spark: SparkSession) -> str:
    """A folder of its own below the shared checkpoint folder."""
    checkpoint_folder(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/tokens-{uuid.uuid4().hex}"


def digest(tokens: DataFrame, key: str = "doc_id") -> DataFrame:
    return tokens.select(
        F.col("key").alias(key),
        "start",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.crc32("ids").alias("ids_crc32"),
    )
