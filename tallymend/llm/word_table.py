"""BPE encoding and decoding through a table of distinct words.

Encoding. A byte-level tokenizer splits a text into words and encodes each of
them by itself, so equal words have equal ids.

1. Every task splits its texts and numbers the words of a chunk of texts in
   the order they come. A text becomes the numbers of its words; the chunk's
   distinct words are dealt into slices by a hash of the word.
2. The slices are shuffled. A slice holds all copies of its words, one from each
   chunk that has them; each distinct word is encoded once, and every chunk gets
   its ids back.
3. A chunk's ids meet its texts, where they are put in by position. The texts
   were stored by chunk, so they are not shuffled at all.

Decoding joins ids with the vocabulary, a table (id, piece) whose size the
tokenizer's file fixes: every task has it whole and takes the pieces of its ids.
``encode`` can decode as well, where the ids are put in: then they need not go
through a second Python worker.

How it scales: a word is one entry per chunk however often it occurs. A chunk
ends after ``CHUNK`` characters or with the text that passes them, and a slice
holds a share of the distinct words, so both fit in a worker; ``slices`` is a
parameter for vocabularies beyond some billions of words. Numbers are stored
before use, so a lost executor cannot number a chunk anew.

Cases: a null or empty text has no ids and decodes to nothing; repeated rows
are encoded each; extra columns are kept, those named like a result are
replaced; an empty table gives an empty result. Special tokens in a text become
their id, as the library does by default. Decoding passes over ids that the
vocabulary does not have and over nulls, and puts U+FFFD for bytes that are not UTF-8.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from tallymend.llm.byte_bpe import BLOCK, CUT, LATIN, LATIN_PIECES, sliced
from tallymend.llm.common import bucketed, text_or_empty
from tallymend.llm.token_files import byte_letters

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
# Characters of a chunk of texts, slices that its words are dealt into, rows that a worker holds.
CHUNK = 16 << 20
SLICES = 256
ROWS = 256


@lru_cache(maxsize=2)
def tokenizer(path: str) -> Tokenizer:
    """Read once by a worker, whatever its tasks do with it."""
    return Tokenizer.from_file(path)


class Splitter:
    """Cuts a text into special tokens and the words that the tokenizer encodes by themselves."""

    def __init__(self, path: str):
        library = tokenizer(path)
        special = sorted(
            (t.content for t in library.get_added_tokens_decoder().values()), key=len, reverse=True
        )
        self._special = re.compile("(" + "|".join(map(re.escape, special)) + ")") if special else None
        self._library = library.pre_tokenizer.pre_tokenize_str

    def words(self, text: str) -> Iterator[list[str]]:
        """The words of a text, block by block."""
        for i, part in enumerate(self._special.split(text) if self._special else [text]):
            if i % 2:
                yield [part]
                continue
            at = 0
            while at < len(part):
                cut = CUT.search(part, at + BLOCK) if len(part) - at > BLOCK else None
                end = cut.start() if cut else len(part)
                block = part[at:end]
                # In these characters the pattern needs no character properties.
                if LATIN(block):
                    yield LATIN_PIECES(block)
                else:
                    yield [block[a:b] for _, (a, b) in self._library(block)]
                at = end


class WordEncoder:
    """Ids of one word, or of a special token, as little-endian 32-bit integers."""

    def __init__(self, path: str):
        library = tokenizer(path)
        self._special = {t.content: i for i, t in library.get_added_tokens_decoder().items()}
        self._model = library.model
        self._letters = [letter for _, letter in sorted(byte_letters().items())]

    def __call__(self, word: str) -> bytes:
        if word in self._special:
            return struct.pack("<I", self._special[word])
        spelled = "".join(map(self._letters.__getitem__, word.encode()))
        ids = [t.id for t in self._model.tokenize(spelled)]
        return struct.pack(f"<{len(ids)}I", *ids)


class Numbers(dict):
    """Numbers words in the order they are first asked for."""

    def __missing__(self, word: str) -> int:
        self[word] = number = len(self)
        return number


def _pack(parts: list[bytes]) -> bytes:
    """Strings of bytes in one compressed string."""
    sizes = np.array([len(p) for p in parts], "<u4")
    return zstandard.compress(struct.pack("<I", len(parts)) + sizes.tobytes() + b"".join(parts), 1)


def _unpack(data: bytes) -> tuple[np.ndarray, bytes]:
    """(sizes, all bytes) of what ``_pack`` made."""
    data = zstandard.decompress(data)
    n = struct.unpack_from("<I", data)[0]
    return np.frombuffer(data, "<u4", n, 4).astype("i8"), data[4 + 4 * n :]


def _parts(data: bytes) -> list[bytes]:
    sizes, flat = _unpack(data)
    ends = np.cumsum(sizes).tolist()
    return [flat[a:b] for a, b in zip([0, *ends], ends, strict=False)]


def _columns(n: int, like: pa.DataType, **given: pa.Array) -> pa.RecordBatch:
    """``n`` rows of the numbered table; what is not given is null."""
    types = {
        "chunk": pa.int64(),
        "slice": pa.int32(),
        "words": pa.binary(),
        "numbers": pa.binary(),
        "row": like,
    }
    columns = [given.get(name, pa.nulls(n, dtype)) for name, dtype in types.items()]
    return pa.RecordBatch.from_arrays(columns, list(types))


def _word_rows(chunk: int, numbers: Numbers, slices: int, like: pa.DataType) -> pa.RecordBatch:
    """The words of a chunk by slice, and a row that says which slice each number went to."""
    dealt, slice_of = [[] for _ in range(slices)], np.empty(len(numbers), "<u4")
    for number, word in enumerate(map(str.encode, numbers)):
        slice_of[number] = own = zlib.crc32(word) % slices
        dealt[own].append(word)
    full = [i for i, words in enumerate(dealt) if words]
    packed = [_pack(dealt[i]) for i in full] + [zstandard.compress(slice_of.tobytes(), 1)]
    n = len(packed)
    return _columns(
        n,
        like,
        chunk=pa.array([chunk] * n, pa.int64()),
        slice=pa.array([*full, None], pa.int32()),
        words=pa.array(packed, pa.binary()),
    )


def _number(docs: DataFrame, path: str, chunk_size: int, slices: int) -> DataFrame:
    """From (row, text): rows of texts (chunk, numbers, row) and of words (chunk, slice, words)."""
    schema = T.StructType(
        [
            T.StructField("chunk", T.LongType()),
            T.StructField("slice", T.IntegerType()),
            T.StructField("words", T.BinaryType()),
            T.StructField("numbers", T.BinaryType()),
            T.StructField("row", docs.schema["row"].dataType),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        splitter, numbers, held = Splitter(path), Numbers(), 0
        chunk = TaskContext.get().partitionId() << 32
        for batch in sliced(batches, ROWS):
            rows, packed, start = batch.column("row"), [], 0
            for i, text in enumerate(batch.column("text").to_pylist()):
                found = [
                    np.fromiter(map(numbers.__getitem__, words), "<u4", len(words)).tobytes()
                    for words in splitter.words(text)
                ]
                packed.append(zstandard.compress(b"".join(found), 1))
                held += len(text)
                if held >= chunk_size or i == batch.num_rows - 1:
                    n = len(packed)
                    yield _columns(
                        n,
                        rows.type,
                        chunk=pa.array([chunk] * n, pa.int64()),
                        numbers=pa.array(packed, pa.binary()),
                        row=rows.slice(start, n),
                    )
                    packed, start = [], i + 1
                if held >= chunk_size:
                    yield _word_rows(chunk, numbers, slices, rows.type)
                    numbers.clear()
                    held, chunk = 0, chunk + 1
        if numbers:
            yield _word_rows(chunk, numbers, slices, rows.type)

    return docs.mapInArrow(run, schema)


def _encode_words(words: DataFrame, path: str) -> DataFrame:
    """(chunk, slice, ids) from (chunk, slice, words): every distinct word is encoded once.

    The rows of a slice come together; what it encoded is forgotten at its end.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, known, current = WordEncoder(path), {}, None
        for batch in sliced(batches, ROWS):
            found = []
            for name, data in zip(batch.column("slice").to_pylist(), batch.column("words"), strict=True):
                if name != current:
                    current, known = name, {}
                own = []
                for word in _parts(data.as_py()):
                    ids = known.get(word)
                    if ids is None:
                        ids = known[word] = encode(word.decode())
                    own.append(ids)
                found.append(_pack(own))
            columns = [batch.column("chunk"), batch.column("slice"), pa.array(found, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["chunk", "slice", "ids"])

    dealt = words.repartition("slice").sortWithinPartitions("slice")
    return dealt.mapInArrow(run, "chunk long, slice int, ids binary")


def _gather(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The pieces flat[starts[i]:starts[i] + sizes[i]] for the i of ``at``, one after the other."""
    own = sizes[at]
    ends = np.cumsum(own)
    total = int(ends[-1]) if len(ends) else 0
    return flat[np.arange(total) + np.repeat(starts[at] - ends + own, own)]


def _put_in(texts: DataFrame, tables: DataFrame, path: str | None) -> DataFrame:
    """(row, ids): by position, the ids of a chunk's words for each of its texts.

    With ``path`` also ``text``, what the ids spell in that vocabulary.
    """
    schema = T.StructType([texts.schema["row"], T.StructField("ids", T.BinaryType())])
    names = ["row", "ids"]
    if path is not None:
        schema, names = schema.add("text", T.StringType()), [*names, "text"]

    def put(texts: pa.Table, tables: pa.Table) -> pa.Table:
        meta = [w for w in texts.column("words") if w.is_valid]
        texts = texts.select(["numbers", "row"]).filter(pc.is_valid(texts.column("numbers")))
        flat, starts, sizes = np.empty(0, "<u4"), np.empty(0, "i8"), np.empty(0, "i8")
        if meta:
            unpacked = [_unpack(t.as_py()) for t in tables.sort_by("slice").column("ids")]
            slice_of = np.frombuffer(zstandard.decompress(meta[0].as_py()), "<u4")
            flat = np.frombuffer(b"".join(ids for _, ids in unpacked), "<u4")
            # A slice lists its words in the order of their numbers.
            order = np.argsort(slice_of, kind="stable")
            own = np.concatenate([s for s, _ in unpacked]) // 4
            sizes = np.empty(len(order), "i8")
            sizes[order] = own
            starts = np.empty(len(order), "i8")
            starts[order] = np.cumsum(own) - own
        done = []
        # The result leaves in small batches, so that neither side holds a chunk as one.
        for batch in sliced(texts.to_batches(), ROWS):
            found = [
                _gather(flat, starts, sizes, np.frombuffer(zstandard.decompress(n.as_py()), "<u4")).tobytes()
                for n in batch.column("numbers")
            ]
            columns = [batch.column("row"), pa.array(found, pa.binary())]
            if path is not None:
                columns.append(_spelled(found, path))
            done.append(pa.RecordBatch.from_arrays(columns, names))
        if not done:
            kinds = [texts.schema.field("row").type, pa.binary(), pa.string()]
            return pa.table([pa.array([], k) for k in kinds[: len(names)]], names)
        return pa.Table.from_batches(done)

    by_chunk = texts.groupBy("chunk").cogroup(tables.groupBy("chunk"))
    return by_chunk.applyInArrow(put, schema)


def encode(
    docs: DataFrame,
    text: str = "text",
    path: str = VOCABULARY,
    ids: str = "ids",
    chunk: int = CHUNK,
    slices: int = SLICES,
    data: str | None = None,
) -> DataFrame:
    """``docs`` with the text replaced by ``ids``, little-endian 32-bit integers.

    ``data`` also gives the text that the ids spell, as ``decode`` would, by the same worker.
    """
    made = {ids: "ids"} if data is None else {ids: "ids", data: "text"}
    kept = [c for c in docs.columns if c != text and c not in made]
    # In a struct, so that no column of the caller meets one of this module.
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in kept)).alias("row"), text_or_empty(text).alias("text"))
    numbered = bucketed(_number(rows, path, chunk, slices), "chunk")
    words = numbered.where("slice IS NOT NULL").select("chunk", "slice", "words")
    texts = numbered.where("slice IS NULL").select("chunk", "words", "numbers", "row")
    found = _put_in(texts, _encode_words(words, path), None if data is None else path)
    own = [F.col(c).alias(name) for name, c in made.items()]
    return found.select(*(F.col("row")[c].alias(c) for c in kept), *own)


def vocabulary(path: str = VOCABULARY) -> pa.Table:
    """(id, piece): the bytes of every id, special tokens included."""
    library = tokenizer(path)
    byte_of = {letter: b for b, letter in byte_letters().items()}
    special = {i: t.content.encode() for i, t in library.get_added_tokens_decoder().items()}
    pieces = {
        i: special[i] if i in special else bytes(map(byte_of.__getitem__, piece))
        for piece, i in library.get_vocab().items()
    }
    return pa.table({"id": pa.array(sorted(pieces), pa.int32()), "piece": [pieces[i] for i in sorted(pieces)]})


def decode(
    tokens: DataFrame, ids: str = "ids", path: str = VOCABULARY, data: str = "decoded"
) -> DataFrame:
    """``tokens`` with ``data``, the text that the ids spell."""
    schema = T.StructType([*tokens.drop(data).schema.fields]).add(data, T.StringType())
    at = tokens.drop(data).columns.index(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, ROWS):
            texts = _spelled([own.as_py() or b"" for own in batch.column(at)], path)
            yield pa.RecordBatch.from_arrays([*batch.columns, texts], schema.names)

    return tokens.drop(data).mapInArrow(run, schema)


@lru_cache(maxsize=2)
def _places(path: str) -> tuple[np.ndarray, pa.BinaryArray]:
    """Place of every id among the pieces; the last piece is an empty one, for other ids."""
    listed = vocabulary(path)
    places = np.full(int(listed.column("id")[-1].as_py()) + 2, listed.num_rows, "i8")
    places[np.asarray(listed.column("id"))] = np.arange(listed.num_rows)
    return places, pa.concat_arrays([*listed.column("piece").chunks, pa.array([b""])])


def _spelled(ids: list[bytes], path: str) -> pa.StringArray:
    """The texts that lists of ids spell."""
    places, pieces = _places(path)
    texts = []
    for own in ids:
        flat = np.frombuffer(own, "<u4")
        found = pieces.take(pa.array(places[np.minimum(flat, len(places) - 1)]))
        texts.append(joined(found).decode("utf-8", "replace"))
    return pa.array(texts, pa.string())


def joined(pieces: pa.BinaryArray) -> bytes:
    """All bytes of an array that was just taken, one piece after the other."""
    if not len(pieces):
        return b""
    _, offsets, data = pieces.buffers()
    ends = np.frombuffer(offsets, "i4")
    return data.to_pybytes()[ends[pieces.offset] : ends[pieces.offset + len(pieces)]]


def digest(tokens: DataFrame, key: str = "doc_id") -> DataFrame:
    """Counts and hashes of the ids and the decoded texts."""
    return tokens.select(
        key,
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.encode("decoded", "utf-8"), 256).alias("decoded_sha256"),
    )
