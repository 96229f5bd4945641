"""Alignment of two tokenizers' tokens, scored by corpus-wide pair counts.

Both tokenizers encode a text with a space before it. Where tokens of both end
at the same byte, the text is cut into groups; within a group every token of A
is linked with every token of B. A pair of ids counts the documents that hold
it linked.

Encoding. Neither tokenizer joins a visible character with a blank after it, so
a long text is cut at single blanks and its blocks are encoded by themselves.
Such a cut ends a group. Where A's ids ascend as its merges do and its pattern needs
no character properties, a library that merges by rank encodes A; else the tokenizer does.

Inverted bitmaps. A chunk numbers its documents; each pair has one bitmap of
them per binary digit of the number of times it is linked (multiplicity planes). A
bitmap is a sorted list of numbers or a field of bits, whichever is shorter.
The planes of a pair, merged by OR, are its documents, and their popcount is
the pair's count in the chunk; chunks hold different documents, so counts add.

Scores. Counts are summed per pair and compared per id of A; they go back to the
chunks, whose planes return them to the documents: plane k adds 2^k times the
score. The planes are stored by chunk and are not shuffled.

How it scales: a frequent pair is one row per chunk, and no text, token or link
is shuffled. Per id of A there are as many pairs as B has ids, at most. A chunk
ends after ``CHUNK`` characters, or ``PLACES`` documents, or with the text that
passes them.

Cases: texts that are null or empty, and texts whose tokens of A or B do not spell
them (a text with U+2581 for one), have no tokens, zeros and an empty text of
groups. Special tokens in a text are plain text. Repeated rows are documents of
their own; extra columns are kept, those named like a result are replaced; an
empty table gives an empty result.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallymend.llm.byte_bpe import BLOCK, CUT, LATIN, sliced
from tallymend.llm.common import Memory, bucketed, text_or_empty
from tallymend.llm.token_files import byte_letters
from tallymend.llm.word_table import joined, tokenizer, vocabulary

A_VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
B_VOCABULARY = public_tokenizers.path("piece_bpe_32k.model")
# Characters and documents of a chunk; a place fits in 16 bits.
CHUNK = 16 << 20
PLACES = 1 << 16
ROWS = 256
# Bytes of words that a task remembers; pairs written at once.
WORDS = 16 << 20
TOGETHER = 1 << 14

# How B's vocabulary writes a blank and a single byte.
BLANK = "▁"
BYTE_PIECE = re.compile("<0x([0-9A-F]{2})>").fullmatch
# What a library with backtracking may not match.
LONG_RUN = re.compile(r"\s{10000}").search


# --- tokens


def merges_by_rank(path: str) -> bool:
    """Whether A takes texts as they are, by the public pattern, and its ids ascend as its merges do."""
    with open(path, encoding="utf-8") as lines:
        read = json.load(lines)
    split, model = read["pre_tokenizer"] or {}, read["model"]
    if read["normalizer"] or split.get("type") != "ByteLevel" or not split.get("use_regex", True):
        return False
    if split["add_prefix_space"] or model["type"] != "BPE":
        return False
    merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
    made = [model["vocab"][left + right] for left, right in merges]
    return made[:1] >= [256] and all(a < b for a, b in zip(made, made[1:], strict=False))


class Tokens:
    """Ids of A and B for a block of a text, what stands between two cuts."""

    def __init__(self, a_path: str, b_path: str):
        library = tokenizer(a_path)
        self._a_model = library.model
        self._a_split = library.pre_tokenizer.pre_tokenize_str
        self._letters = [letter for _, letter in sorted(byte_letters().items())]
        self._b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        self.a_bytes = dict(zip(*vocabulary(a_path).to_pydict().values(), strict=True))
        self.b_bytes = {}
        for i in range(self._b.get_piece_size()):
            piece = self._b.id_to_piece(i)
            if re.search(f"[^{BLANK}]{BLANK}", piece):
                raise ValueError(f"B has a token across a blank: {piece!r}")
            byte = BYTE_PIECE(piece) if self._b.is_byte(i) else None
            self.b_bytes[i] = (
                bytes.fromhex(byte[1]) if byte else piece.replace(BLANK, " ").encode()
            )
        self.a_sizes, self.b_sizes = (
            np.array([len(of.get(i, b"")) for i in range(max(of) + 1)], "i8")
            for of in (self.a_bytes, self.b_bytes)
        )
        self._b_pieces = pa.array([self.b_bytes[i] for i in range(len(self.b_bytes))], pa.binary())
        self._words = Memory(self._encode_word, WORDS)
        self._by_rank = None
        if merges_by_rank(a_path):
            special = library.get_added_tokens_decoder()
            ranks = {piece: i for i, piece in self.a_bytes.items() if i not in special}
            pattern = public_tokenizers.PATTERN
            by_rank = tiktoken.Encoding("a", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
            self._by_rank = by_rank.encode_ordinary

    def forget(self) -> None:
        """Empty the memory: Spark keeps its Python workers, and this object, from task to task."""
        self._words.clear()

    def _encode_word(self, word: str) -> bytes | None:
        """Ids of A; None if they do not spell the word."""
        data = word.encode()
        spelled = "".join(map(self._letters.__getitem__, data))
        ids = [t.id for t in self._a_model.tokenize(spelled)]
        if data != b"".join(map(self.a_bytes.__getitem__, ids)):
            return None
        return array("I", ids).tobytes()

    def _encode_a(self, text: str) -> np.ndarray | None:
        if self._by_rank and LATIN(text) and not LONG_RUN(text):
            return np.array(self._by_rank(text), "i8")
        found = [self._words[text[a:b]] for _, (a, b) in self._a_split(text)]
        return None if None in found else np.frombuffer(b"".join(found), "<u4").astype("i8")

    def encode(self, block: str) -> tuple[np.ndarray, np.ndarray] | None:
        """(ids of A, ids of B) of a block with the blank before it; None if they do not spell it."""
        text = " " + block
        b = np.array(self._b.encode(block), "i8")
        if joined(self._b_pieces.take(pa.array(b))) != text.encode():
            return None
        a = self._encode_a(text)
        return None if a is None else (a, b)


@lru_cache(maxsize=2)
def loaded(a_path: str, b_path: str) -> Tokens:
    """Read once by a worker, whatever its tasks do with it."""
    return Tokens(a_path, b_path)


def _blocks(text: str) -> Iterator[str]:
    at = 0
    while at < len(text):
        cut = CUT.search(text, at + BLOCK) if len(text) - at > BLOCK else None
        end = cut.start() if cut else len(text)
        yield text[at:end]
        # The blank of the cut belongs to the next block, which takes it back.
        at = end + 1 if cut else end


class Writer:
    """Writes groups as text: ids of A, a bar, ids of B; groups are separated by semicolons."""

    def __init__(self, tokens: Tokens):
        self._first_b = 2 * len(tokens.a_sizes)
        pieces = [f"{i}{mark}" for i in range(len(tokens.a_sizes)) for mark in ",|"]
        pieces += [f"{i}{mark}" for i in range(len(tokens.b_sizes)) for mark in ",;"]
        self._pieces = pa.array(pieces, pa.binary())

    def write(self, a: np.ndarray, b: np.ndarray, of_a: np.ndarray, of_b: np.ndarray) -> bytes:
        """``of_a`` and ``of_b`` are the groups of the tokens, ascending; a semicolon ends the text."""
        last_a = np.r_[of_a[1:] != of_a[:-1], True]
        last_b = np.r_[of_b[1:] != of_b[:-1], True]
        codes = np.empty(len(a) + len(b), "i8")
        # A token comes after the tokens of A up to its group and those of B in earlier groups.
        codes[np.arange(len(a)) + np.searchsorted(of_b, of_a)] = 2 * a + last_a
        codes[np.arange(len(b)) + np.searchsorted(of_a, of_b, side="right")] = (
            self._first_b + 2 * b + last_b
        )
        found = self._pieces.take(pa.array(codes))
        _, offsets, data = found.buffers()
        ends = np.frombuffer(offsets, "i4")
        return data.to_pybytes()[ends[found.offset] : ends[found.offset + len(found)]]


def _links(a, b, of_a, of_b, n_groups: int) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of A and B of every link."""
    in_b = np.bincount(of_b, minlength=n_groups)
    times = in_b[of_a]
    ends = np.cumsum(times)
    within = np.arange(ends[-1]) - np.repeat(ends - times, times)
    start = np.cumsum(in_b) - in_b
    return np.repeat(a, times), b[np.repeat(start[of_a], times) + within]


class Aligned:
    """One text: counts, its groups as text, and its pairs with the times they are linked."""

    def __init__(self, text: str, tokens: Tokens, writer: Writer):
        self.n_a = self.n_b = self.n_groups = 0
        self.groups, self.pairs, self.times = b"", np.empty(0, "i8"), np.empty(0, "i8")
        written, codes, times = [], [], []
        for block in _blocks(text):
            found = tokens.encode(block)
            if found is None:
                self.n_a = self.n_b = self.n_groups = 0
                return
            a, b = found
            a_ends, b_ends = np.cumsum(tokens.a_sizes[a]), np.cumsum(tokens.b_sizes[b])
            ends = np.intersect1d(a_ends, b_ends, assume_unique=True)
            of_a, of_b = np.searchsorted(ends, a_ends), np.searchsorted(ends, b_ends)
            left, right = _links(a, b, of_a, of_b, len(ends))
            some, counts = np.unique(left << 32 | right, return_counts=True)
            codes.append(some)
            times.append(counts)
            written.append(writer.write(a, b, of_a, of_b))
            self.n_a += len(a)
            self.n_b += len(b)
            self.n_groups += len(ends)
        if len(codes) == 1:
            self.pairs, self.times = codes[0], times[0]
        elif codes:
            self.pairs, back = np.unique(np.concatenate(codes), return_inverse=True)
            self.times = np.bincount(back, weights=np.concatenate(times)).astype("i8")
        self.groups = b"".join(written)[:-1]


# --- bitmaps of places


def bitmap(places: np.ndarray) -> bytes:
    """Ascending places as a list of 16-bit numbers, or as a field of bits where that is shorter."""
    if not len(places) or 2 * len(places) <= int(places[-1]) // 8 + 1:
        return b"L" + places.astype("<u2").tobytes()
    field = np.zeros(int(places[-1]) + 1, "u1")
    field[places] = 1
    return b"B" + np.packbits(field, bitorder="little").tobytes()


def places_of(data: bytes) -> np.ndarray:
    if data[:1] == b"L":
        return np.frombuffer(data, "<u2", offset=1)
    return np.flatnonzero(np.unpackbits(np.frombuffer(data, "u1", offset=1), bitorder="little"))


def popcount_of_union(bitmaps: list[bytes]) -> int:
    if len(bitmaps) == 1:
        data = bitmaps[0]
        if data[:1] == b"L":
            return (len(data) - 1) // 2
        return int(np.bitwise_count(np.frombuffer(data, "u1", offset=1)).sum())
    field = np.zeros(PLACES, bool)
    for data in bitmaps:
        field[places_of(data)] = True
    return int(np.count_nonzero(field))


def planes_of(places: np.ndarray, times: np.ndarray) -> list[bytes]:
    """Plane k holds the places whose number of times has the binary digit k."""
    digits = int(times.max()).bit_length()
    if digits == 1:
        return [bitmap(places)]
    return [bitmap(places[times >> k & 1 == 1]) for k in range(digits)]


# --- tables

COUNTS = ("n_a", "n_b", "n_groups", "n_links")


def align(
    docs: DataFrame,
    text: str = "text",
    a_path: str = A_VOCABULARY,
    b_path: str = B_VOCABULARY,
    chunk: int = CHUNK,
    places: int = PLACES,
) -> DataFrame:
    """Two kinds of rows, numbered by ``chunk``.

    A document has ``place``, ``row`` (its other columns), ``n_a``, ``n_b``,
    ``n_groups``, ``n_links`` and ``groups``, a text like ``a1,a2|b1;a3|b2,b3``. A
    pair of a chunk has ``a``, ``b``, ``planes`` and ``n_docs``.
    """
    kept = [c for c in docs.columns if c != text]
    rows = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in kept)).alias("row"), text_or_empty(text).alias("text")
    )
    row = T.StructField("row", rows.schema["row"].dataType)
    schema = T.StructType([T.StructField("chunk", T.LongType()), T.StructField("place", T.IntegerType()), row])
    for name in COUNTS:
        schema = schema.add(name, T.LongType())
    schema = schema.add("groups", T.StringType()).add("a", T.IntegerType()).add("b", T.IntegerType())
    schema = schema.add("planes", T.ArrayType(T.BinaryType())).add("n_docs", T.LongType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = loaded(a_path, b_path)
        writer, name, held, used = Writer(tokens), TaskContext.get().partitionId() << 32, 0, 0
        postings = []

        def table(n: int, like: pa.DataType, **given) -> pa.RecordBatch:
            types = [pa.int64(), pa.int32(), like, *[pa.int64()] * len(COUNTS), pa.string()]
            types += [pa.int32(), pa.int32(), pa.list_(pa.binary()), pa.int64()]
            given["chunk"] = [name] * n
            columns = [
                pa.nulls(n, t)
                if (own := given.get(c)) is None
                else own
                if isinstance(own, pa.Array)
                else pa.array(own, t)
                for c, t in zip(schema.names, types, strict=True)
            ]
            return pa.RecordBatch.from_arrays(columns, schema.names)

        def texts(found: list[Aligned], rows: pa.Array) -> pa.RecordBatch:
            return table(
                len(found),
                rows.type,
                place=list(range(used - len(found), used)),
                row=rows,
                n_a=[f.n_a for f in found],
                n_b=[f.n_b for f in found],
                n_groups=[f.n_groups for f in found],
                n_links=[int(f.times.sum()) for f in found],
                groups=[f.groups.decode() for f in found],
            )

        def pairs(like: pa.DataType) -> Iterator[pa.RecordBatch]:
            codes, at, times = (np.concatenate(c) for c in zip(*postings, strict=True))
            order = np.argsort(codes, kind="stable")
            codes, at, times = codes[order], at[order], times[order]
            starts = np.flatnonzero(np.r_[True, codes[1:] != codes[:-1]])
            stops = [*starts[1:].tolist(), len(codes)]
            spans = list(zip(starts.tolist(), stops, strict=True))
            for first in range(0, len(spans), TOGETHER):
                some = spans[first : first + TOGETHER]
                planes = [planes_of(at[i:j], times[i:j]) for i, j in some]
                own = codes[[i for i, _ in some]]
                yield table(
                    len(some),
                    like,
                    a=pa.array(own >> 32, pa.int32()),
                    b=pa.array(own & 0xFFFFFFFF, pa.int32()),
                    planes=planes,
                    n_docs=[popcount_of_union(p) for p in planes],
                )

        for batch in sliced(batches, ROWS):
            rows, found, start = batch.column("row"), [], 0
            for i, body in enumerate(batch.column("text").to_pylist()):
                one = Aligned(body, tokens, writer)
                if len(one.pairs):
                    postings.append((one.pairs, np.full(len(one.pairs), used, "u2"), one.times.astype("u4")))
                one.pairs = None
                found.append(one)
                used, held = used + 1, held + len(body)
                full = held >= chunk or used >= places
                if full or i == batch.num_rows - 1:
                    yield texts(found, rows.slice(start, len(found)))
                    found, start = [], i + 1
                if full:
                    if postings:
                        yield from pairs(rows.type)
                    postings, held, used, name = [], 0, 0, name + 1
        if postings:
            yield from pairs(rows.type)
        tokens.forget()

    return rows.mapInArrow(run, schema)


def score(aligned: DataFrame) -> DataFrame:
    """The documents of ``align``: their own columns, counts and what was added, and scores.

    ``n_best``: links whose count is the highest of their id of A, ties
    included. ``count_sum``: the counts of all links. Other columns of a
    document's row, such as a hash of its groups, are kept.
    """
    stored = bucketed(aligned, "chunk")
    own = [f for f in stored.schema if f.name not in ("chunk", "place", "row", "a", "b", "planes", "n_docs")]
    pairs = stored.where("a IS NOT NULL").select("chunk", "a", "b", "n_docs")
    counts = pairs.groupBy("a", "b").agg(F.sum("n_docs").alias("count"))
    # One partition of the window per id of A, with a row per id of B at most.
    best = F.col("count") == F.max("count").over(Window.partitionBy("a"))
    counts = counts.withColumn("best", best)
    # Named anew, so that its columns are not taken for those of ``stored``.
    scored = pairs.drop("n_docs").join(counts, ["a", "b"]).toDF("a", "b", "chunk", "count", "best")
    schema = T.StructType([stored.schema["row"], *own])
    schema = schema.add("n_best", T.LongType()).add("count_sum", T.LongType())

    def give(stored: pa.Table, scored: pa.Table) -> pa.Table:
        documents = stored.filter(stored.column("a").is_null()).sort_by("place")
        size = documents.num_rows
        n_best, count_sum = np.zeros(size, "i8"), np.zeros(size, "i8")
        met = {
            (a << 32) | b: (count, best)
            for a, b, count, best in zip(
                *(scored.column(c).to_pylist() for c in ("a", "b", "count", "best")), strict=True
            )
        }
        rows = stored.filter(stored.column("a").is_valid())
        for a, b, planes in zip(
            rows.column("a").to_pylist(), rows.column("b").to_pylist(), rows.column("planes"), strict=True
        ):
            count, best = met[(a << 32) | b]
            for k, plane in enumerate(planes):
                at = places_of(plane.as_py())
                count_sum[at] += count << k
                if best:
                    n_best[at] += 1 << k
        columns = {"row": documents.column("row")} | {f.name: documents.column(f.name) for f in own}
        return pa.table(columns | {"n_best": n_best, "count_sum": count_sum})

    found = stored.groupBy("chunk").cogroup(scored.groupBy("chunk")).applyInArrow(give, schema)
    names = [f.name for f in own] + ["n_best", "count_sum"]
    kept = [f.name for f in stored.schema["row"].dataType if f.name not in names]
    return found.select(*(F.col("row")[c].alias(c) for c in kept), *names)


def digest(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The counts and scores of every document, and a hash of its groups."""
    hashed = F.when(F.col("n_groups") > 0, F.sha2("groups", 256)).when(F.col("n_groups") == 0, "")
    aligned = align(docs.select(key, text), text)
    # Hashed before it is stored; the text of the groups is longer than the text.
    found = score(aligned.withColumn("groups_sha256", hashed).drop("groups"))
    return found.select(
        key, "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"
    )
