"""Byte-level BPE encoding and decoding by monoid tree reduction.

A piece of text (one match of the pre-split pattern) is cut in halves down to
short leaves. Leaves are merged by rank; neighbours are joined by re-encoding a
window over their boundary that grows until nothing outside it can change.

When may a join stop? Call a pair of tokens stable if merging the bytes of both
gives the two tokens again. A sequence of tokens, each of which merges make out
of its own bytes, is the encoding of its bytes exactly if all neighbours are
stable: up to the first merge across a border, both sides evolve as they would
alone, so that merge would happen in the pair as well. Tokens outside the
window come from correct encodings, so only the two borders of the window need
the test.

Decoding concatenates the bytes of the tokens, which needs no repair.

Cases: a null or empty text has no ids and decodes to nothing; repeated rows
are encoded each; extra columns are kept; an empty table gives an empty result.
A very long text is encoded block by block.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallymend.llm.common import Memory

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
# Leaves of at most so many bytes are merged directly.
LEAF = 16
# Bytes that a task remembers, characters that it splits at once, rows that it holds.
REMEMBERED = 24 << 20
BLOCK = 1 << 20
ROWS = 256
# A block may be cut before a blank between visible characters: a match that
# holds a visible character ends before it, and the next one starts with it.
CUT = re.compile(r"(?<=\S) (?=\S)")
# In these characters the public pattern needs no character properties, and the
# standard module splits several times faster.
LATIN = re.compile("[\n\t\x20-\x7eÀ-ÿ]*").fullmatch
LATIN_LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
LATIN_PIECES = re.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{LATIN_LETTERS}]+| ?[0-9]+| ?[^\s{LATIN_LETTERS}0-9]+|\s+(?!\S)|\s+"
).findall


class ByteBpe:
    def __init__(self, ranks: dict[bytes, int], pattern: str, leaf: int = LEAF):
        self.ranks, self.leaf = ranks, leaf
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self._library = tiktoken.Encoding(
            "ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}
        )
        self._split = regex.compile(pattern).findall
        self._quick = LATIN_PIECES if pattern == public_tokenizers.PATTERN else None
        self._own = Memory(self._merge_token, REMEMBERED // 6)
        self._stable = Memory(self._is_stable, REMEMBERED // 6)
        self._pieces = Memory(self._encode_piece, REMEMBERED)

    def forget(self) -> None:
        """Empty the memories: Spark keeps its Python workers, and this object, from task to task."""
        for memory in (self._own, self._stable, self._pieces):
            memory.clear()

    # --- one piece

    def _merge_token(self, token: bytes) -> list[int]:
        """Merges inside a token's own bytes; not every listed token comes out of them."""
        parts = [token[i : i + 1] for i in range(len(token))]
        while len(parts) > 1:
            least = min(
                (self.ranks.get(parts[i] + parts[i + 1], len(self.ranks)), i)
                for i in range(len(parts) - 1)
            )
            if least[0] == len(self.ranks):
                break
            parts[least[1] : least[1] + 2] = [parts[least[1]] + parts[least[1] + 1]]
        return [self.ranks[p] for p in parts]

    def merge(self, data: bytes) -> list[int]:
        """The merges of ``data`` in order of rank, without tree."""
        # The library takes a listed token as it is, the merges may not reach it.
        return self._own[data] if data in self.ranks else self._library._encode_single_piece(data)

    def _is_stable(self, pair: tuple[int, int]) -> bool:
        return self.merge(self.bytes_of[pair[0]] + self.bytes_of[pair[1]]) == list(pair)

    def join(self, left: list[int], right: list[int]) -> list[int]:
        """The tokens of two neighbours' bytes, from the tokens of each."""
        if not left or not right:
            return left + right
        if self._stable[left[-1], right[0]]:
            return left + right
        i = j = 1
        while True:
            window = b"".join(map(self.bytes_of.__getitem__, left[-i:] + right[:j]))
            middle = self.merge(window)
            left_holds = i == len(left) or self._stable[left[-i - 1], middle[0]]
            right_holds = j == len(right) or self._stable[middle[-1], right[j]]
            if left_holds and right_holds:
                return left[: len(left) - i] + middle + right[j:]
            i = i if left_holds else min(2 * i, len(left))
            j = j if right_holds else min(2 * j, len(right))

    def reduce(self, data: bytes) -> list[int]:
        """Tokens of ``data`` by halves."""
        if len(data) <= self.leaf:
            return self.merge(data)
        half = len(data) // 2
        return self.join(self.reduce(data[:half]), self.reduce(data[half:]))

    def _encode_piece(self, piece: str) -> bytes:
        data = piece.encode()
        rank = self.ranks.get(data)
        return np.array(self.reduce(data) if rank is None else [rank], "<u4").tobytes()

    # --- a text

    def encode(self, text: str | None) -> bytes:
        """Ids as little-endian 32-bit integers."""
        done, at, text = [], 0, text or ""
        while at < len(text):
            cut = CUT.search(text, at + BLOCK) if len(text) - at > BLOCK else None
            end = cut.start() if cut else len(text)
            block = text[at:end]
            split = self._quick if self._quick and LATIN(block) else self._split
            done.append(b"".join(map(self._pieces.__getitem__, split(block))))
            at = end
        return b"".join(done)

    def decode(self, ids) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


@lru_cache(maxsize=4)
def codec(path: str = RANKS, pattern: str = public_tokenizers.PATTERN) -> ByteBpe:
    with open(path, "rb") as lines:
        pairs = (line.split() for line in lines if line.strip())
        return ByteBpe({base64.b64decode(token): int(rank) for token, rank in pairs}, pattern)


def sliced(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """The batches in slices, so that what is made of one stays small."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def _lists(buffers: list[bytes]) -> pa.Array:
    offsets = np.zeros(len(buffers) + 1, "int32")
    np.cumsum([len(b) // 4 for b in buffers], out=offsets[1:])
    return pa.ListArray.from_arrays(offsets, np.frombuffer(b"".join(buffers), "<i4"))


def _decoded(bpe: ByteBpe, lists: pa.ListArray) -> pa.Array:
    flat, at = lists.values.to_numpy(), lists.offsets.to_numpy()
    found = [bpe.decode(flat[a:b].tolist()) for a, b in zip(at, at[1:], strict=False)]
    return pa.array(found, pa.binary())


def encode(
    docs: DataFrame,
    text: str = "text",
    path: str = RANKS,
    pattern: str = public_tokenizers.PATTERN,
    ids: str = "ids",
    data: str | None = None,
) -> DataFrame:
    """``docs`` with the text replaced by its ``ids``; every task works on its own rows.

    ``data`` also gives what the ids decode to, as ``decode`` would, by the same worker.
    """
    made = [ids] if data is None else [ids, data]
    kept = [c for c in docs.columns if c not in (text, *made)]
    schema = T.StructType([docs.schema[c] for c in kept]).add(ids, T.ArrayType(T.IntegerType()))
    if data is not None:
        schema = schema.add(data, T.BinaryType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = codec(path, pattern)
        try:
            for batch in sliced(batches, ROWS):
                found = _lists([bpe.encode(t) for t in batch.column(text).to_pylist()])
                columns = [*(batch.column(c) for c in kept), found]
                if data is not None:
                    columns.append(_decoded(bpe, found))
                yield pa.RecordBatch.from_arrays(columns, [*kept, *made])
        finally:
            bpe.forget()

    return docs.select(*kept, text).mapInArrow(run, schema)


def decode(
    tokens: DataFrame,
    ids: str = "ids",
    path: str = RANKS,
    pattern: str = public_tokenizers.PATTERN,
    data: str = "decoded",
) -> DataFrame:
    """``tokens`` with ``data``, the bytes of the ids."""
    schema = T.StructType([*tokens.drop(data).schema.fields]).add(data, T.BinaryType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = codec(path, pattern)
        for batch in sliced(batches, ROWS):
            found = _decoded(bpe, batch.column(ids))
            columns = [*(batch.column(f.name) for f in schema[:-1]), found]
            yield pa.RecordBatch.from_arrays(columns, [f.name for f in schema])

    return tokens.drop(data).mapInArrow(run, schema)


def id_text(ids: str = "ids") -> Column:
    """Decimal ids joined by commas."""
    return F.array_join(F.col(ids).cast("array<string>"), ",")


def digest(tokens: DataFrame, key: str = "doc_id") -> DataFrame:
    """Counts and hashes of the ids and the decoded bytes."""
    return tokens.select(
        key,
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(id_text(), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
