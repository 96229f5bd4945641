"""Removal of long repeated byte strings, by prefix-free parsing.

A string of ``length`` bytes that starts at two places, anywhere in the corpus,
is repeated; every byte that a repeated string covers goes.

Parsing. A rolling hash of eight bytes sets triggers: within every string the
least hash among its first places triggers. So a string alone, wherever it
stands, decides where its trigger is; the places that share a trigger are a
phrase, phrases have a bounded length in any text, and equal strings lie in
phrases with the same trigger bytes.

Order. Suffixes that agree for ``length`` bytes are neighbours in the corpus
order that the suffix arrays of dictionary and parse combine to. Only whether
neighbours agree matters here, not which comes first, so ranks give way to
classes of equal context, taken from coarse to fine:

1. the dictionary: the bytes from the trigger on that all strings of a phrase
   contain. A phrase whose bytes stand nowhere else holds no repeated string;
2. the phrase with all strings that start in it. Where that stands twice, all
   of them are repeated;
3. what is left are phrases near the ends of a repeated passage. There the
   strings themselves are compared, each distinct phrase giving them once.

How it scales: a class is counted by the smallest and largest place of its
members, reduced before the shuffle, so a passage in a third of all rows is one
row per task. Phrases travel as hashes and numbers, texts only in joins by
document. Equal texts are one text: with a second copy all of it is repeated.

Shorter passages. Passages of more than 50 words that documents share are often
shorter than ``length`` bytes. ``Passage`` reports the documents that have one, by
anchors: in every run of words the least hash of its shingles.

Cases: a null text is empty; a text shorter than ``length`` is kept whole;
repeated rows are copies of each other, so both go; extra columns are not read;
an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymend.llm.byte_bpe import sliced
from tallymend.llm.common import bucketed, text_or_empty
from tallymend.plans.durable import durable

GRAM = 8
# Bytes of a text that are parsed at once; a place fits in the low bits of a trigger's key.
CHUNK = 1 << 22
PLACE = np.uint64((1 << 24) - 1)
ROWS = 256


@dataclass(frozen=True)
class Repeat:
    """``length``: bytes of a repeated string. ``reach``: places of a string that may trigger."""

    length: int = 400
    reach: int = 300

    @property
    def shared(self) -> int:
        """Bytes from the trigger on that lie in every string it belongs to."""
        return self.length - self.reach + 1


@dataclass(frozen=True)
class Passage:
    """A passage that documents share, shorter than what is removed.

    Every run of ``words`` words that two documents have is found; what is found
    are runs of ``shingle`` words at least, or equal texts of ``words`` words.
    """

    words: int = 51
    shingle: int = 32


def _least(keys: np.ndarray, width: int) -> np.ndarray:
    """The minimum of every ``width`` neighbours: of a block's end and the next one's begin."""
    n = len(keys) - width + 1
    padded = np.full(-(-len(keys) // width) * width, np.iinfo("u8").max, "u8")
    padded[: len(keys)] = keys
    blocks = padded.reshape(-1, width)
    begin = np.minimum.accumulate(blocks, axis=1).ravel()
    end = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(end[:n], begin[width - 1 : width - 1 + n])


def phrases(data: bytes, how: Repeat) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(trigger, first, last): strings that start at first..last have their trigger there."""
    parts = []
    strings = len(data) - how.length + 1
    for at in range(0, max(strings, 0), CHUNK):
        end = min(strings, at + CHUNK)
        # The places that may trigger for strings at..end-1, and their grams.
        v = np.frombuffer(data[at : end + how.reach - 1 + GRAM - 1], "u1").astype("u8")
        v = v[:-1] | (v[1:] << np.uint64(8))
        v = v[:-2] | (v[2:] << np.uint64(16))
        v = v[:-4] | (v[4:] << np.uint64(32))
        v = (v ^ (v >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)
        v = (v ^ (v >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        keys = (v & ~PLACE) | np.arange(len(v), dtype="u8")
        trigger = (_least(keys, how.reach) & PLACE).astype("i8")
        first = np.flatnonzero(np.r_[True, trigger[1:] != trigger[:-1]])
        last = np.r_[first[1:], len(trigger)] - 1
        parts.append((trigger[first] + at, first + at, last + at))
    if not parts:
        return (np.empty(0, "i8"),) * 3
    return tuple(np.concatenate(c) for c in zip(*parts, strict=True))


def _hash(data: bytes) -> int:
    return xxhash.xxh3_64_intdigest(data)


def _phrase_rows(docs: DataFrame, how: Repeat) -> DataFrame:
    """(core, whole, place, tid, trigger, first, last) of every phrase of ``docs`` (tid, text).

    ``core`` hashes the shared bytes, ``whole`` all bytes of the phrase's
    strings, ``place`` stands for text and trigger.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, ROWS):
            rows, counts, spots = [], [], []
            for text in batch.column("text"):
                data = text.as_buffer().to_pybytes()
                found = phrases(data, how)
                counts.append(len(found[0]))
                spots.append(np.stack(found))
                for a, lo, hi in zip(*(c.tolist() for c in found), strict=True):
                    rows.append(
                        (
                            _hash(data[a : a + how.shared]),
                            _hash(data[lo : hi + how.length]) ^ (a - lo),
                        )
                    )
            if rows:
                hashes = np.array(rows, "u8").T.view("i8")
                where = np.concatenate(spots, axis=1)
                tid = np.repeat(np.asarray(batch.column("tid")), counts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c) for c in (*hashes, tid)] + [pa.array(c) for c in where],
                    ["core", "whole", "tid", "trigger", "first", "last"],
                )

    made = docs.mapInArrow(
        run, "core long, whole long, tid long, trigger long, first long, last long"
    )
    return made.withColumn("place", F.xxhash64("tid", "trigger"))


def _contexts(texts: DataFrame, wanted: DataFrame, how: Repeat) -> DataFrame:
    """(core, tid, first, lone, data): the bytes of all strings of the phrases in ``wanted``.

    ``wanted`` has (tid, doc, spots), spots being (core, first, last, lone).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, ROWS):
            tids, spots = batch.column("tid").to_pylist(), batch.column("spots").to_pylist()
            rows = []
            for tid, text, own in zip(tids, batch.column("text"), spots, strict=True):
                data = text.as_buffer().to_pybytes()
                for s in own:
                    part = data[s["first"] : s["last"] + how.length]
                    rows.append((s["core"], tid, s["first"], s["lone"], part))
            if rows:
                yield _batch(rows, CONTEXT)

    met = texts.join(wanted, ["tid", "doc"]).select(
        "tid", F.encode("text", "utf-8").alias("text"), "spots"
    )
    return met.mapInArrow(run, "core long, tid long, first long, lone boolean, data binary")


CONTEXT = pa.schema(
    [
        ("core", pa.int64()),
        ("tid", pa.int64()),
        ("first", pa.int64()),
        ("lone", pa.bool_()),
        ("data", pa.binary()),
    ]
)
MARK = pa.schema([("tid", pa.int64()), ("start", pa.int64()), ("stop", pa.int64())])
MARKS = "tid long, start long, stop long"


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
    )


def _hashes(data: bytes, how: Repeat) -> list[int]:
    """One hash per string of ``data``."""
    return [_hash(data[p : p + how.length]) for p in range(len(data) - how.length + 1)]


def _runs(tid: int, first: int, repeated: np.ndarray, how: Repeat) -> list[tuple[int, int, int]]:
    """(tid, start, stop) of the bytes that neighbouring repeated strings cover."""
    edges = np.flatnonzero(np.diff(np.r_[0, repeated.astype("i1"), 0]))
    return [
        (tid, first + a, first + b - 1 + how.length)
        for a, b in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True)
    ]


def _within_classes(contexts: DataFrame, how: Repeat) -> DataFrame:
    """Marks of the lone phrases of classes that fit a task, one class after the other."""

    def compare(members: list[tuple]) -> list[tuple[int, int, int]]:
        found = [_hashes(data, how) for *_, data in members]
        _, back, counts = np.unique(
            np.array([h for own in found for h in own], "u8"), return_inverse=True, return_counts=True
        )
        repeated, at, marks = counts[back] > 1, 0, []
        for (tid, first, lone, _), own in zip(members, found, strict=True):
            if lone:
                marks += _runs(tid, first, repeated[at : at + len(own)], how)
            at += len(own)
        return marks

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        core, members = None, []
        for batch in batches:
            marks = []
            columns = [batch.column(f.name).to_pylist() for f in CONTEXT]
            for name, *member in zip(*columns, strict=True):
                if name != core:
                    marks += compare(members) if members else []
                    core, members = name, []
                members.append(member)
            yield _batch(marks, MARK)
        yield _batch(compare(members) if members else [], MARK)

    return contexts.repartition("core").sortWithinPartitions("core").mapInArrow(run, MARKS)


def _by_string(contexts: DataFrame, how: Repeat) -> DataFrame:
    """Marks of the lone phrases of classes of any size: every string is a row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, ROWS):
            columns = [batch.column(f.name).to_pylist() for f in CONTEXT]
            rows = [
                (core, np.uint64(h).view("i8").item(), tid, first + p, lone)
                for core, tid, first, lone, data in zip(*columns, strict=True)
                for p, h in enumerate(_hashes(data, how))
            ]
            yield _batch(rows, STRING)

    rows = contexts.mapInArrow(run, "core long, string long, tid long, start long, lone boolean")
    rows = rows.withColumn("place", F.xxhash64("tid", "start"))
    twice = rows.groupBy("core", "string").agg(F.min("place").alias("p"), F.max("place").alias("q"))
    met = rows.where("lone").join(twice.where("p <> q"), ["core", "string"])
    return met.select("tid", "start", (F.col("start") + how.length).alias("stop"))


STRING = pa.schema(
    [
        ("core", pa.int64()),
        ("string", pa.int64()),
        ("tid", pa.int64()),
        ("start", pa.int64()),
        ("lone", pa.bool_()),
    ]
)


def anchors(text: str, how: Passage) -> np.ndarray:
    """Hashes of some runs of ``shingle`` words, one at least of every run of ``words`` words.

    Of neighbouring hashes the least is taken, as many as start in a run of
    ``words``: equal runs have equal anchors.
    """
    words = text.split()
    if len(words) < how.words:
        return np.empty(0, "i8")
    own = np.fromiter((_hash(w.encode()) for w in words), "u8", len(words))
    # Hashes of 1, 2, 4, ... words; the shingle's is put together from them.
    found, size, power = None, 1, np.uint64(0x9E3779B97F4A7C15)
    covered = 0
    while size <= how.shingle:
        if how.shingle & size:
            later = own[covered:]
            found = later if found is None else found[: len(later)] * power + later
            covered += size
        own = own[:-size] * power + own[size:]
        power, size = np.uint64(int(power) ** 2 % 2**64), 2 * size
    keys = found[: len(words) - how.shingle + 1]
    keys = (keys ^ (keys >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return np.unique(_least(keys, how.words - how.shingle + 1)).view("i8")


def sharing(texts: DataFrame, how: Passage) -> DataFrame:
    """(tid) of the texts that share a passage with a different one of ``texts`` (tid, text).

    Anchors are stored by their hash, then counted and met without a shuffle.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, ROWS):
            own = [anchors(t, how) for t in batch.column("text").to_pylist()]
            tids = np.repeat(np.asarray(batch.column("tid")), [len(a) for a in own])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(own)), pa.array(tids)], ["anchor", "tid"]
            )

    stored = bucketed(texts.mapInArrow(run, "anchor long, tid long"), "anchor")
    twice = stored.groupBy("anchor").agg(F.min("tid").alias("p"), F.max("tid").alias("q"))
    met = stored.join(twice.where("p <> q").select("anchor"), "anchor")
    return met.select("tid").distinct()


def _finish(rows: DataFrame, how: Repeat) -> DataFrame:
    """(key, n_bytes, spans, kept) from (key, text, copies, marks); no copies: not the first one."""
    span = pa.struct([("start", pa.int64()), ("stop", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, ROWS):
            sizes, spans, kept = [], [], []
            copies, marks = batch.column("copies").to_pylist(), batch.column("marks").to_pylist()
            for text, n, own in zip(batch.column("text"), copies, marks, strict=True):
                data = text.as_buffer().to_pybytes()
                if n != 1:
                    found = [(0, len(data))] if len(data) >= how.length else []
                else:
                    found = []
                    for start, stop in sorted((m["start"], m["stop"]) for m in own or ()):
                        if found and start <= found[-1][1]:
                            found[-1] = (found[-1][0], max(found[-1][1], stop))
                        else:
                            found.append((start, stop))
                edges = [0, *(e for s in found for e in s), len(data)]
                sizes.append(len(data))
                spans.append([{"start": a, "stop": b} for a, b in found])
                kept.append(b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("key"),
                    pa.array(sizes, pa.int64()),
                    pa.array(spans, pa.list_(span)),
                    pa.array(kept, pa.binary()),
                ],
                ["key", "n_bytes", "spans", "kept"],
            )

    name = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(
        run, f"key {name}, n_bytes long, spans array<struct<start:long,stop:long>>, kept binary"
    )


# Distinct phrases of a class that one task compares; a larger class goes string by string.
TOGETHER = 20_000


def remove_repeats(
    docs: DataFrame,
    how: Repeat = Repeat(),
    key: str = "doc_id",
    text: str = "text",
    together: int = TOGETHER,
    passage: Passage | None = None,
) -> DataFrame:
    """One row per row of ``docs``: (key, n_bytes, spans, kept).

    ``spans`` are the maximal removed runs of bytes, as (start, stop); ``kept``
    is what remains, as bytes. With ``passage`` also ``shares_passage``: whether the
    row has such a passage in common with another row. That removes nothing.
    """
    texts = docs.select(F.col(key).cast("long").alias("key"), text_or_empty(text).alias("text"))
    texts = texts.select(
        "key",
        # Stands for the document in joins; a null key gets a number of its own.
        F.coalesce("key", F.lit(-(2**63))).alias("doc"),
        F.xxhash64("text").alias("tid"),
        "text",
    )
    firsts = texts.groupBy("tid", F.md5("text").alias("md5")).agg(
        F.min("doc").alias("doc"), F.count(F.lit(1)).alias("copies")
    )
    firsts = durable(firsts.drop("md5"))

    # 1. The dictionary: phrases whose shared bytes stand at two places.
    binary = texts.select("tid", F.encode("text", "utf-8").alias("text"))
    parsed = _phrase_rows(binary, how)
    twice = (
        parsed.groupBy("core")
        .agg(F.min("place").alias("p"), F.max("place").alias("q"))
        .where("p <> q")
        .select("core")
    )
    # Read from storage, so that Spark can split the phrases of a frequent core in the join.
    met = durable(parsed.join(durable(twice), "core"))

    # 2. Phrases that stand twice with all their strings.
    wholes = met.groupBy("core", "whole").agg(
        F.min("place").alias("p"),
        F.max("place").alias("q"),
        F.min(F.struct("tid", "first", "last")).alias("spot"),
    )
    wholes = durable(wholes.select("core", "whole", (F.col("p") == F.col("q")).alias("lone"), "spot.*"))
    again = wholes.where("NOT lone").select("core", "whole")
    marks = met.join(again, ["core", "whole"]).select(
        "tid", F.col("first").alias("start"), (F.col("last") + how.length).alias("stop")
    )

    # 3. Strings of phrases that agree in the shared bytes only.
    sizes = wholes.groupBy("core").agg(F.count(F.lit(1)).alias("n")).where("n > 1")

    def contexts(some: str) -> DataFrame:
        spots = wholes.join(sizes.where(some), "core").join(firsts.select("tid", "doc"), "tid")
        wanted = spots.groupBy("tid", "doc").agg(
            F.collect_list(F.struct("core", "first", "last", "lone")).alias("spots")
        )
        return _contexts(texts.select("tid", "doc", "text"), wanted, how)

    marks = marks.union(_within_classes(contexts(f"n <= {together}"), how))
    if not sizes.where(f"n > {together}").isEmpty():
        marks = marks.union(_by_string(contexts(f"n > {together}"), how))

    own = marks.groupBy("tid").agg(F.collect_set(F.struct("start", "stop")).alias("marks"))
    judged = firsts.join(own, "tid", "left")
    text = F.encode("text", "utf-8").alias("text")
    if passage is None:
        rows = texts.join(judged, ["tid", "doc"], "left").select("key", text, "copies", "marks")
        return _finish(rows, how).withColumnRenamed("key", key)
    met = sharing(texts.select("tid", "text"), passage).withColumn("met", F.lit(True))
    rows = texts.join(judged.join(met, "tid", "left"), ["tid", "doc"], "left")
    # A text that stands twice shares all it has; only its first row has ``copies``.
    copied = F.coalesce(F.col("copies") > 1, F.lit(True))
    long = F.size(F.split("text", r"\s+")) >= passage.words
    shares = F.coalesce("met", F.lit(False)) | (copied & long)
    # The flag rides with the key, which passes through as it is.
    packed = F.struct("key", shares.alias("shares_passage")).alias("key")
    done = _finish(rows.select(packed, text, "copies", "marks"), how)
    return done.select(F.col("key.key").alias(key), "n_bytes", "spans", "kept", "key.shares_passage")


def digest(found: DataFrame, key: str = "doc_id") -> DataFrame:
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["start"])
    return found.select(
        key,
        "n_bytes",
        removed.alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
        *(["shares_passage"] if "shares_passage" in found.columns else []),
    )
