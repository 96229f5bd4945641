"""Toxicity by a chain of linear models.

Categories are predicted one after the other. Each model sees the words of a
text and the probabilities of all earlier categories. While fitting, those
probabilities are out of fold: a document's comes from a model that has not
seen the document, so later models learn from predictions as they will be.

Fitting takes a bounded sample of labelled rows, the first ``Training.rows`` by
hash of the key, as sets of hashed words; both bounds are parameters. Scoring
covers every document and needs no shuffle.

Cases: a null or empty text has no words and scores by the intercepts; a null
label leaves its row out of fitting; repeated labels count as often as they are
there; a category with a single class gets a constant probability; without
labels every probability is 0; extra columns are kept; an empty table gives an
empty result.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallymend.llm.byte_bpe import sliced
from tallymend.llm.common import Memory

WORD = re.compile(r"\w+").findall
# Rows that a worker holds, bytes of words that a task remembers.
ROWS = 256
REMEMBERED = 32 << 20


@dataclass(frozen=True)
class Training:
    """``rows``: labelled rows used at most. ``buckets``: hashed words. ``strength``: least
    z-score of a feature's association with the label for it to get a weight, ``least``:
    positives that hold it at least, a count and no share, so the words of a small language
    or source are learned too. Chance associations of rare words stay
    out, so long clean texts gather no score. ``stems``: a word also counts as its
    beginnings of so many letters, which catches inflected forms."""

    rows: int = 8_000
    buckets: int = 1 << 18
    folds: int = 3
    strength: float = 5.0
    least: int = 5
    stems: tuple[int, ...] = (4, 5)
    penalty: float = 0.05
    earlier_penalty: float = 10.0
    steps: int = 250
    rate: float = 0.3


def _buckets(how: Training) -> Memory:
    """A word's features: itself and its stems, hashed."""

    def features(word: str) -> tuple[int, ...]:
        stems = [f"{word[:n]}-" for n in how.stems if len(word) > n]
        return tuple(zlib.crc32(f.encode()) % how.buckets for f in (word, *stems))

    return Memory(features, REMEMBERED)


def words_of(text: str | None, buckets: Memory) -> np.ndarray:
    """The distinct hashed features of a text's words in lower case."""
    found = set()
    found.update(*map(buckets.__getitem__, set(WORD((text or "").lower()))))
    return np.fromiter(found, "i4", len(found))


@dataclass
class Linear:
    """A logistic model: weights of chosen words, of earlier categories, and a constant."""

    words: np.ndarray
    weights: np.ndarray
    earlier: np.ndarray
    constant: float

    def predict(self, table: np.ndarray, sets: Sequence[np.ndarray], earlier: np.ndarray):
        """``table`` has the weight of every bucket, from ``dense``."""
        score = np.array([table[s].sum() for s in sets], "f8") + self.constant
        return _sigmoid(score + earlier @ self.earlier)

    def dense(self, buckets: int) -> np.ndarray:
        table = np.zeros(buckets)
        table[self.words] = self.weights
        return table


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def fit_linear(
    sets: Sequence[np.ndarray], earlier: np.ndarray, y: np.ndarray, how: Training
) -> Linear:
    """Weights for words whose share among positives differs beyond chance; Adam steps."""
    n, positives = len(y), float(y.sum())
    none = Linear(np.empty(0, "i4"), np.empty(0), np.zeros(earlier.shape[1]), -40.0)
    if n == 0 or positives == 0:
        return none
    if positives == n:
        none.constant = 40.0
        return none
    lengths = np.array([len(s) for s in sets])
    flat = np.concatenate([np.empty(0, "i4"), *sets])
    row = np.repeat(np.arange(n), lengths)
    seen = np.bincount(flat, minlength=how.buckets)
    with_label = np.bincount(flat, weights=y[row], minlength=how.buckets)
    share = positives / n
    # A half count keeps a single rare hit from looking certain.
    spread = np.sqrt((seen + 1) * share * (1 - share))
    z = (np.abs(with_label - seen * share) - 0.5) / spread
    chosen = np.flatnonzero((z >= how.strength) & (with_label >= how.least)).astype("i4")
    place = np.full(how.buckets, -1)
    place[chosen] = np.arange(len(chosen))
    kept = place[flat] >= 0
    row, column = row[kept], place[flat[kept]]

    w = np.zeros(len(chosen) + earlier.shape[1] + 1)
    w[-1] = np.log(share / (1 - share))
    first, second = np.zeros_like(w), np.zeros_like(w)
    m = len(chosen)
    for step in range(1, how.steps + 1):
        score = np.bincount(row, weights=w[column], minlength=n) + earlier @ w[m:-1] + w[-1]
        off = (_sigmoid(score) - y) / n
        slope = np.concatenate(
            [np.bincount(column, weights=off[row], minlength=m), earlier.T @ off, [off.sum()]]
        )
        slope[:m] += how.penalty / n * w[:m]
        slope[m:-1] += how.earlier_penalty / n * w[m:-1]
        first = 0.9 * first + 0.1 * slope
        second = 0.999 * second + 0.001 * slope**2
        w -= how.rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return Linear(chosen, w[:m], w[m:-1], float(w[-1]))


def fit_chain(sets: Sequence[np.ndarray], labels: np.ndarray, how: Training) -> list[Linear]:
    """One model per column of ``labels``; earlier probabilities come out of fold."""
    fold = np.arange(len(sets)) % how.folds
    earlier, chain = np.zeros((len(sets), 0)), []
    for y in labels.T:
        chain.append(fit_linear(sets, earlier, y, how))
        outside = np.zeros(len(sets))
        for k in range(how.folds):
            rest, own = np.flatnonzero(fold != k), np.flatnonzero(fold == k)
            model = fit_linear([sets[i] for i in rest], earlier[rest], y[rest], how)
            table = model.dense(how.buckets)
            outside[own] = model.predict(table, [sets[i] for i in own], earlier[own])
        earlier = np.column_stack([earlier, outside])
    return chain


def hashed(docs: DataFrame, how: Training, text: str = "text", words: str = "words") -> DataFrame:
    """``docs`` with the text replaced by its set of hashed words."""
    kept = [c for c in docs.columns if c not in (text, words)]
    schema = T.StructType([docs.schema[c] for c in kept]).add(words, T.ArrayType(T.IntegerType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buckets = _buckets(how)
        for batch in sliced(batches, ROWS):
            found = [words_of(t, buckets) for t in batch.column(text).to_pylist()]
            columns = [*(batch.column(c) for c in kept), pa.array(found, pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(columns, [*kept, words])

    return docs.select(*kept, text).mapInArrow(run, schema)


def train(
    docs: DataFrame,
    labels: DataFrame,
    categories: dict[str, str],
    how: Training = Training(),
    key: str = "doc_id",
    text: str = "text",
) -> list[Linear]:
    """The chain for ``categories``: name to a SQL expression over ``labels`` that is 0 or 1.

    At most ``how.rows`` labelled rows reach the driver, as hashed words.
    """
    wanted = labels.select(
        F.col(key).alias("_key"),
        *[F.expr(e).cast("double").alias(f"_y{i}") for i, e in enumerate(categories.values())],
    ).dropna()
    order = F.xxhash64("_key")
    sample = wanted.orderBy(order, "_key").limit(how.rows)
    rows = docs.select(F.col(key).alias("_key"), F.col(text).alias("text")).join(sample, "_key")
    found = hashed(rows, how).orderBy(order, "_key").limit(how.rows).toArrow()
    sets = [np.asarray(x.values, "i4") for x in found.column("words")]
    y = np.column_stack([found.column(f"_y{i}").to_numpy() for i in range(len(categories))])
    return fit_chain(sets, y, how)


def score(
    docs: DataFrame,
    chain: list[Linear],
    categories: Sequence[str],
    how: Training = Training(),
    text: str = "text",
    carry: Sequence[str] | None = None,
) -> DataFrame:
    """``docs``, or its columns in ``carry``, with ``p_<category>`` for every category.

    Columns of these names are replaced.
    """
    names = [f"p_{c}" for c in categories]
    kept = [c for c in (docs.columns if carry is None else carry) if c not in names]
    schema = T.StructType([docs.schema[c] for c in kept])
    for name in names:
        schema = schema.add(name, T.DoubleType())
    # The size of the models is bounded by the number of buckets.
    sent = docs.sparkSession.sparkContext.broadcast(chain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buckets = _buckets(how)
        tables = [model.dense(how.buckets) for model in sent.value]
        for batch in sliced(batches, ROWS):
            sets = [words_of(t, buckets) for t in batch.column(text).to_pylist()]
            earlier = np.zeros((len(sets), 0))
            for model, table in zip(sent.value, tables, strict=True):
                earlier = np.column_stack([earlier, model.predict(table, sets, earlier)])
            columns = [batch.column(c) for c in kept] + [pa.array(p) for p in earlier.T]
            yield pa.RecordBatch.from_arrays(columns, [*kept, *names])

    return docs.select(*dict.fromkeys([*kept, text])).mapInArrow(run, schema)


# The chain of the registered query: first junk, then toxic.
CATEGORIES = {"junk": "CASE WHEN quality IS NOT NULL THEN 1 - quality END", "toxic": "toxic"}


def judge(
    docs: DataFrame,
    labels: DataFrame,
    how: Training = Training(),
    carry: Sequence[str] | None = None,
) -> DataFrame:
    """``docs``, or its columns in ``carry``, with ``p_junk``, ``p_toxic`` and ``toxic``:
    whether toxicity is more likely than not."""
    chain = train(docs, labels, CATEGORIES, how)
    scored = score(docs, chain, list(CATEGORIES), how, carry=carry)
    return scored.withColumn("toxic", F.col("p_toxic") >= 0.5)
