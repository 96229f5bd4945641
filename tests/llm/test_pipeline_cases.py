"""The pipeline's stages on nulls, repeated rows, ties, empty tables and clashing names."""

from __future__ import annotations

import random

import pytest
from conftest import SMALL
from pyspark.sql import functions as F

import corpus_pipeline
from tallymend.llm import lsh_forest, mixture, repeats, secrets

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
# Names that the stages use, or used, for columns of their own.
CLASHING = (
    "_key", "_hash", "_order", "_slice", "_owner", "_sha", "_marks", "_at", "_starts", "row", "key",
    "hash", "toxic", "p_junk", "p_toxic", "size", "target", "taken", "position", "positions", "spans",
)


def prose(seed: int, words: int = 60) -> str:
    draw = random.Random(seed)
    return " ".join("".join(draw.choices("abcdeé", k=draw.randint(1, 9))) for _ in range(words))


ROWS = [
    (1, prose(1), "en", "a", None),
    (2, prose(1), "en", "b", None),
    (2, prose(1), "en", "b", None),
    (3, None, None, None, None),
    (4, "", "en", "a", None),
    (5, prose(5) + ' password = "abcdef0123456789"', "de", None, None),
    (6, prose(6), "de", "c", None),
    (None, prose(7), "de", "c", None),
]


def docs(spark):
    made = spark.createDataFrame(ROWS, SCHEMA).withColumn("n_chars", F.length("text").cast("long"))
    return made.withColumns({c: F.lit("clash") for c in CLASHING})


@pytest.mark.parametrize(("name", "stage"), corpus_pipeline.STAGES[:4])
def test_stages_keep_the_callers_columns(spark, name, stage):
    before = docs(spark)
    found = stage(spark, before, SMALL)
    assert found.columns == before.columns
    rows = found.collect()
    assert rows and all(r[c] == "clash" for r in rows for c in CLASHING)
    keys = [r["doc_id"] for r in rows]
    texts = {r["doc_id"]: r["text"] for r in rows}
    if name == "toxicity":
        assert len(rows) == len(ROWS)
    if name == "near_copies":
        # Texts without words and rows without a key stand for themselves.
        assert sorted(keys, key=repr) == [1, 3, 4, 5, 6, None]
    if name == "secrets":
        assert len(rows) == len(ROWS) and texts[5].endswith(' [assign]"') and texts[3] is None
    if name == "mixture":
        assert 3 not in keys and 4 not in keys and max(map(keys.count, {1, 5, 6})) <= 2


def test_last_stage(spark):
    rows = corpus_pipeline.encode_bytes(spark, docs(spark), SMALL).collect()
    assert len(rows) == len(ROWS)
    assert {r["doc_id"]: r["n_tokens"] for r in rows}[3] == 0


def test_empty_tables(spark):
    found = docs(spark).limit(0)
    for name, stage in corpus_pipeline.STAGES[:4]:
        found = stage(spark, found, SMALL)
        assert found.isEmpty(), name


def test_operators_keep_clashing_columns(spark):
    before = docs(spark)
    kept = lsh_forest.keep_one(before)
    assert kept.where(" OR ".join(f"{c} <> 'clash'" for c in CLASHING)).isEmpty()
    own = [c for c in CLASHING if c not in ("size", "target", "taken", "positions")]
    mixed = mixture.assign(before)
    assert mixed.where(" OR ".join(f"{c} <> 'clash'" for c in own)).isEmpty()
    cleaned = secrets.redact(before, secrets.find_secrets(before.select("doc_id", "text", "source")))
    assert cleaned.where(" OR ".join(f"{c} <> 'clash'" for c in CLASHING)).isEmpty()


def test_second_positions_follow_the_first(spark):
    rows = mixture.digest(mixture.assign(docs(spark))).collect()
    twice = [r for r in rows if r["second_position"] is not None]
    assert twice and all(0 <= r["position"] <= r["second_position"] <= 1 for r in twice)
    assert all(r["taken"] == 2 * r["size"] for r in twice)


def test_anchors_of_equal_runs_are_equal():
    how, shared = repeats.Passage(), prose(9, 51)
    for seed in range(20):
        a, b = (set(repeats.anchors(f"{prose(s, 30)} {shared} {prose(s + 50, 9)}", how)) for s in (seed, seed + 99))
        assert a & b
    assert not set(repeats.anchors(prose(1, 300), how)) & set(repeats.anchors(prose(2, 300), how))
    assert len(repeats.anchors(prose(3, 50), how)) == 0
