"""The registered corpus queries against their SQL or a plain version."""

from __future__ import annotations

import hashlib

import pytest
from compare import connect, difference
from conftest import SMALL

import __spark_entry__ as contract
import corpus_pipeline
from llm import brute
from tallymend.llm import queries, toxicity

SQL = queries.oracle_sql()


@pytest.fixture(scope="module")
def documents(spark):
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    return sorted((r["doc_id"], r["text"]) for r in rows)


def run(spark, name: str) -> list[tuple]:
    return sorted(tuple(r) for r in queries.REGISTERED[name](spark, SMALL).collect())


def test_one_query_per_operator():
    numbers = [int(name[2:].split("_")[0]) for name in queries.REGISTERED]
    assert sorted(numbers) == list(range(1, 14))
    assert {*queries.REGISTERED, "pipeline"} <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(SQL))
def test_sql(spark, name):
    assert difference(queries.REGISTERED[name](spark, SMALL), connect(SMALL), SQL[name]) is None


def test_repeat_removal(spark, documents):
    plain = brute.repeats([t for _, t in documents], 400)
    found = run(spark, "op2_repeat_removal")
    assert [r[:5] for r in found] == [(key, *row) for (key, _), row in zip(documents, plain, strict=True)]
    # Every shared run of 51 words is found, and nothing below 32 words.
    long, short = (brute.sharing([t for _, t in documents], n) for n in (51, 32))
    flags = [r[5] for r in found]
    assert any(long) and not all(short)
    assert all(b or not a for a, b in zip(long, flags, strict=True))
    assert all(b or not a for a, b in zip(flags, short, strict=True))
    assert any(0 < row[2] < row[1] for row in found)


def test_toxicity_is_learned(spark):
    """Trained on one half of the labels, right on the other."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    judged = toxicity.judge(docs, labels.where("doc_id % 2 = 0"), carry=["doc_id"])
    held = labels.where("doc_id % 2 = 1").selectExpr("doc_id", "toxic AS truth")
    held = judged.join(held, "doc_id").groupBy("toxic", "truth").count()
    cells = {(r[0], r[1]): r[2] for r in held.collect()}
    hit, miss = cells.get((True, 1), 0), cells.get((False, 1), 0)
    wrong, right = cells.get((True, 0), 0), cells.get((False, 0), 0)
    assert hit / (hit + miss) > 0.75
    assert wrong / (wrong + right) < 0.01


def test_token_files(spark, documents):
    assert run(spark, "op5_token_files") == brute.token_rows(documents)


def test_byte_bpe(spark, documents):
    expected = []
    for key, text in documents:
        ids = brute.byte_bpe(text)
        listed = ",".join(map(str, ids)).encode()
        hashes = (hashlib.sha256(listed).hexdigest(), hashlib.sha256(text.encode()).hexdigest())
        expected.append((key, len(ids), *hashes))
    assert run(spark, "op9_byte_bpe") == expected


def test_secret_scan(spark, documents):
    found = [row[:5] for row in run(spark, "op10_secret_scan")]
    assert found == [(key, *brute.secret_digest(text)) for key, text in documents]


def test_mix_comes_near_its_targets(spark):
    mixed = queries.REGISTERED["op8_curriculum_mix"](spark, SMALL).toPandas()
    mixed["source"] = mixed["doc_id"].map(
        spark.read.parquet(f"{SMALL}/documents.parquet").toPandas().set_index("doc_id")["source"]
    )
    assert abs(mixed.groupby("source")["target"].first().sum() - 1.5 * mixed["size"].sum()) < 1e-6
    for _, own in mixed.groupby("source"):
        assert abs(own["taken"].sum() - own["target"].iloc[0]) <= own["size"].max()
    assert (mixed["taken"] <= 2 * mixed["size"]).all()


def test_pipeline(spark, documents, tmp_path):
    """Every stage against what a plain version makes of its input."""
    docs, stored = spark.read.parquet(f"{SMALL}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SMALL).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        stored[name] = docs.collect()
    text = {n: {r["doc_id"]: r["text"] for r in stored[n]} for n in list(stored)[:4]}

    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    every = spark.read.parquet(f"{SMALL}/documents.parquet")
    clean = toxicity.judge(every, labels, carry=["doc_id"]).where("NOT toxic")
    assert set(text["toxicity"]) == {r["doc_id"] for r in clean.collect()}

    rows = sorted(text["toxicity"].items())
    _, group = brute.near_copies([t for _, t in rows])
    assert text["near_copies"] == {k: t for i, (k, t) in enumerate(rows) if group[i] == i}

    assert set(text["secrets"]) == set(text["near_copies"])
    for key, body in text["secrets"].items():
        before = text["near_copies"][key]
        assert (body == before) == (not brute.secret_spans(before)) or "[owned]" in body

    times = {}
    for row in stored["mixture"]:
        times[row["doc_id"]] = times.get(row["doc_id"], 0) + 1
        assert row["text"] == text["secrets"][row["doc_id"]]
    assert max(times.values()) <= 2

    assert len(stored["byte_bpe"]) == len(stored["mixture"])
    for row in stored["byte_bpe"]:
        body = text["mixture"][row["doc_id"]]
        assert list(row["ids"]) == brute.byte_bpe(body) and row["n_tokens"] == len(row["ids"])
        assert row["decoded_sha256"] == hashlib.sha256(body.encode()).hexdigest()
