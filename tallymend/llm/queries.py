"""The registered corpus queries: one per operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallymend.llm import (
    alignment,
    byte_bpe,
    curves,
    drift,
    itq,
    licenses,
    lsh_forest,
    mixture,
    repeats,
    secrets,
    token_files,
    toxicity,
    word_table,
)
from tallymend.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]
REGISTERED: dict[str, Query] = {}


def query(fn: Query) -> Query:
    REGISTERED[fn.__name__] = fn
    return fn


@query
def op1_license_scan(spark, sf_dir):
    return licenses.digest(licenses.recognise(table(spark, sf_dir, "documents")))


@query
def op2_repeat_removal(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return repeats.digest(repeats.remove_repeats(docs, passage=repeats.Passage()))


@query
def op3_toxicity_chain(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return toxicity.judge(docs, labels, carry=["doc_id"])


@query
def op4_hilbert_neighbours(spark, sf_dir):
    return curves.search(table(spark, sf_dir, "embeddings"))


@query
def op5_token_files(spark, sf_dir):
    """Writes the files, then reads every document back from them."""
    folder = token_files.new_folder(spark)
    token_files.write_tokens(table(spark, sf_dir, "documents"), folder)
    return token_files.digest(token_files.read_tokens(spark, folder))


@query
def op6_itq_near_duplicates(spark, sf_dir):
    return itq.join(table(spark, sf_dir, "embeddings"))


@query
def op7_jaccard_forest(spark, sf_dir):
    return lsh_forest.join(table(spark, sf_dir, "documents")).drop("text_hash")


@query
def op8_curriculum_mix(spark, sf_dir):
    """In training order; documents that are not taken come last."""
    mixed = mixture.digest(mixture.assign(table(spark, sf_dir, "documents")))
    return mixed.orderBy(mixed["position"].asc_nulls_last(), "doc_id")


@query
def op9_byte_bpe(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return byte_bpe.digest(byte_bpe.encode(docs, data="decoded"))


@query
def op10_secret_scan(spark, sf_dir):
    return secrets.digest(secrets.find_secrets(table(spark, sf_dir, "documents")))


@query
def op11_word_table(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return word_table.digest(word_table.encode(docs, data="decoded"))


@query
def op12_pair_bitmaps(spark, sf_dir):
    return alignment.digest(table(spark, sf_dir, "documents"))


@query
def op13_geometric_drift(spark, sf_dir):
    return drift.digest(drift.cluster(table(spark, sf_dir, "embeddings")))


def oracle_sql() -> dict[str, str]:
    return {
        "op1_license_scan": licenses.digest_sql(),
        "op4_hilbert_neighbours": curves.digest_sql(),
        "op6_itq_near_duplicates": itq.digest_sql(),
        "op7_jaccard_forest": lsh_forest.digest_sql(),
        "op8_curriculum_mix": mixture.digest_sql(),
        "op13_geometric_drift": drift.digest_sql(),
    }
