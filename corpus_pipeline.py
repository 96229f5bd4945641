"""The corpus pipeline: filter, de-duplicate, redact, mix and encode ``documents``.

Every stage takes (spark, docs, sf_dir), works on all rows its predecessor
kept, and returns the columns of ``documents`` (the last one its own).
``run`` chains them; a caller may also store each stage's result and hand the
reread rows to the next.

Cases, for every stage: a null text is an empty one (no words, no copies, no secrets, size 0,
no ids); a null source is a source of its own; repeated rows are judged alike, and
of them one stays as a copy; ties go to the smaller id, or to the order by hash in the mix;
an empty table gives an empty result; further columns come through unchanged, whatever
their names, up to the last stage, which has columns of its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymend.llm import byte_bpe, lsh_forest, mixture, secrets, toxicity
from tallymend.llm.common import rows_of, table, with_row


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the chain of models calls toxic go."""
    packed = with_row(docs, "doc_id", "text")
    judged = toxicity.judge(packed, table(spark, sf_dir, "labels"), carry=["row"])
    return judged.where("NOT toxic").select(*rows_of(judged, docs.columns))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by a five-word shingle similarity of 0.8 the one of least id stays."""
    return lsh_forest.keep_one(docs)


def scan_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Credentials that are not widely copied examples are replaced by their kind."""
    cleaned = secrets.redact(docs, secrets.find_secrets(docs))
    return cleaned.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for every time a document is trained on, in training order."""
    ordered = mixture.training_order(mixture.assign(with_row(docs, "doc_id", "text", "source")))
    return ordered.select(*rows_of(ordered, docs.columns))


def encode_bytes(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids, decoded_sha256): the ids, and a hash of what they decode to."""
    tokens = byte_bpe.encode(docs.select("doc_id", "text"), data="decoded")
    return tokens.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        "ids",
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("toxicity", drop_toxic),
    ("near_copies", drop_near_copies),
    ("secrets", scan_secrets),
    ("mixture", mix_sources),
    ("byte_bpe", encode_bytes),
]

# Two stages rest on trained models and hash sketches, which SQL does not express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
    return docs
