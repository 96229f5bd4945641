"""Secret scans by corpus-wide ownership frequency. [native: DataFrame functions only]

Three base kinds are found in every text by pattern. A fourth, wider kind takes
any long token that has the shape of a credential; such a token counts only when
the corpus says that it belongs to one owner and few repositories. The credential itself, hashed, is counted by
distinct repositories and distinct owners: what many owners hold is a copied
example, what one owner holds looks live.

Cases: a null text is empty and has no spans; a null owner is an owner of its
own; repeated rows are rows of their own but one repository; extra columns are
not read; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymend.llm.common import text_or_empty
from tallymend.plans.durable import durable

# The base patterns, the group that holds the credential, its least length.
KEYWORDS = ("password", "passwd", "secret", "token", "api_?key")
_KEYWORD = "|".join(
    "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word) for word in KEYWORDS
)
ASSIGN = rf"""({_KEYWORD})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{24,}"  # a maximal run: the same as [0-9a-f]+ kept from 24 characters on
BASE = (("assign", ASSIGN, 2, 6), ("access", ACCESS, 0, 20), ("hex", HEX, 0, 24))
# The wider kind: long tokens that hold a digit and a letter.
WIDE = ("owned", r"[A-Za-z0-9+/_=-]{20,}", 0, 20)
# Where letters and digits, or cases, alternate; a capital that begins a word of three does not count.
SWITCH = r"(?<=[0-9])(?=[A-Za-z])|(?<=[A-Za-z])(?=[0-9])|(?<=[a-z])(?=[A-Z](?![a-z]{2}))"
KINDS = tuple(kind for kind, *_ in (*BASE, WIDE))

SPAN = "array<struct<start:int,kind:int,stop:int,hash:string>>"


def _spans(text: Column, kind: int, pattern: str, group: int, least: int) -> Column:
    """Matches of one pattern as spans in code points.

    A text is its pieces between the matches and the matches in turn, so the
    lengths of both, added up, are the positions.
    """
    pieces = F.split(text, pattern, -1)
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else hits
    parts = F.arrays_zip(
        F.slice(pieces, 1, F.size(hits)).alias("gap"), hits.alias("hit"), values.alias("value")
    )
    start = F.struct(F.lit(0).alias("at"), F.array().cast(SPAN).alias("found"))

    def step(state: Column, part: Column) -> Column:
        begin = state["at"] + F.length(part["gap"])
        end = begin + F.length(part["hit"])
        span = F.struct(
            begin.alias("start"),
            F.lit(kind).alias("kind"),
            end.alias("stop"),
            F.sha2(part["value"], 256).alias("hash"),
        )
        good = F.length(part["value"]) >= least
        if kind == len(BASE):
            good &= part["value"].rlike("[0-9]") & part["value"].rlike("[A-Za-z]")
            good &= credential_shape(part["value"])
        found = F.when(good, F.array_append(state["found"], span)).otherwise(state["found"])
        return F.struct(end.alias("at"), found.alias("found"))

    found = F.aggregate(parts, start, step, lambda state: state["found"])
    # Cheap test first; most texts hold no match at all.
    return F.when(text.rlike(pattern), found).otherwise(F.array().cast(SPAN))


def credential_shape(value: Column) -> Column:
    """Whether a long token alternates as generated strings do, or repeats almost no character.

    Only its runs of letters and digits count: those of six with both cases, else those of more
    than 12, so that dates, words, paths, UUIDs and short hashes in file names have none. A
    switch is due every fourth character with both cases, every fifth with one.
    """
    both = value.rlike("[a-z]") & value.rlike("[A-Z]")

    def alternates(run: str, each: int) -> Column:
        runs = F.array_join(F.regexp_extract_all(value, F.lit(run), F.lit(0)), "-")
        n = F.length(F.regexp_replace(runs, "-", ""))
        return (n > 0) & (F.regexp_count(runs, F.lit(SWITCH)) * each >= n)

    n = F.length(value)
    kinds = F.array_distinct(F.split(value, ""))
    times = F.transform(kinds, lambda c: n - F.length(F.replace(value, c, F.lit(""))))
    repeated = F.aggregate(times, F.lit(0.0), lambda a, k: a + F.when(k > 0, k * F.log2(k)).otherwise(0.0))
    entropy = F.log2(n) - repeated / n
    even = (entropy >= 4.5) & (entropy >= 0.95 * F.log2(F.least(n, F.lit(62)))) & ~value.contains("/")
    dense = F.when(both, alternates("[A-Za-z0-9]{6,}", 4)).otherwise(alternates("[A-Za-z0-9]{13,}", 5))
    return dense | (both & even)


def scan(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``_base`` and ``_wide``: the spans of the base kinds and of the wider kind.

    A wider token that overlaps a base span is left out.
    """
    body = text_or_empty(text)
    base = F.concat(*[_spans(body, i, p, g, n) for i, (_, p, g, n) in enumerate(BASE)])
    _, pattern, group, least = WIDE
    out = docs.withColumn("_base", base).withColumn(
        "_wide", _spans(body, len(BASE), pattern, group, least)
    )
    return out.withColumn(
        "_wide",
        F.filter(
            "_wide",
            lambda w: ~F.exists(
                "_base", lambda b: (b["start"] < w["stop"]) & (w["start"] < b["stop"])
            ),
        ),
    )


def ownership(candidates: DataFrame) -> DataFrame:
    """(hash, repo, owner) to ``n_repos`` and ``n_owners`` of each hash.

    Each step reduces before it shuffles, so a credential in a third of all
    rows is one row per task when it leaves the task.
    """
    return (
        candidates.groupBy("hash", "owner", "repo")
        .agg(F.lit(1).alias("one"))
        .groupBy("hash", "owner")
        .agg(F.count(F.lit(1)).alias("repos"))
        .groupBy("hash")
        .agg(F.sum("repos").alias("n_repos"), F.count(F.lit(1)).alias("n_owners"))
    )


def find_secrets(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    repo: str = "doc_id",
    owner: str = "source",
    copied_from: int = 3,
    spread_from: int = 10,
) -> DataFrame:
    """One row per row of ``docs``: ``key``, ``spans`` and, where there are any, ``text_sha256``.

    ``spans`` is an array of (start, kind, stop, hash, n_repos, n_owners,
    verdict), ordered by start, then kind. ``verdict`` is ``example`` when at
    least ``copied_from`` owners hold the credential, ``live`` when one owner does
    in fewer than ``spread_from`` repositories, else ``shared``. Base spans stay whatever the verdict; a wider span is kept
    only as ``live``.
    """
    found = durable(
        scan(
            docs.select(
                F.col(key).alias("_key"),
                F.col(text).alias("text"),
                F.col(repo).cast("string").alias("_repo"),
                F.col(owner).cast("string").alias("_owner"),
            )
        ).select(
            F.monotonically_increasing_id().alias("_row"),
            "_key",
            "_repo",
            "_owner",
            F.concat("_base", "_wide").alias("_spans"),
            F.when(F.size(F.concat("_base", "_wide")) > 0, F.sha2("text", 256)).alias("_sha"),
        )
    )
    hit = found.where(F.size("_spans") > 0)
    counted = ownership(
        hit.select(
            F.explode(F.array_distinct(F.transform("_spans", lambda s: s["hash"]))).alias("hash"),
            F.col("_owner").alias("owner"),
            F.col("_repo").alias("repo"),
        )
    )
    verdict = (
        F.when(F.col("n_owners") >= copied_from, "example")
        .when((F.col("n_owners") == 1) & (F.col("n_repos") < spread_from), "live")
        .otherwise("shared")
    )
    judged = (
        hit.select("_row", F.explode("_spans").alias("s"))
        .select("_row", "s.*")
        .join(counted.withColumn("verdict", verdict), "hash")
        .where((F.col("kind") < len(BASE)) | (F.col("verdict") == "live"))
        .groupBy("_row")
        .agg(
            F.array_sort(
                F.collect_list(
                    F.struct("start", "kind", "stop", "hash", "n_repos", "n_owners", "verdict")
                )
            ).alias("spans")
        )
    )
    none = F.array().cast(judged.schema["spans"].dataType)
    return found.join(judged, "_row", "left").select(
        F.col("_key").alias(key), F.coalesce("spans", none).alias("spans"), F.col("_sha").alias("text_sha256")
    )


def _listed(spans: Column) -> Column:
    """``kind:start:end`` of every span, joined by commas."""
    names = F.array(*[F.lit(kind) for kind in KINDS])
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(
                ":", F.get(names, s["kind"]), s["start"].cast("string"), s["stop"].cast("string")
            ),
        ),
        ",",
    )


def digest(found: DataFrame, key: str = "doc_id") -> DataFrame:
    """The counts and texts that stand for the spans of ``find_secrets``."""
    base = F.filter("spans", lambda s: s["kind"] < len(BASE))

    def count(field: str, value) -> Column:
        return F.size(F.filter("spans", lambda s: s[field] == value)).cast("long")

    return found.select(
        key,
        *[count("kind", i).alias(f"n_{kind}") for i, (kind, *_) in enumerate(BASE)],
        F.sha2(_listed(base), 256).alias("base_sha256"),
        _listed(F.col("spans")).alias("spans"),
        *[count("verdict", v).alias(f"n_{v}") for v in ("live", "example")],
    )


def redact(docs: DataFrame, found: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with every span of ``find_secrets`` that is no ``example`` replaced by ``[kind]``.

    Overlapping spans are joined first. A document without such a span keeps
    its text, also a null one. Rows are met by key and text, so rows that share
    a key keep their own spans.
    """
    names = F.array(*[F.lit(kind) for kind in KINDS])
    state = F.struct(F.lit(0).alias("at"), F.lit("").alias("done"))

    def step(s: Column, span: Column) -> Column:
        begin = F.greatest(span["start"], s["at"])
        gap = F.substring(docs[text], s["at"] + 1, begin - s["at"])
        mark = F.when(
            span["start"] >= s["at"], F.concat(F.lit("["), F.get(names, span["kind"]), F.lit("]"))
        ).otherwise("")
        return F.struct(
            F.greatest(span["stop"], s["at"]).alias("at"),
            F.concat(s["done"], gap, mark).alias("done"),
        )

    def finish(s: Column) -> Column:
        return F.concat(s["done"], F.substring(docs[text], s["at"] + 1, F.length(docs[text])))

    marked = (
        found.select(
            F.col(key).alias("_key"),
            F.col("text_sha256").alias("_sha"),
            F.filter("spans", lambda s: s["verdict"] != "example").alias("_marks"),
        )
        .where(F.size("_marks") > 0)
        .dropDuplicates(["_key", "_sha"])
    )
    same = docs[key].eqNullSafe(marked["_key"]) & (F.sha2(docs[text], 256) == marked["_sha"])
    cleaned = F.when(marked["_marks"].isNull(), docs[text]).otherwise(
        F.aggregate(marked["_marks"], state, step, finish)
    )
    return docs.join(marked, same, "left").select(
        *[cleaned.alias(c) if c == text else docs[c] for c in docs.columns]
    )
