"""The table of distinct words, the alignment of two tokenizers, and clustering by drift."""

from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from conftest import SMALL
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tallymend.llm import alignment, drift, word_table
from tallymend.llm.queries import REGISTERED

LETTERS = [
    "a", "B", " ", "  ", "\n", "é", "ß", "日本", "🙂", "́", "<|endoftext|>", "'s", "'", "1", "23",
    ".", "\t", "\x1c", "\x85", "ſ", " ", "٣", "Ω", "</s>", "<0x0A>", "\x00",
]
# Names of columns that the operators have themselves.
CLASHING = ("row", "chunk", "place", "numbers", "slice", "n_docs", "a", "b", "block", "id", "data")


def odd_texts(n: int, letters=LETTERS) -> list[str]:
    draw = random.Random(5)
    return ["".join(draw.choices(letters, k=draw.randint(0, 30))) for _ in range(n)]


@pytest.fixture(scope="module")
def rows():
    texts = odd_texts(400) + odd_texts(100, [*LETTERS, "▁"])
    long = " ".join(odd_texts(20_000))
    found = [(i, t) for i, t in enumerate(texts)]
    return [*found, (900, None), (901, ""), (902, long), (903, "x" * 70_000), (904, "same"), (904, "same"), (None, "no key")]


@pytest.fixture(scope="module")
def docs(spark, rows):
    made = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    return made.withColumns({c: F.lit("clash") for c in CLASHING})


def same(found, expected):
    assert sorted(map(tuple, found), key=repr) == sorted(expected, key=repr)


# --- words


def library_rows(rows):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for key, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        spelled = library.decode(ids, skip_special_tokens=False)
        yield key, len(ids), np.array(ids, "<u4").tobytes(), spelled


def word_digest(rows):
    return [
        (key, n, hashlib.sha256(ids).hexdigest(), hashlib.sha256(text.encode()).hexdigest())
        for key, n, ids, text in library_rows(rows)
    ]


def test_word_table_query(spark):
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    same(REGISTERED["op11_word_table"](spark, SMALL).collect(), word_digest(rows))


def test_words_of_odd_texts(docs, rows):
    """Chunks of a few texts, few slices; the caller's columns come back."""
    found = word_table.decode(word_table.encode(docs, chunk=5_000, slices=7))
    assert set(found.columns) == {"doc_id", *CLASHING, "ids", "decoded"}
    assert found.where(" OR ".join(f"{c} IS DISTINCT FROM 'clash'" for c in CLASHING)).isEmpty()
    same(word_table.digest(found).collect(), word_digest(rows))


def test_decoding_where_ids_are_put_in(docs):
    """The same as decoding in a step of its own, in any number of chunks."""
    both = word_table.encode(docs, chunk=5_000, slices=7, data="decoded")
    alone = word_table.decode(word_table.encode(docs))
    assert both.columns == alone.columns
    assert both.exceptAll(alone).isEmpty() and alone.exceptAll(both).isEmpty()
    assert word_table.encode(docs.limit(0), data="decoded").isEmpty()


def test_decoding_passes_over_unknown_ids_and_broken_bytes(spark):
    ids = [[15496, 50_300], [220, 2**32 - 1], [160], []]
    made = [(i, bytearray(np.array(x, "<u4").tobytes())) for i, x in enumerate(ids)] + [(9, None)]
    found = word_table.decode(spark.createDataFrame(made, "doc_id long, ids binary"))
    texts = {r["doc_id"]: r["decoded"] for r in found.collect()}
    assert texts == {0: "Hello", 1: " ", 2: "�", 3: "", 9: ""}


def test_texts_are_not_shuffled(docs):
    plan = word_table.encode(docs)._jdf.queryExecution().executedPlan().toString()
    side = plan[plan.index("FlatMapCoGroupsInArrow") :]
    first, second = side.split("FileScan", 1)[0], side.split("FileScan", 1)[1]
    assert "Exchange" not in first and "Bucketed: true" in second


def test_words_of_an_empty_table(docs):
    found = word_table.decode(word_table.encode(docs.limit(0)))
    assert found.isEmpty() and "decoded" in found.columns


# --- pairs


def plain_alignment(rows):
    """(key, n_a, n_b, n_groups, n_links, n_best, count_sum, groups) straight from the libraries."""
    a_library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a_library.encode_special_tokens = True
    b_library = sentencepiece.SentencePieceProcessor(
        model_file=public_tokenizers.path("piece_bpe_32k.model")
    )
    a_bytes = dict(zip(*word_table.vocabulary().to_pydict().values(), strict=True))
    b_bytes = [
        bytes([int(b_library.id_to_piece(i)[3:5], 16)])
        if b_library.is_byte(i)
        else b_library.id_to_piece(i).replace("▁", " ").encode()
        for i in range(b_library.get_piece_size())
    ]
    documents, count = [], Counter()
    for key, text in rows:
        data = (" " + (text or "")).encode()
        a = a_library.encode(" " + text, add_special_tokens=False).ids if text else []
        b = b_library.encode(text) if text else []
        if not text or data != b"".join(a_bytes[i] for i in a) or data != b"".join(b_bytes[i] for i in b):
            documents.append((key, [], [], [], Counter()))
            continue
        a_ends = np.cumsum([len(a_bytes[i]) for i in a]).tolist()
        b_ends = np.cumsum([len(b_bytes[i]) for i in b]).tolist()
        groups, i, j = [], 0, 0
        for end in sorted(set(a_ends) & set(b_ends)):
            i_end, j_end = a_ends.index(end) + 1, b_ends.index(end) + 1
            groups.append((a[i:i_end], b[j:j_end]))
            i, j = i_end, j_end
        links = Counter((x, y) for left, right in groups for x in left for y in right)
        count.update(links.keys())
        documents.append((key, a, b, groups, links))
    best = defaultdict(int)
    for (x, _), n in count.items():
        best[x] = max(best[x], n)
    for key, a, b, groups, links in documents:
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        yield (
            key,
            len(a),
            len(b),
            len(groups),
            sum(links.values()),
            sum(n for pair, n in links.items() if count[pair] == best[pair[0]]),
            sum(n * count[pair] for pair, n in links.items()),
            text,
        )


def hashed_groups(row):
    return (*row[:-1], hashlib.sha256(row[-1].encode()).hexdigest() if row[-1] else "")


def test_alignment_query(spark):
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    expected = [hashed_groups(r) for r in plain_alignment(rows)]
    same(REGISTERED["op12_pair_bitmaps"](spark, SMALL).collect(), expected)
    assert any(r[5] < r[4] for r in expected)


def test_alignment_of_odd_texts(docs, rows):
    """Chunks by characters and by places; groups as text; columns and repeated rows are kept."""
    rows = [r for r in rows if r[0] not in (902, 903)]
    docs = docs.where("doc_id IS NULL OR doc_id NOT IN (902, 903)")
    for bounds in ({"chunk": 700}, {"places": 37}):
        found = alignment.score(alignment.align(docs, **bounds))
        assert {"doc_id", *CLASHING} <= set(found.columns)
        assert found.where("chunk <> 'clash' OR a <> 'clash'").isEmpty()
        columns = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups")
        same(found.select(*columns).collect(), list(plain_alignment(rows)))


def test_long_texts_are_aligned_in_blocks(spark, monkeypatch):
    text = " ".join(odd_texts(300))
    expected = list(plain_alignment([(1, text)]))
    monkeypatch.setattr(alignment, "BLOCK", 100)
    tokens = alignment.Tokens(alignment.A_VOCABULARY, alignment.B_VOCABULARY)
    one = alignment.Aligned(text, tokens, alignment.Writer(tokens))
    assert (one.n_a, one.n_b, one.n_groups, int(one.times.sum())) == expected[0][1:5]
    assert one.groups.decode() == expected[0][-1]


def test_merging_by_rank_gives_the_tokenizers_ids():
    """Every token by itself, and Latin texts with runs; a tokenizer that changes texts is refused."""
    tokens = alignment.loaded(alignment.A_VOCABULARY, alignment.B_VOCABULARY)
    library = Tokenizer.from_file(alignment.A_VOCABULARY)
    letters = [" ", "  ", "\n", "\t", "é", "ß", "×", "÷", "ÿ", "a", "the ", "'s", "'S", "'", "23", ".", " " * 50]
    pieces = [p.decode("utf-8", "ignore") for p in tokens.a_bytes.values() if b"<|" not in p]
    texts = [t for t in pieces + odd_texts(3_000, letters) if alignment.LATIN(t)]
    assert len(texts) > 30_000
    assert [tokens._by_rank(t) for t in texts] == [
        e.ids for e in library.encode_batch(texts, add_special_tokens=False)
    ]
    assert not alignment.merges_by_rank(public_tokenizers.path("word_bpe_49k.json"))


def test_runs_of_blanks_go_through_the_tokenizer():
    tokens = alignment.loaded(alignment.A_VOCABULARY, alignment.B_VOCABULARY)
    a, _ = tokens.encode(" " * 20_000 + "x")
    library = Tokenizer.from_file(alignment.A_VOCABULARY)
    assert a.tolist() == library.encode(" " * 20_001 + "x", add_special_tokens=False).ids


def test_bitmaps():
    draw = np.random.default_rng(3)
    for share in (0.0001, 0.01, 0.2, 0.9):
        places = np.flatnonzero(draw.random(1 << 16) < share).astype("u2")
        other = np.flatnonzero(draw.random(1 << 16) < 0.1).astype("u2")
        packed = [alignment.bitmap(p) for p in (places, other)]
        assert np.array_equal(alignment.places_of(packed[0]), places)
        assert len(packed[0]) <= min(2 * len(places), 1 << 13) + 1
        assert alignment.popcount_of_union(packed[:1]) == len(places)
        assert alignment.popcount_of_union(packed) == len(np.union1d(places, other))
    times = draw.integers(1, 40, 500)
    places = np.sort(draw.choice(1 << 16, 500, replace=False)).astype("u2")
    sums = np.zeros(1 << 16, int)
    for k, plane in enumerate(alignment.planes_of(places, times)):
        sums[alignment.places_of(plane)] += 1 << k
    assert np.array_equal(sums[places], times) and sums.sum() == times.sum()


def test_alignment_of_an_empty_table(docs):
    assert alignment.score(alignment.align(docs.limit(0))).isEmpty()
    assert alignment.digest(docs.limit(0)).columns[-1] == "groups_sha256"


# --- clusters


def plain_clusters(rows, clusters=8, rounds=10, dims=64):
    """Rounds without bounds, on plain integers."""
    kept = [
        (key, [int(np.floor(1024 * float(x))) for x in v], v)
        for key, v in rows
        if v is not None and len(v) == dims and all(x is not None and np.isfinite(x) for x in v)
    ]
    named = [r for r in kept if r[0] is not None]
    named.sort(key=lambda r: (hashlib.sha256(f"3:{r[0]}".encode()).hexdigest(), r[2]))
    centroids = [v for _, v, _ in named[:clusters]]
    if not centroids:
        return []

    def nearest(v):
        return min((sum((x - y) ** 2 for x, y in zip(v, c, strict=True)), j) for j, c in enumerate(centroids))

    for _ in range(rounds):
        own = [nearest(v)[1] for _, v, _ in kept]
        for j in range(len(centroids)):
            members = [v for (_, v, _), i in zip(kept, own, strict=True) if i == j]
            if members:
                centroids[j] = [sum(c) // len(members) for c in zip(*members, strict=True)]
    found = [(key, *nearest(v)[::-1]) for key, v, _ in kept]
    total = sum(d for *_, d in found)
    inertia = Counter()
    for _, j, d in found:
        inertia[j] += d
    return [
        (key, j, d, inertia[j], total, hashlib.sha256(",".join(map(str, centroids[j])).encode()).hexdigest())
        for key, j, d in found
    ]


def vectors(spark, rows):
    made = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    return made.withColumns({c: F.lit("clash") for c in ("block", "id", "cluster", "distance")})


def blob_rows(n: int, dims: int = 64):
    draw = np.random.default_rng(1)
    centres = draw.normal(size=(5, dims))
    return [(i, (centres[i % 5] + 0.2 * draw.normal(size=dims)).tolist()) for i in range(n)]


def test_clusters_equal_plain_rounds(spark):
    """Nulls, wrong lengths, repeated rows and ids, ties, zero vectors."""
    odd = [
        (500, None), (501, [0.5] * 63), (502, [None] + [0.5] * 63), (503, [float("nan")] + [0.5] * 63),
        (504, [float("inf")] + [0.5] * 63), (505, [0.0] * 64), (None, [0.25] * 64), (None, None),
    ]
    rows = blob_rows(300) + [*odd, *blob_rows(20), (1, [0.125] * 64)]
    found = drift.digest(drift.cluster(vectors(spark, rows)))
    same(found.collect(), plain_clusters(rows))


def test_wide_components_are_exact(spark):
    rows = [*blob_rows(40), (90, [1e6] + [0.0] * 63), (91, [-2e6, 1e5] + [0.0] * 62)]
    found = drift.digest(drift.cluster(vectors(spark, rows), rounds=3))
    same(found.collect(), plain_clusters(rows, rounds=3))


def test_few_and_no_vectors(spark):
    rows = [(1, [0.1] * 64), (2, [0.9] * 64), (2, [0.9] * 64)]
    same(drift.digest(drift.cluster(vectors(spark, rows))).collect(), plain_clusters(rows))
    empty = drift.digest(drift.cluster(vectors(spark, [(1, None)])))
    assert empty.isEmpty() and "centroid_sha256" in empty.columns


def test_bounds_spare_scans(spark):
    """Fewer vectors are scanned than with the full drift, and the clusters stay exact."""
    rows, scanned = blob_rows(2000), []
    drift.cluster(
        vectors(spark, rows), watch=lambda s: scanned.append(s.agg(F.sum("scanned")).first()[0])
    )
    assert scanned[0] == 2000 and scanned[-1] < 600

    x = np.floor(1024 * np.array([v for _, v in rows])).astype("i8")
    totals = {}
    for name in ("planes", "full drift"):
        bounds, scans, centroids = drift.Bounds.unknown(len(x)), [], x[:8].tolist()
        before = centroids
        for _ in range(11):
            if name == "full drift":
                old, new = np.array(before, "f8"), np.array(centroids, "f8")
                moved = np.linalg.norm(new - old, axis=1)
                bounds.lower -= moved.max()
                bounds.upper += moved[bounds.assigned]
            else:
                bounds.drift(before, centroids)
            scans.append(bounds.settle(x, centroids))
            before = centroids
            centroids = [
                [int(s) // int(n) for s in x[bounds.assigned == j].sum(axis=0)]
                if (n := (bounds.assigned == j).sum())
                else before[j]
                for j in range(8)
            ]
        totals[name] = sum(scans)
    assert totals["planes"] < totals["full drift"]


def test_loosening_holds_and_is_less_than_the_drift():
    """Against sampled vectors of the sphere."""
    draw = np.random.default_rng(7)
    tighter = 0
    for _ in range(300):
        own, before = draw.normal(size=(2, 4))
        after = before + 0.3 * draw.normal(size=4)
        radius = float(draw.uniform(0.05, 1.5))
        bound = drift.loosening(own, radius, before, after)
        step = draw.normal(size=(2000, 4))
        x = own + radius * step / np.linalg.norm(step, axis=1, keepdims=True)
        nearer = np.linalg.norm(x - before, axis=1) - np.linalg.norm(x - after, axis=1)
        assert nearer.max() <= bound
        tighter += bound < 0.8 * np.linalg.norm(after - before)
    assert tighter > 100
