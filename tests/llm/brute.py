"""Plain versions of the corpus operators, for small inputs."""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import tiktoken
from tokenizers import Tokenizer

ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)


def secret_spans(text: str | None) -> list[tuple[int, int, int]]:
    text = text or ""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    for kind, pattern, least in ((1, "AKIA[A-Z0-9]+", 20), (2, "[0-9a-f]+", 24)):
        found += [(m.start(), kind, m.end()) for m in re.finditer(pattern, text) if len(m[0]) >= least]
    return sorted(found)


def secret_digest(text: str | None) -> tuple:
    found, names = secret_spans(text), ("assign", "access", "hex")
    listed = ",".join(f"{names[kind]}:{a}:{b}" for a, kind, b in found)
    counts = Counter(kind for _, kind, _ in found)
    return (*(counts[k] for k in range(3)), hashlib.sha256(listed.encode()).hexdigest())


def repeats(texts: list[str | None], length: int) -> list[tuple]:
    """(n_bytes, n_removed, n_spans, kept_sha256) of every text."""
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[p : p + length] for d in data for p in range(len(d) - length + 1))
    out = []
    for d in data:
        gone = np.zeros(len(d), bool)
        for p in range(len(d) - length + 1):
            if seen[d[p : p + length]] > 1:
                gone[p : p + length] = True
        kept = bytes(np.frombuffer(d, "u1")[~gone])
        spans = int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum())
        out.append((len(d), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def byte_bpe(text: str | None) -> list[int]:
    global _ENCODING
    if _ENCODING is None:
        with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        _ENCODING = tiktoken.Encoding(
            "plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
        )
    return _ENCODING.encode_ordinary(text or "")


_ENCODING = None


def token_rows(rows: list[tuple[int, str | None]]) -> list[tuple]:
    """(doc_id, start, n_tokens, ids_crc32) in ascending order of doc_id."""
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    out, start = [], 0
    for key, text in sorted(rows):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 2]
        out.append((key, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def shingles(text: str | None, k: int = 5) -> set[str]:
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    return {" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))} if words else set()


def groups(n: int, linked) -> list[int]:
    """The smallest index reachable from every index by ``linked`` pairs."""
    label = list(range(n))
    changed = True
    while changed:
        changed = False
        for a, b in linked:
            low = min(label[a], label[b])
            if label[a] != low or label[b] != low:
                label[a] = label[b] = low
                changed = True
    return label


def near_copies(texts: list[str | None], threshold: float = 0.8) -> tuple[list[int], list[int]]:
    """(links, smallest index reachable) of every text."""
    sets = [shingles(t) for t in texts]
    linked = [
        (a, b)
        for a in range(len(sets))
        for b in range(a)
        if sets[a] and sets[b] and len(sets[a] & sets[b]) >= threshold * len(sets[a] | sets[b])
    ]
    count = Counter(x for pair in linked for x in pair)
    return [count[i] for i in range(len(sets))], groups(len(sets), linked)


def sharing(texts: list[str | None], n: int) -> list[bool]:
    """Whether a text has ``n`` words in a row in common with another text."""
    words = [(t or "").split() for t in texts]
    runs = [{tuple(w[i : i + n]) for i in range(len(w) - n + 1)} for w in words]
    held = Counter(r for own in runs for r in own)
    return [any(held[r] > 1 for r in own) for own in runs]
