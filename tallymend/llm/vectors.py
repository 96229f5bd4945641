"""Vectors as table cells and matrices."""

from __future__ import annotations

import numpy as np
import pyarrow as pa


def packed(vectors: pa.Array) -> list[bytes | None]:
    """Every vector as little-endian doubles.

    None for a vector that is null, zero, or holds null or non-finite components.
    """
    out: list[bytes | None] = []
    for vector in vectors.to_pylist():
        # A null component becomes NaN; adding 0.0 makes -0.0 and 0.0 alike.
        found = np.array(() if vector is None else vector, "<f8") + 0.0
        usable = np.isfinite(found).all() and found.any()
        out.append(found.tobytes() if usable else None)
    return out


def matrix(vectors) -> np.ndarray:
    """Rows from packed vectors of one length."""
    vectors = list(vectors)
    return np.frombuffer(b"".join(vectors), "<f8").reshape(len(vectors), -1)


def unit(vectors: np.ndarray) -> np.ndarray:
    # Scaled first, so that squares neither overflow nor vanish.
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def squares(difference: np.ndarray) -> np.ndarray:
    """Sums of squares along the last axis, added from first to last component."""
    total = np.zeros(difference.shape[:-1])
    for k in range(difference.shape[-1]):
        total += difference[..., k] ** 2
    return total
