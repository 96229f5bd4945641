"""Row digests over canonical cells, in column-name order."""

from __future__ import annotations

from collections.abc import Mapping

from tallymend.functions.cells import Cell

# Trimming removes both characters, so no cell can equal the
# NULL mark, and ("ab", "c") never reads like ("a", "bc").
NULL_MARK = "\x1e"
CELL_BREAK = "\x1f"


def row_hash(cells: Mapping[str, Cell], algo: str = "xxhash64") -> str:
    """Digest of a row given as name -> cell, as SQL text.

    ``xxhash64`` is the cheap BIGINT used to skip equal rows; ``md5`` is the
    portable hex text written into reports.
    """
    texts = ", ".join(
        f"coalesce({cells[name].canonical()}, r'{NULL_MARK}')" for name in sorted(cells)
    )
    if algo == "xxhash64":
        return f"xxhash64({texts})"
    if algo == "md5":
        return f"md5(concat_ws(r'{CELL_BREAK}', {texts}))"
    raise ValueError(f"unknown digest {algo!r}")
