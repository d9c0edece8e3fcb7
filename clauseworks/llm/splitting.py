"""Problem 4: cutting oversized items at natural boundaries.

Recursive bisection: an item longer than its limit is cut at the strongest
boundary near its midpoint, each half is cut again while it is longer than the
limit minus the overlap, and every piece but the first is then extended to the
left by the overlap. Lengths are compared in the JVM, so only oversized items
reach a Python worker; no shuffle is needed.

Defined results: null and empty values and fields without a row in the limits
give nothing; a value of exactly the limit stays whole; a text without any
boundary is cut at its midpoint, never between a base character and its
combining mark unless the piece has nothing else; a limit not above the overlap
is an error; rows stored twice are cut twice (``row_no`` is not invented).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clauseworks.llm.fields import arrow_rows

#: Strength of a cut before a position, by what ends there; the strongest first.
PARAGRAPH, LINE, SENTENCE, CLAUSE, BLANK, CHARACTER, INSIDE_WORD, INSIDE_CLUSTER = 7, 6, 5, 4, 3, 2, 1, 0

SENTENCE_MARKS = ".!?…。！？｡।॥"
CLAUSE_MARKS = ",;:，；：、）)］]》」』”"
SCHEMA = "field_name string, rec_id string, piece_no int, start_pos int, end_pos int, piece string"


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


def boundary_strengths(text: str) -> np.ndarray:
    """Strength of a cut before each position 1..n-1 of ``text`` (index 0 unused)."""
    import unicodedata

    c = _codes(text)
    n = len(c)
    kinds = np.zeros(n, dtype=np.int8)  # 1 Latin-like word, 2 mark
    points, where = np.unique(c, return_inverse=True)
    of = np.empty(len(points), dtype=np.int8)
    for k, p in enumerate(points.tolist()):
        ch = chr(p)
        category = unicodedata.category(ch)
        wide = p >= 0x2E80 and not 0xAC00 <= p <= 0xD7A3 or 0x0E00 <= p <= 0x0E7F
        of[k] = 2 if category[0] == "M" else 1 if (category[0] in "LN" and not wide) else 0
    kinds = of[where]
    blank = np.isin(c, np.array([ord(x) for x in " \t\u00a0\u2003\u3000"], dtype=np.uint32))
    line = c == 10
    strength = np.full(n, CHARACTER, dtype=np.int8)
    if n < 2:
        return strength
    left, right = slice(0, n - 1), slice(1, n)
    s = strength[1:]
    s[(kinds[left] > 0) & (kinds[right] == 1)] = INSIDE_WORD
    s[kinds[right] == 2] = INSIDE_CLUSTER
    s[blank[left] & ~blank[right]] = BLANK
    clause = np.isin(c, np.array([ord(x) for x in CLAUSE_MARKS], dtype=np.uint32))
    final = np.isin(c, np.array([ord(x) for x in SENTENCE_MARKS], dtype=np.uint32))
    inner = np.concatenate([[False, False], blank[1 : n - 1] & ~blank[2:n]])[:n] if n > 2 else np.zeros(n, bool)
    s[clause[left] & ~clause[right] & ~blank[right]] = np.maximum(s[clause[left] & ~clause[right] & ~blank[right]], 3)
    wide_final = final & (c > 127)
    s[wide_final[left] & ~clause[right] & ~final[right]] = SENTENCE
    if n > 2:  # a mark, one blank, then the cut
        after = inner[1:]
        s[after & np.concatenate([[False], clause[: n - 2]])] = CLAUSE
        s[after & np.concatenate([[False], final[: n - 2]])] = SENTENCE
    wide_clause = clause & (c > 127)
    pick = wide_clause[left] & ~clause[right] & ~final[right] & (s < CLAUSE)
    s[pick] = CLAUSE
    s[line[left] & ~line[right]] = LINE
    if n > 2:
        s[line[left] & ~line[right] & np.concatenate([[False], line[: n - 2]])] = PARAGRAPH
    return strength


def bisect_cuts(text: str, limit: int, overlap: int, strengths: np.ndarray | None = None) -> list[int]:
    """Positions where ``text`` is cut: pieces between them have at most limit - overlap characters."""
    core = limit - overlap
    if core <= 0 or overlap < 0:
        raise ValueError(f"max_chars {limit} must be above overlap_chars {overlap} >= 0")
    strength = boundary_strengths(text) if strengths is None else strengths
    cuts: list[int] = []
    stack = [(0, len(text))]
    while stack:
        lo, hi = stack.pop()
        if hi - lo <= core:
            continue
        mid = (lo + hi) // 2
        reach = max(1, (hi - lo) // 4)
        a, b = max(lo + 1, mid - reach), min(hi - 1, mid + reach)
        near = strength[a : b + 1]
        best = np.flatnonzero(near == near.max()) + a
        cut = int(best[np.abs(best - mid).argmin()])
        cuts.append(cut)
        stack += [(lo, cut), (cut, hi)]
    return sorted(cuts)


def pieces(text: str, limit: int, overlap: int) -> list[tuple[int, int]]:
    """(start, end) of every piece, the overlap attached."""
    if len(text) <= limit:
        return [(0, len(text))]
    cuts = bisect_cuts(text, limit, overlap)
    return [(max(0, a - overlap) if a else 0, b) for a, b in zip([0, *cuts], [*cuts, len(text)])]


def _split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = {k: [] for k in ("field_name", "rec_id", "piece_no", "start_pos", "end_pos", "piece")}
        for field, rec, value, limit, overlap in arrow_rows(batch, "field_name", "rec_id", "value", "max_chars", "overlap_chars"):
            for no, (a, b) in enumerate(pieces(value, limit, overlap)):
                for k, v in zip(rows, (field, rec, no, a, b, value[a:b])):
                    rows[k].append(v)
        yield pa.RecordBatch.from_pydict(
            rows, schema=pa.schema([("field_name", pa.string()), ("rec_id", pa.string()), ("piece_no", pa.int32()), ("start_pos", pa.int32()), ("end_pos", pa.int32()), ("piece", pa.string())])
        )


def oversized(values: DataFrame, limits: DataFrame) -> DataFrame:
    """Rows of (field_name, rec_id, value) beyond their limit, with that limit.

    ``limits`` has one row per field name (a fixed handful), so Spark broadcasts
    it by its own size check.
    """
    keyed = limits.select("field_name", "max_chars", "overlap_chars")
    return values.join(keyed, "field_name").where(F.length("value") > F.col("max_chars"))


def split_oversized(values: DataFrame, limits: DataFrame) -> DataFrame:
    """Pieces of every oversized value: (field_name, rec_id, piece_no, start_pos, end_pos, piece)."""
    return oversized(values, limits).select("field_name", "rec_id", "value", "max_chars", "overlap_chars").mapInArrow(_split, SCHEMA)


def found(values: DataFrame, limits: DataFrame) -> DataFrame:
    """(field_name, rec_id) of every value that had to be cut."""
    return split_oversized(values, limits).where(F.col("piece_no") == 1).select("field_name", "rec_id").distinct()
