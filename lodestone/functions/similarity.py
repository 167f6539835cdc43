"""String similarities of pairs: ratio of the longest common subsequence and its token and window forms.

One Arrow UDF computes all scores that are asked for in one pass over a batch.
The longest common subsequence is bit-parallel: over Python's long integers for
one pair, and over 64-bit words for all pairs of a batch at once. Both give the
same numbers to the last bit.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType


def _masks(s: str) -> dict[str, int]:
    masks: dict[str, int] = {}
    for i, c in enumerate(s):
        masks[c] = masks.get(c, 0) | 1 << i
    return masks


def _lcs(masks: dict[str, int], m: int, b: str) -> int:
    """Length of the longest common subsequence of a text of m characters, given by its masks, and b."""
    full = (1 << m) - 1
    row = full
    for c in b:
        x = row & masks.get(c, 0)
        row = (row + x | row - x) & full
    return m - row.bit_count()


def lcs_length(a: str, b: str) -> int:
    return _lcs(_masks(a), len(a), b)


def ratio(a: str, b: str) -> float:
    """100 * 2 * LCS / (length of both); two empty texts give 100."""
    n = len(a) + len(b)
    return 100.0 if not n else 200.0 * lcs_length(a, b) / n if a and b else 0.0


def token_sort_ratio(a: str, b: str) -> float:
    return ratio(" ".join(sorted(a.split())), " ".join(sorted(b.split())))


def token_set_ratio(a: str, b: str) -> float:
    """Likeness of token sets; one within the other is 100, a side without tokens gives 0."""
    x, y = set(a.split()), set(b.split())
    if not x or not y:
        return 0.0
    both, left, right = x & y, " ".join(sorted(x - y)), " ".join(sorted(y - x))
    if both and not (left and right):
        return 100.0
    shared = len(" ".join(sorted(both)))
    gap = 1 if shared else 0
    whole = (shared + gap + len(left)) + (shared + gap + len(right))
    best = 100.0 * (1 - (len(left) + len(right) - 2 * lcs_length(left, right)) / whole)
    if shared:
        for part in (left, right):
            best = max(best, 100.0 * (1 - (gap + len(part)) / (shared + shared + gap + len(part))))
    return best


def partial_ratio(a: str, b: str) -> float:
    """Best ratio of the shorter text with a window of the longer; windows at the ends may be shorter."""
    if not a and not b:
        return 100.0
    if not a or not b:
        return 0.0
    if len(a) == len(b):
        return max(_windows(a, b), _windows(b, a))
    return _windows(a, b) if len(a) < len(b) else _windows(b, a)


def _windows(short: str, long: str) -> float:
    masks, m, n = _masks(short), len(short), len(long)
    best = 0.0
    for i in range(1 - m, n):
        w = long[max(0, i) : i + m]
        # a window that begins (or, at the left end, ends) with a foreign character is beaten by one without it
        if (w[0] if i > 0 else w[-1]) not in masks:
            continue
        if 200.0 * min(m, len(w)) / (m + len(w)) <= best:
            continue
        best = max(best, 200.0 * _lcs(masks, m, w) / (m + len(w)))
        if best == 100.0:
            break
    return best


SCORERS = {"ratio": ratio, "token_sort_ratio": token_sort_ratio, "token_set_ratio": token_set_ratio, "partial_ratio": partial_ratio}


# ------------------------------------------------------------------ batches
#: Letters of the shorter text that one machine word holds; longer pairs are scored one by one.
WORD = 64
#: Cells of the tables that are computed at once, so that they stay in the processor's cache.
CELLS = 100_000


def _codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(lengths, code points of all texts in a row)."""
    return np.fromiter(map(len, texts), np.int64, len(texts)), np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)


def _grid(codes: np.ndarray, begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """(texts, letters): the codes of the texts, padded with 0."""
    width = int(sizes.max(initial=0))
    at = begins[:, None] + np.arange(width)
    inside = np.arange(width) < sizes[:, None]
    return np.where(inside, codes[np.where(inside, at, 0)] if len(codes) else 0, 0)


class _Pairs:
    """Texts of a batch as small codes, the shorter of each pair (at most WORD letters) apart from the longer."""

    def __init__(self, short: list[str], long: list[str]) -> None:
        (self.m, x), (self.n, y) = _codes(short), _codes(long)
        # code 0 is the padding
        dense = np.zeros(int(max(x.max(initial=0), y.max(initial=0))) + 1, np.int64)
        dense[x] = dense[y] = 1
        self.letters = int(dense.sum()) + 1
        dense *= np.cumsum(dense)
        self.x, self.y = dense[x], dense[y]
        self.x0, self.y0 = np.cumsum(self.m) - self.m, np.cumsum(self.n) - self.n

    def masks(self, rows: np.ndarray) -> np.ndarray:
        """(rows, letters of the longer text): where in the shorter text each letter of the longer one is."""
        at = np.arange(len(rows))
        table = np.zeros((len(rows), self.letters), np.uint64)
        for i, column in enumerate(_grid(self.x, self.x0[rows], self.m[rows]).T):
            table[at, column] |= np.uint64(1 << i)
        table[:, 0] = 0
        return np.take_along_axis(table, _grid(self.y, self.y0[rows], self.n[rows]), axis=1)

    def parts(self, order: np.ndarray, cells: np.ndarray) -> list[np.ndarray]:
        """order in parts of about CELLS cells."""
        return np.split(order, np.flatnonzero(np.diff(np.cumsum(cells[order]) // CELLS)) + 1) if len(order) else []

    def common(self) -> np.ndarray:
        """Lengths of the longest common subsequences."""
        out = np.zeros(len(self.m), np.int64)
        for rows in self.parts(np.argsort(self.n, kind="stable"), self.n + self.letters):
            row = np.full(len(rows), ~np.uint64(0))
            for mask in np.ascontiguousarray(self.masks(rows).T):
                x = row & mask
                row = row + x | row - x
            out[rows] = np.bitwise_count(~row)
        return out

    def windows(self) -> np.ndarray:
        """The best ratio of each shorter text (not empty) with a window of the longer."""
        out = np.zeros(len(self.m))
        for m in np.unique(self.m).tolist():
            of_m = np.flatnonzero(self.m == m)
            for rows in self.parts(of_m[np.argsort(self.n[of_m], kind="stable")], self.n + 2 * m + self.letters):
                masks = self.masks(rows).T
                padded = np.zeros((len(masks) + 2 * (m - 1), len(rows)), np.uint64)
                padded[m - 1 : m - 1 + len(masks)] = masks
                count = len(masks) + m - 1
                row = np.full((count, len(rows)), ~np.uint64(0))
                for s in range(m):
                    x = row & padded[s : s + count]
                    row = row + x | row - x
                first = np.arange(1 - m, len(masks))[:, None]
                size = np.minimum(first + m, self.n[rows]) - np.maximum(first, 0)
                out[rows] = (200.0 * np.bitwise_count(~row) / (m + np.maximum(size, 1))).max(axis=0)
        return out


def _by_length(a: list[str], b: list[str]) -> tuple[list[str], list[str]]:
    """The shorter and the longer text of each pair."""
    turned = [(x, y) if len(x) <= len(y) else (y, x) for x, y in zip(a, b)]
    return [x for x, _ in turned], [y for _, y in turned]


def lcs_lengths(a: list[str], b: list[str]) -> np.ndarray:
    """lcs_length of many pairs."""
    short, long = _by_length(a, b)
    out = np.zeros(len(a), np.int64)
    fits = [i for i, x in enumerate(short) if 0 < len(x) <= WORD]
    out[fits] = _Pairs([short[i] for i in fits], [long[i] for i in fits]).common()
    for i, x in enumerate(short):
        if len(x) > WORD:
            out[i] = lcs_length(x, long[i])
    return out


def ratios(a: list[str], b: list[str]) -> np.ndarray:
    n = np.fromiter((len(x) + len(y) for x, y in zip(a, b)), np.int64, len(a))
    return np.where(n > 0, 200.0 * lcs_lengths(a, b) / np.maximum(n, 1), 100.0)


def token_sort_ratios(a: list[str], b: list[str]) -> np.ndarray:
    known: dict[str, str] = {}
    for x in {*a, *b}:
        known[x] = " ".join(sorted(x.split()))
    return ratios([known[x] for x in a], [known[x] for x in b])


def token_set_ratios(a: list[str], b: list[str]) -> np.ndarray:
    known = {x: frozenset(x.split()) for x in {*a, *b}}
    out, rows, left, right, shared = np.zeros(len(a)), [], [], [], []
    for i, (s, t) in enumerate(zip(a, b)):
        x, y = known[s], known[t]
        if not x or not y:
            continue
        both = x & y
        if both and (len(both) == len(x) or len(both) == len(y)):
            out[i] = 100.0
            continue
        rows.append(i)
        left.append(" ".join(sorted(x - both)))
        right.append(" ".join(sorted(y - both)))
        shared.append(sum(map(len, both)) + len(both) - 1 if both else 0)
    if rows:
        l, r = (np.fromiter(map(len, v), np.int64, len(v)) for v in (left, right))
        n = np.array(shared, np.int64)
        gap = (n > 0).astype(np.int64)
        best = 100.0 * (1 - (l + r - 2 * lcs_lengths(left, right)) / ((n + gap + l) + (n + gap + r)))
        for part in (l, r):
            best = np.where(n > 0, np.maximum(best, 100.0 * (1 - (gap + part) / (n + n + gap + part))), best)
        out[rows] = best
    return out


def partial_ratios(a: list[str], b: list[str]) -> np.ndarray:
    short, long = _by_length(a, b)
    out = np.array([100.0 if not y else 0.0 for y in long])
    fits = [i for i, x in enumerate(short) if 0 < len(x) <= WORD]
    out[fits] = _Pairs([short[i] for i in fits], [long[i] for i in fits]).windows()
    even = [i for i in fits if len(short[i]) == len(long[i])]
    out[even] = np.maximum(out[even], _Pairs([long[i] for i in even], [short[i] for i in even]).windows())
    for i, x in enumerate(short):
        if len(x) > WORD:
            out[i] = partial_ratio(x, long[i])
    return out


BATCHES: dict[Callable, Callable] = {ratio: ratios, token_sort_ratio: token_sort_ratios, token_set_ratio: token_set_ratios, partial_ratio: partial_ratios}


@lru_cache(maxsize=64)
def _udf(names: tuple[str, ...], scorers: tuple):
    schema = StructType([StructField(n, DoubleType()) for n in names])

    @F.pandas_udf(schema)
    def run(sides: pd.DataFrame) -> pd.DataFrame:
        columns = {}
        for k, (name, scorer) in enumerate(zip(names, scorers)):
            a, b = ([x or "" for x in sides[f"{side}{k}"]] for side in "ab")
            columns[name] = BATCHES[scorer](a, b) if scorer in BATCHES else [scorer(x, y) for x, y in zip(a, b)]
        return pd.DataFrame(columns, columns=list(names))

    return run


def score_pairs(scores: dict[str, tuple[str, Column, Column]]) -> Column:
    """A struct of scores: {name: (scorer, left text, right text)}; scorer is a name of SCORERS or a function of two strings. Null counts as empty."""
    names = tuple(scores)
    scorers = tuple(SCORERS[s] if isinstance(s, str) else s for s, _, _ in scores.values())
    sides = F.struct(*[c.alias(f"{side}{k}") for k, (_, a, b) in enumerate(scores.values()) for side, c in (("a", a), ("b", b))])
    return _udf(names, scorers)(sides)


def safe_ratio(a: Column, b: Column) -> Column:
    """The smaller over the greater, 0 if both are 0."""
    return F.when(F.greatest(a, b) > 0, F.least(a, b) / F.greatest(a, b)).otherwise(F.lit(0.0))
