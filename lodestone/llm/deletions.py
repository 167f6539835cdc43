"""Deletion strings of words, hashed in numpy, and the filter that keeps the useful ones.

Two words within k edits (insertion, deletion, change or swap of neighbours)
have a string in common that is left when at most k letters of each are left
out. A word of eleven letters has 67 such strings, so writing them all would
take many times the space of the words. The strings of the side with fewer words
are marked in a bitmap instead, and of the other side only those are written
whose mark is set. Wrong marks cost time, never pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.session import stage

#: Marks of one bitmap, marks for each string at least (more strings than fit take several rounds), and at most: strings of the other side pass by chance in inverse proportion.
MARKS, MARKS_A_KEY, MOST_A_KEY = 1 << 26, 8, 64
#: Keys that a task makes at once.
AT_ONCE = 1_000_000
_P = 0x9E3779B97F4A7C15
_Q = pow(_P, -1, 1 << 64)


@lru_cache(maxsize=256)
def _powers(n: int) -> np.ndarray:
    return np.array([pow(_P, i, 1 << 64) for i in range(n)], np.uint64)


@lru_cache(maxsize=256)
def _pairs(n: int) -> tuple[np.ndarray, np.ndarray]:
    return np.triu_indices(n, 1)


def _mix(h: np.ndarray, tag: int) -> np.ndarray:
    h = h ^ np.uint64(tag * 0xD6E8FEB86659FD93 & (1 << 64) - 1)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def word_keys(letters: np.ndarray, side: int, least: int = 6, ends: bool = True) -> np.ndarray:
    """(words, keys) of words of one length, as code points (words, letters).

    The keys are the word without up to one letter, two from seven letters on;
    the word as a beginning or, if ends, an end, from `least` letters on; and its
    own beginnings and ends that are shorter by three letters or more. The last
    two kinds only meet each other: what side 0 has as a whole meets parts of side 1.
    """
    m, n = letters.shape
    # the hash of a string is the sum of its letters times the powers of an odd number
    at = np.zeros((m, n + 1), np.uint64)
    np.cumsum((letters.astype(np.uint64) + np.uint64(1)) * np.uint64(0xA24BAED4963EE407) * _powers(n), axis=1, out=at[:, 1:])
    all_of, once, twice = at[:, n:], np.uint64(_Q), np.uint64(_Q * _Q & (1 << 64) - 1)
    i = np.arange(n)
    parts = [all_of, at[:, i] + (all_of - at[:, i + 1]) * once]
    if n >= 7:
        i, j = _pairs(n)
        parts.append(at[:, i] + (at[:, j] - at[:, i + 1]) * once + (all_of - at[:, j + 1]) * twice)
    out = [_mix(np.concatenate(parts, axis=1), 0)]
    if n >= least:
        out += [_mix(all_of, 1 + side), _mix(all_of, 3 + side)][: 1 + ends]
    if n >= least + 3:
        size = np.arange(least, n - 2)
        out.append(_mix(at[:, size], 2 - side))
        if ends:
            back = np.array([pow(_Q, int(n - s), 1 << 64) for s in size], np.uint64)
            out.append(_mix((all_of - at[:, n - size]) * back, 4 - side))
    return np.concatenate(out, axis=1)


def batch_keys(words: pa.Array, side: int, *parts) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(number of the word, key) of the words of a batch, in parts of bounded size; nulls and empty words have none. parts: least and ends of word_keys."""
    sizes = pc.utf8_length(pc.fill_null(words, "")).to_numpy(zero_copy_only=False)
    letters = np.frombuffer("".join(w or "" for w in words.to_pylist()).encode("utf-32-le", "surrogatepass"), np.uint32)
    begins = np.cumsum(sizes) - sizes
    for n in np.unique(sizes[sizes > 0]).tolist():
        rows = np.flatnonzero(sizes == n)
        step = max(1, AT_ONCE // (n * (n + 5)))
        for a in range(0, len(rows), step):
            some = rows[a : a + step]
            keys = word_keys(letters[begins[some][:, None] + np.arange(n)], side, *parts)
            yield np.repeat(some, keys.shape[1]), keys.ravel()


def _round(keys: np.ndarray, rounds: int) -> np.ndarray:
    return (keys >> np.uint64(40)) % np.uint64(rounds)


def _keys(words: DataFrame, name: str, side: int, this: int, rounds: int, marks: np.ndarray | None = None, parts: tuple = ()) -> DataFrame:
    """(k, name): the keys of words (column w) that belong to this round and, if there are marks, are marked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(0)
            for row, key in batch_keys(column, side, *parts):
                keep = np.ones(len(key), bool) if rounds == 1 else _round(key, rounds) == this
                if marks is not None:
                    slot = key & np.uint64(8 * len(marks) - 1)
                    keep &= (marks[(slot >> np.uint64(3)).astype(np.int64)] >> (slot & np.uint64(7)).astype(np.uint8) & 1).astype(bool)
                at = np.flatnonzero(keep)
                if len(at):
                    yield pa.RecordBatch.from_arrays([pa.array(key[at].view(np.int64)), column.take(pa.array(row[at]))], names=["k", name])

    return words.select("w").mapInArrow(run, f"k bigint, {name} string")


def _count(words: DataFrame) -> int:
    """How many keys words have, at most."""
    n = F.length("w").cast("bigint")
    return words.agg(F.sum(n * (n + 5))).first()[0] or 0


def _marks(words: DataFrame, side: int, this: int, rounds: int, size: int, parts: tuple = ()) -> np.ndarray:
    """The bitmap of the keys of words, as bytes."""
    slot = F.col("k").bitwiseAND(size - 1)
    cells = _keys(words, "w", side, this, rounds, parts=parts).select(F.shiftright(slot, 6).alias("cell"), F.expr("shiftleft(1L, cast(k & 63 as int))").alias("mark"))
    got = cells.groupBy("cell").agg(F.expr("bit_or(mark)").alias("mark")).toArrow()
    out = np.zeros(size // 64, np.int64)
    out[got["cell"].to_numpy()] = got["mark"].to_numpy()
    return out.view(np.uint8)


def words_that_meet(left: DataFrame, right: DataFrame, *parts) -> DataFrame:
    """(left_word, right_word): all pairs of words (column w) with a key in common, perhaps repeated. parts: least and ends of word_keys."""
    n_left, n_right = _count(left), _count(right)
    fewer, n = (0, n_left) if n_left <= n_right else (1, n_right)
    # about half of the bound: pairs of letters, not ordered ones
    rounds = max(1, -(-n // 2 * MARKS_A_KEY // MARKS))
    size = min(MARKS, 1 << max(10, (n // 2 * MOST_A_KEY).bit_length()))
    sides, names, out = (left, right), ("left_word", "right_word"), None
    for this in range(rounds):
        marks = _marks(sides[fewer], fewer, this, rounds, size, parts)
        keys = [_keys(sides[s], names[s], s, this, rounds, None if s == fewer else marks, parts) for s in (0, 1)]
        # keys are far more than the file that the planner judges them by
        met = keys[0].join(keys[1].hint("merge"), "k").select(*names)
        if rounds > 1:
            met = stage(met.distinct(), "words-met")
        out = met if out is None else out.unionByName(met)
    return out
