"""Held-out passages inside a corpus: n-gram seeds, then alignment around each match.

A stretch of L words of which one in ten may be changed keeps, by the pigeonhole
principle, a run of unchanged words: with the shortest stretch of 30 and three
changes, 27 words stand in at most four runs, so one run has seven. Every
seven-gram of the items is therefore a seed, and no leak can be without one. A
document is tokenised once and its seven-grams are looked up in the index of the
items. Hits on one diagonal that follow each other make one exact match, and a
match goes on only if a window of the required length around it can have few
enough changes, counted over all diagonals that the changes can lead to; that
bound loses nothing, also for formulas that stand in many items. What is left is
extended on both sides of the match by banded edit distance over words, and the
longest stretch with few enough changes decides.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Words of items in one pass over the corpus; more items are taken in several passes.
BLOCK_WORDS = 2_000_000

_NOTES = re.compile(r"\[[^\[\]]*\]|\([^()]*\)")
_INSIDE = re.compile(r"(?<=\d)[.,'’](?=\d)|['’‘ʼ`´]|­|[​-‏⁠-⁤﻿]|-[ \t]*[\r\n]+[ \t]*(?=[a-z])")
_WORD = re.compile(r"[^\W_]+")
_MARKS = re.compile(r"[̀-ͯ]+")


def words_of(text: str | None) -> list[str]:
    """Words without case, accents, punctuation, blanks, line ends and notes in brackets."""
    if not text:
        return []
    text, n = _NOTES.subn(" ", text.lower())
    while n:
        text, n = _NOTES.subn(" ", text)
    if not text.isascii():
        text = _MARKS.sub("", unicodedata.normalize("NFKD", text)).replace("ß", "ss")
    return _WORD.findall(_INSIDE.sub("", text))


def extend(doc: np.ndarray, item: np.ndarray, band: int) -> np.ndarray:
    """Least changes with which the first j words of item stand at the beginning of doc, the last of them unchanged.

    A change is an item word changed or missing or a word put in; at most `band`
    of one kind are followed. Without a way the value is large.
    """
    far, m = 1 << 20, len(item)
    out = np.full(m + 1, far)
    out[0] = 0
    offset = np.arange(-band, band + 1)
    padded = np.full(m + 2 * band + 1, -9, dtype=np.int64)
    padded[band : band + min(len(doc), m + band)] = doc[: m + band]
    row = np.where(offset >= 0, offset, far)
    for j in range(1, m + 1):
        # words of doc at place j + offset
        same = padded[j - 1 : j + 2 * band] == item[j - 1]
        if same.any():
            out[j] = row[same].min()
        below = np.append(row[1:], far)
        new = np.minimum(np.where(j + offset >= 1, row + ~same, far), below + 1)
        row = np.minimum.accumulate(new - offset) + offset
        if row.min() > band:
            break
    return out


@dataclass
class ItemIndex:
    """Seven-grams of a block of items, by hash."""

    ids: list[int]
    texts: list[str]
    shortest: int = 30
    per_change: int = 10
    frequent: int = 8
    seed: int = field(init=False)
    vocab: dict[str, int] = field(init=False)
    words: list[np.ndarray] = field(init=False)

    def __post_init__(self) -> None:
        changes = self.shortest // self.per_change
        self.seed = -(-(self.shortest - changes) // (changes + 1))
        self.vocab = {}
        self.words = [np.array([self.vocab.setdefault(w, len(self.vocab) + 1) for w in words_of(t)], dtype=np.int64) for t in self.texts]
        self.pad = 4 * self.shortest
        self.starts = np.cumsum([self.pad] + [len(w) + self.pad for w in self.words])[:-1]
        self.flat = np.full(sum(len(w) + self.pad for w in self.words) + 3 * self.pad, -1, dtype=np.int32)
        for a, w in zip(self.starts, self.words):
            self.flat[a : a + len(w)] = w
        h = self.hashes(self.flat)
        inside = np.concatenate([np.arange(a, a + len(w) - self.seed + 1) for a, w in zip(self.starts, self.words)] or [np.zeros(0, np.int64)]).astype(np.int64)
        order = np.argsort(h[inside], kind="stable")
        self.place = inside[order]
        self.keys, self.first, self.many = np.unique(h[self.place], return_index=True, return_counts=True)

    def hashes(self, w: np.ndarray) -> np.ndarray:
        n = len(w) - self.seed + 1
        if n <= 0:
            return np.zeros(0, np.uint64)
        x = (w.astype(np.int64).astype(np.uint64) + np.uint64(2)) * np.uint64(0x9E3779B97F4A7C15)
        h = np.zeros(n, np.uint64)
        for k in range(self.seed):
            h = (h ^ x[k : k + n]) * np.uint64(0xBF58476D1CE4E5B9)
            h ^= h >> np.uint64(29)
        return h

    def encode(self, words: list[str]) -> np.ndarray:
        get = self.vocab.get
        return np.fromiter((get(w, 0) for w in words), dtype=np.int64, count=len(words))

    def matches(self, w: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Maximal exact matches: first place in w and in the flat items, further seeds, whether one of them is rare."""
        h = self.hashes(w)
        if not len(h) or not len(self.keys):
            return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, bool),)
        at = np.minimum(np.searchsorted(self.keys, h), len(self.keys) - 1)
        hit = np.flatnonzero((self.keys[at] == h) & (w[: len(h)] > 0))
        k = at[hit]
        many = self.many[k]
        doc = np.repeat(hit, many)
        inside = np.arange(len(doc)) - np.repeat(np.cumsum(many) - many, many)
        place = self.place[np.repeat(self.first[k], many) + inside]
        rare = np.repeat(many <= self.frequent, many)
        order = np.lexsort((doc, doc - place))
        doc, place, rare = doc[order], place[order], rare[order]
        new = np.flatnonzero(np.concatenate(([True], (np.diff(doc) != 1) | (np.diff(doc - place) != 0)))) if len(doc) else np.zeros(0, np.int64)
        more = np.diff(np.concatenate((new, [len(doc)]))) - 1
        return doc[new], place[new], more, np.logical_or.reduceat(rare, new) if len(new) else np.zeros(0, bool)

    def promising(self, flat: np.ndarray, doc: np.ndarray, place: np.ndarray, more: np.ndarray) -> np.ndarray:
        """Which matches can lie in a long enough stretch.

        A stretch of twice `shortest` words or more has a valid part below that
        length. So of all windows of `shortest` to 2 * `shortest` - 1 item words
        that hold a seed of the match, one must have all words but the changes
        allowed at its length on a diagonal that differs by no more than their
        number. This loses no stretch.
        """
        s, longest = self.shortest, 2 * self.shortest - 1
        c = longest // self.per_change
        lead, seeds = longest - self.seed, s - self.seed
        span = lead + seeds + longest
        item_windows = np.lib.stride_tricks.sliding_window_view(self.flat, span)
        doc_windows = np.lib.stride_tricks.sliding_window_view(flat, span + 2 * c)
        keep = more >= seeds
        for a in range(0, len(doc), 20_000):
            part = np.flatnonzero(~keep[a : a + 20_000]) + a
            i, d = item_windows[place[part] - lead], doc_windows[doc[part] - lead - c]
            same = np.zeros(i.shape, bool)
            for e in range(2 * c + 1):
                same |= d[:, e : e + span] == i
            total = np.cumsum(same, axis=1, dtype=np.int16)
            total = np.concatenate((np.zeros((len(part), 1), np.int16), total), axis=1)
            # every window of the shortest length inside a stretch has no more changes than the stretch
            maybe = (total[:, s:] - total[:, :-s]).max(axis=1, initial=0) >= s - c
            part, total = part[maybe], total[maybe]
            for length in range(s, longest + 1):
                keep[part] |= (total[:, length:] - total[:, :-length]).max(axis=1, initial=0) >= length - length // self.per_change
        return keep

    def longest(self, words: np.ndarray, item: np.ndarray, at: int, place: int, run: int) -> int:
        """Item words of the longest stretch around an exact match of run words; 0 if there are too many changes."""
        band = len(item) // self.per_change
        before = extend(words[:at][::-1][: len(item) + band], item[:place][::-1], band)
        after = extend(words[at + run : at + run + len(item) + band], item[place + run :], band)
        n = run + np.arange(len(before))[:, None] + np.arange(len(after))[None, :]
        ok = (before[:, None] + after[None, :]) * self.per_change <= n
        return int(n[ok].max(initial=0))

    def search(self, texts: list[str | None]) -> list[tuple[int, int, int]]:
        """(position of the text, item, words) of every long enough stretch in the texts."""
        pad = self.pad
        docs = [self.encode(words_of(t)) for t in texts]
        starts = np.cumsum([pad] + [len(w) + pad for w in docs])[:-1]
        flat = np.zeros(int(sum(len(w) + pad for w in docs)) + 3 * pad, dtype=np.int32)
        for a, w in zip(starts, docs):
            flat[a : a + len(w)] = w
        doc, place, more, _ = self.matches(flat)
        keep = self.promising(flat, doc, place, more)
        doc, place, run = doc[keep], place[keep], more[keep] + self.seed
        text, item = np.searchsorted(starts, doc, side="right") - 1, np.searchsorted(self.starts, place, side="right") - 1
        best: dict[tuple[int, int], int] = {}
        for k in np.argsort(-run, kind="stable"):
            key = (int(text[k]), int(item[k]))
            w = self.words[key[1]]
            if best.get(key, 0) < len(w):
                best[key] = max(best.get(key, 0), self.longest(docs[key[0]], w, int(doc[k] - starts[key[0]]), int(place[k] - self.starts[key[1]]), int(run[k])))
        return [(t, i, n) for (t, i), n in sorted(best.items()) if n >= self.shortest]


def find_leaks(corpus: DataFrame, doc_id: str, text: str, items: DataFrame, item_id: str, item_text: str, shortest: int = 30, per_change: int = 10, block_words: int = BLOCK_WORDS) -> DataFrame:
    """(item_id, doc_id, n_words): documents with a stretch of at least `shortest` words of an item.

    One word in `per_change` of the stretch may be changed, missing or put in.
    Items are the stated query set: they are read in blocks of `block_words`
    words, each block is matched against all rows of the corpus in one scan
    without a shuffle, and so the size of what is sent to the tasks is bounded
    whatever the number of items. A null or empty text has no leak. A document
    that stands several times comes out once; so does an item. An empty frame on
    either side gives an empty result. Other columns are not read.
    """
    spark = corpus.sparkSession
    docs = corpus.select(F.col(f"`{doc_id}`").alias("_d"), F.col(f"`{text}`").alias("_t"))
    d_type, i_type = docs.schema["_d"].dataType.simpleString(), items.schema[item_id].dataType.simpleString()
    out = spark.createDataFrame([], f"_i {i_type}, _d {d_type}, _n bigint")
    block: list = []
    size = 0

    def passes(rows: list) -> DataFrame:
        index = spark.sparkContext.broadcast(ItemIndex([r[0] for r in rows], [r[1] for r in rows], shortest, per_change))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            found = index.value
            for batch in batches:
                ids = batch.column(0).to_pylist()
                hits = []
                for a in range(0, len(ids), 500):
                    hits += [(found.ids[i], ids[a + t], n) for t, i, n in found.search(batch.column(1).slice(a, 500).to_pylist())]
                yield pa.RecordBatch.from_arrays([pa.array([h[0] for h in hits], pa_i), pa.array([h[1] for h in hits], pa_d), pa.array([h[2] for h in hits], pa.int64())], names=["_i", "_d", "_n"])

        return docs.mapInArrow(run, f"_i {i_type}, _d {d_type}, _n bigint")

    from pyspark.sql.pandas.types import to_arrow_type

    pa_d, pa_i = to_arrow_type(docs.schema["_d"].dataType), to_arrow_type(items.schema[item_id].dataType)
    for r in items.select(item_id, item_text).where(F.col(item_text).isNotNull()).dropDuplicates().orderBy(item_id).toLocalIterator():
        block.append((r[0], r[1]))
        size += r[1].count(" ") + 1
        if size >= block_words:
            out, block, size = out.unionByName(passes(block)), [], 0
    if block:
        out = out.unionByName(passes(block))
    return out.groupBy("_i", "_d").agg(F.max("_n").alias("n_words")).select(F.col("_i").alias(item_id), F.col("_d").alias(doc_id), "n_words")
