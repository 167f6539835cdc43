"""Scoring of one partition's texts against each other in numpy: an inverted index of a block of references, read by a shard of queries.

A shard comes as a sorted stream of Arrow batches: the document frequencies of
the partition, its queries, its references. Queries are held as weighted terms
and as lists of their best references so far; references pass through in blocks,
so what is held doesn't grow with their number. Only the final lists leave the
task: no product of a query and a reference is ever written or shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: References in one block of the index, and cells of (query, reference) or products of weights summed up at once.
BLOCK, CELLS = 1 << 15, 1 << 20
#: Names of references held before those that are in no list are let go.
NAMES = 1 << 22
#: Kinds of rows in a shard, in the order in which they come.
FREQUENCY, QUERY, REFERENCE = 0, 1, 2
#: A hit is one integer that sorts as hits do: the complement of the rounded cosine, then the place of the reference in the order of keys.
PLACE_BITS = 40
TOP, NONE = 1 << 21, np.iinfo(np.int64).max
PLACES = (1 << PLACE_BITS) - 1


#: Grams counted before their counts are merged, and grams in one row of a written table of counts.
GATHERED, ROW_GRAMS = 1 << 22, 1 << 14
LOW, HIGH = 4, 5
_BITS = 12


def cut(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """(row, index, grams): the grams of all texts as indices into the distinct ones, by rows; as functions.text.char_grams, words parted by blanks."""
    padded = pc.binary_join_element_wise("", texts, "", " ").cast(pa.large_string())
    points = np.frombuffer("".join(padded.to_pylist()).encode("utf-32-le", "surrogatepass"), np.uint32)
    if len(points) and (points.max() >> _BITS or not points.min()):
        return _cut_words(texts)
    of = np.repeat(np.arange(len(texts), dtype=np.int64), pc.utf8_length(padded).to_numpy(zero_copy_only=False))
    blank, points = points == 32, points.astype(np.int64)
    rows, codes = [], []
    for k in (LOW - 1, LOW, HIGH):
        n = max(len(points) - k + 1, 0)
        good = ~blank[1 : n + 1]
        for i in range(2, k - 1):
            good &= ~blank[i : n + i]
        if k < LOW:
            good &= blank[:n] & blank[k - 1 : n + k - 1]
        at = np.flatnonzero(good)
        code = points[at]
        for i in range(1, k):
            code |= points[at + i] << _BITS * i
        rows.append(of[at])
        codes.append(code)
    found = pa.array(np.concatenate(codes)).dictionary_encode()
    distinct = found.dictionary.to_numpy()
    letters = np.stack([distinct >> _BITS * i & (1 << _BITS) - 1 for i in range(HIGH)], axis=1).astype(np.uint32)
    return np.concatenate(rows), found.indices.to_numpy(), pa.array(np.ascontiguousarray(letters).view(f"U{HIGH}").ravel(), pa.string())


def _cut_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """The same for any letters."""
    rows, grams = [], []
    for row, text in enumerate(texts.to_pylist()):
        for word in text.split(" "):
            if word:
                w = f" {word} "
                mine = [w] if len(w) < LOW else [w[i : i + k] for k in (LOW, HIGH) for i in range(len(w) - k + 1)]
                rows += [row] * len(mine)
                grams += mine
    found = pa.array(grams, pa.string()).dictionary_encode()
    return np.array(rows, np.int64), found.indices.to_numpy(), found.dictionary


def pack(grams: pa.Array, counts: np.ndarray) -> Iterator[tuple[str, str]]:
    """Grams with their counts as pairs of texts, which are far smaller than rows."""
    order = pc.sort_indices(grams)
    grams, counts = grams.take(order).to_pylist(), counts[order.to_numpy()].tolist()
    for a in range(0, len(grams), ROW_GRAMS):
        yield "\n".join(grams[a : a + ROW_GRAMS]), ",".join(map(str, counts[a : a + ROW_GRAMS]))


def unpack(grams: pa.Array, counts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    return pc.split_pattern(grams, "\n").flatten(), pc.split_pattern(counts, ",").flatten().cast(pa.int64()).to_numpy(zero_copy_only=False)


def _added(parts: list[tuple[pa.Array, np.ndarray]]) -> tuple[pa.Array, np.ndarray]:
    found = pa.concat_arrays([g for g, _ in parts]).dictionary_encode()
    return found.dictionary, np.bincount(found.indices.to_numpy(), np.concatenate([n for _, n in parts]), len(found.dictionary)).astype(np.int64)


def _runs(batch: pa.RecordBatch, *columns: str) -> Iterator[tuple[tuple, pa.RecordBatch]]:
    """The stretches of rows that are equal in columns."""
    values = list(zip(*(batch.column(c).to_pylist() for c in columns)))
    starts = [i for i, v in enumerate(values) if not i or v != values[i - 1]]
    for a, b in zip(starts, [*starts[1:], len(values)]):
        yield values[a], batch.slice(a, b - a)


class _Counts:
    """Counts of grams that are merged when many have come together."""

    def __init__(self, type: pa.DataType):
        self.type, self.parts, self.size = type, [], 0

    def add(self, grams: pa.Array, counts: np.ndarray) -> None:
        self.parts.append((grams, counts))
        self.size += len(grams)
        if self.size > GATHERED and len(self.parts) > 1:
            self.parts = [_added(self.parts)]
            self.size = len(self.parts[0][0]) // 2

    def rows(self, part, field: int) -> Iterator[pa.RecordBatch]:
        for grams, counts in pack(*_added(self.parts)) if self.parts else ():
            yield pa.RecordBatch.from_arrays([pa.array([part], self.type), pa.array([field], pa.int32()), pa.array([grams]), pa.array([counts])], names=["part", "field", "grams", "counts"])


def count_grams(batches: Iterator[pa.RecordBatch], fields: int) -> Iterator[pa.RecordBatch]:
    """(part, field, grams, counts) from (part, t0, t1, ...) sorted by part: in how many texts of this task each gram stands."""
    of, counts = None, []
    for batch in batches:
        for (part,), rows in _runs(batch, "part"):
            if part != of:
                for f, c in enumerate(counts):
                    yield from c.rows(of, f)
                of, counts = part, [_Counts(rows.column("part").type) for _ in range(fields)]
            for f, c in enumerate(counts):
                row, index, grams = cut(rows.column(f"t{f}"))
                each = np.unique(row * max(len(grams), 1) + index) % max(len(grams), 1)
                c.add(grams, np.bincount(each, minlength=len(grams)))
    for f, c in enumerate(counts):
        yield from c.rows(of, f)


def merge_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The counts of all tasks, sorted by part and field, added up."""
    of, counts = None, None
    for batch in batches:
        for key, rows in _runs(batch, "part", "field"):
            if key != of:
                if counts is not None:
                    yield from counts.rows(*of)
                of, counts = key, _Counts(rows.column("part").type)
            counts.add(*unpack(rows.column("grams"), rows.column("counts")))
    if counts is not None:
        yield from counts.rows(*of)


class Field:
    """The vocabulary of one field of a partition."""

    def __init__(self, frequency: list[tuple[pa.Array, np.ndarray]], n: int, max_df: float):
        self.grams = pa.concat_arrays([pa.array([], pa.string()), *(g for g, _ in frequency)])
        df = np.concatenate([np.empty(0), *(c for _, c in frequency)])
        self.unseen = np.log(1.0 + n) + 1.0
        self.idf = np.where(df > max_df * n, 0.0, np.log((1.0 + n) / (1.0 + df)) + 1.0)

    def weigh(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, term, weight) of the terms that can match: log1p(tf) * idf, each row of length 1. A gram that no reference has makes its row longer."""
        row, index, grams = cut(texts)
        term = pc.fill_null(pc.index_in(grams, value_set=self.grams), -1).to_numpy(zero_copy_only=False).astype(np.int32)
        many = max(len(grams), 1)
        pair, tf = np.unique(row * many + index, return_counts=True)
        row = pair // many
        at = term[pair - row * many]
        w = np.log1p(tf) * np.where(at < 0, self.unseen, self.idf[at] if len(self.idf) else 0.0)
        norm = np.sqrt(np.bincount(row, w * w, len(texts)))
        good = np.flatnonzero((at >= 0) & (w > 0))
        row = row[good]
        return row, at[good], w[good] / norm[row]


class Asked:
    """The queries of a shard in one field, with their k best hits so far."""

    def __init__(self, field: Field, texts: pa.Array, k: int, digits: int):
        self.field, self.k, self.scale = field, k, 10.0**digits
        self.row, self.term, self.weight = field.weigh(texts)
        self.wanted = np.zeros(len(field.idf), bool)
        self.wanted[self.term] = True
        self.best = np.full((len(texts), k), NONE)

    def meet(self, texts: pa.Array, first: int) -> None:
        """Take the hits among a block of references, whose places begin at first."""
        r, term, w = self.field.weigh(texts)
        use = self.wanted[term]
        r, term, w = r[use], term[use], w[use]
        order = np.argsort(term, kind="stable")
        r, w = r[order], w[order]
        df = np.bincount(term, minlength=len(self.wanted))
        start = np.cumsum(df) - df
        # rows of queries are cut so that neither their cells nor their products are too many at once
        width, rows = len(texts), len(self.best)
        products = np.concatenate([[0], np.cumsum(np.bincount(self.row, df[self.term], rows))])
        ends = np.searchsorted(self.row, np.arange(rows + 1))
        a = 0
        while a < rows:
            b = max(a + 1, min(rows, a + CELLS // width, int(np.searchsorted(products, products[a] + CELLS, "right")) - 1))
            if products[b] > products[a]:
                self._take(a, b, ends[a], ends[b], df, start, r, w, width, first)
            a = b

    def _take(self, a: int, b: int, low: int, high: int, df: np.ndarray, start: np.ndarray, r: np.ndarray, w: np.ndarray, width: int, first: int) -> None:
        term = self.term[low:high]
        n = df[term]
        at = np.arange(n.sum()) + np.repeat(start[term] - (np.cumsum(n) - n), n)
        cell = r[at] + np.repeat((self.row[low:high] - a) * width, n)
        sums = np.bincount(cell, np.repeat(self.weight[low:high], n) * w[at], (b - a) * width)
        cell = np.flatnonzero(sums)
        row = cell // width
        hit = (TOP - np.rint(sums[cell] * self.scale).astype(np.int64) << PLACE_BITS) + (cell - row * width + first)
        better = hit < self.best[a:b].max(axis=1)[row]
        row, hit = row[better], hit[better]
        ends = np.searchsorted(row, np.arange(b - a + 1))
        for i in np.flatnonzero(np.diff(ends)):
            both = np.concatenate([self.best[a + i], hit[ends[i] : ends[i + 1]]])
            both.partition(self.k - 1)
            self.best[a + i] = both[: self.k]


class Shard:
    """A shard of the queries of one partition while its references pass."""

    def __init__(self, limits: list[int], max_df: float, digits: int):
        self.limits, self.max_df, self.digits = limits, max_df, digits
        self.n, self.frequency = 0, [[] for _ in limits]
        self.keys, self.texts, self.asked = [], [[] for _ in limits], None
        self.kind, self.waiting, self.seen = FREQUENCY, 0, 0
        self.places, self.names = np.empty(0, np.int64), pa.array([], pa.null())
        self.queries = None

    def add(self, kind: int, rows: pa.RecordBatch) -> None:
        if kind == FREQUENCY:
            self.n = rows.column("n")[0].as_py()
            field = rows.column("field").to_numpy(zero_copy_only=False)
            for f, terms in enumerate(self.frequency):
                mine = rows.filter(pa.array(field == f))
                terms.append(unpack(mine.column("grams"), mine.column("counts")))
            return
        if kind != self.kind and self.kind == QUERY:
            self._ask()
        self.kind = kind
        self.keys.append(rows.column("key"))
        for f, texts in enumerate(self.texts):
            texts.append(rows.column(f"t{f}"))
        self.waiting += rows.num_rows
        if kind == REFERENCE and self.waiting >= BLOCK:
            self._block()

    def _gathered(self) -> tuple[pa.Array, list[pa.Array]]:
        keys, texts = pa.concat_arrays(self.keys), [pa.concat_arrays(t) for t in self.texts]
        self.keys, self.texts, self.waiting = [], [[] for _ in self.limits], 0
        return keys, texts

    def _ask(self) -> None:
        self.queries, texts = self._gathered()
        self.asked = [Asked(Field(f, self.n, self.max_df), t, k, self.digits) for f, t, k in zip(self.frequency, texts, self.limits)]
        self.names, self.frequency = pa.array([], self.queries.type), []

    def _block(self) -> None:
        keys, texts = self._gathered()
        for asked, t in zip(self.asked, texts):
            asked.meet(t, self.seen)
        self.places = np.concatenate([self.places, np.arange(self.seen, self.seen + len(keys))])
        self.names = pa.concat_arrays([self.names.cast(keys.type), keys])
        self.seen += len(keys)
        if len(self.names) > NAMES:
            keep = np.isin(self.places, np.unique(np.concatenate([a.best.ravel() & PLACES for a in self.asked])))
            self.places, self.names = self.places[keep], self.names.filter(pa.array(keep))

    def result(self) -> Iterator[pa.RecordBatch]:
        """One row a pair: query, reference and the cosine of each field, 0 where it didn't retrieve the pair."""
        if self.asked is None:
            return
        if self.waiting:
            self._block()
        for a in range(0, len(self.queries), BLOCK // 8):
            hits = [x.best[a : a + BLOCK // 8] for x in self.asked]
            row, full = [], []
            for best in hits:
                i, j = np.nonzero(best < NONE)
                row.append(i)
                full.append(best[i, j])
            place = [np.searchsorted(self.places, h & PLACES) for h in full]
            pairs = [i * max(len(self.names), 1) + p for i, p in zip(row, place)]
            both, of = np.unique(np.concatenate(pairs), return_inverse=True)
            cosines, at = [], 0
            for h in full:
                c = np.zeros(len(both))
                c[of[at : at + len(h)]] = (TOP - (h >> PLACE_BITS)) / 10.0**self.digits
                cosines.append(pa.array(c))
                at += len(h)
            q = self.queries.take(pa.array(both // max(len(self.names), 1) + a))
            yield pa.RecordBatch.from_arrays([q, self.names.take(pa.array(both % max(len(self.names), 1))), *cosines], names=["q", "r", *(f"c{f}" for f in range(len(cosines)))])


def score_shards(batches: Iterator[pa.RecordBatch], limits: list[int], max_df: float, digits: int) -> Iterator[pa.RecordBatch]:
    """The lists of all shards in a stream sorted by part, shard, kind and key."""
    shard, of = None, None
    for batch in batches:
        for (part, number, kind), rows in _runs(batch, "part", "shard", "kind"):
            if (part, number) != of:
                if shard is not None:
                    yield from shard.result()
                shard, of = Shard(limits, max_df, digits), (part, number)
            shard.add(kind, rows)
    if shard is not None:
        yield from shard.result()
