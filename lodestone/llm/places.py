"""Which address records denote the same place.

Addresses are reduced to distinct parsed forms first, so that a place written
the same way a million times is compared once. The distinct words of streets and
localities enter a deletion-neighbourhood index (the word, and all strings with
one letter left out, two of a longer word), and the words that meet in it and
are alike become links: of streets to their spellings, of localities to their
neighbours. Inside a block, which is an equal postcode or a neighbouring
locality, or none if a form has nothing to compare, forms of one number meet if
a street of one is linked to a component of the other. That loses no pair that
the comparison would keep. Forms that meet are compared by assigning the
components of one to those of the other so that the total likeness is greatest,
with vetoes on the number and, if asked for, on the unit.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.llm.deletions import words_that_meet
from lodestone.llm.records import distance, parse_records
from lodestone.session import release, stage

PARTS = ["number", "street", "towns", "postcode", "state", "unit"]


@lru_cache(maxsize=500_000)
def alike(a: str, b: str) -> float:
    """Likeness of two components, 0 if they differ too much."""
    if a == b:
        return 1.0
    k = 2 if max(len(a), len(b)) >= 7 else 1
    d = distance(a, b, k)
    if d <= k:
        return 1.0 - d / max(len(a), len(b), 1)
    short, long = sorted((a, b), key=len)
    return 0.75 if len(short) >= 5 and long.startswith(short) else 0.0


def hungarian(like: list[list[float]]) -> list[int]:
    """The column of each row so that the total is greatest; no more rows than columns."""
    n, m = len(like), len(like[0]) if like else 0
    u, v, row_of, way = [0.0] * (n + 1), [0.0] * (m + 1), [0] * (m + 1), [0] * (m + 1)
    for i in range(1, n + 1):
        row_of[0], at = i, 0
        least, seen = [math.inf] * (m + 1), [False] * (m + 1)
        while row_of[at]:
            seen[at] = True
            r, delta, to = row_of[at], math.inf, 0
            for j in range(1, m + 1):
                if not seen[j]:
                    cost = -like[r - 1][j - 1] - u[r] - v[j]
                    if cost < least[j]:
                        least[j], way[j] = cost, at
                    if least[j] < delta:
                        delta, to = least[j], j
            for j in range(m + 1):
                if seen[j]:
                    u[row_of[j]] += delta
                    v[j] -= delta
                else:
                    least[j] -= delta
            at = to
        while at:
            row_of[at] = row_of[way[at]]
            at = way[at]
    columns = [0] * n
    for j in range(1, m + 1):
        if row_of[j]:
            columns[row_of[j] - 1] = j - 1
    return columns


def assign(a: list[str], b: list[str]) -> tuple[float, list[tuple[int, int]]]:
    """The assignment of components of a to components of b with the greatest total likeness."""
    if len(a) > len(b):
        total, pairs = assign(b, a)
        return total, [(j, i) for i, j in pairs]
    like = [[alike(x, y) for y in b] for x in a]
    columns = hungarian(like) if len(a) > 2 else _few(like)
    pairs = [(i, j) for i, j in enumerate(columns) if like[i][j] > 0]
    return sum(like[i][j] for i, j in pairs), pairs


def _few(like: list[list[float]]) -> list[int]:
    """The same as hungarian for one or two rows, by trying all."""
    m = len(like[0]) if like else 0
    if len(like) == 1:
        return [max(range(m), key=lambda j: like[0][j])]
    return list(max(((i, j) for i in range(m) for j in range(m) if i != j), key=lambda p: like[0][p[0]] + like[1][p[1]], default=())) if like else []


def same_place(x: dict, y: dict, veto_unit: bool = False) -> float:
    """Likeness of two parsed addresses, 0 if they are not the same place."""
    if x["number"] != y["number"]:
        return 0.0
    if veto_unit and x["unit"] and y["unit"] and x["unit"] != y["unit"]:
        return 0.0
    return likeness(*(side[p] for side in (x, y) for p in ("street", "towns", "postcode", "state")))


def likeness(xs: str, x_towns: str, x_post: str, x_state: str, ys: str, y_towns: str, y_post: str, y_state: str) -> float:
    """Likeness of two places of one number, 0 if they are not the same."""
    xt, yt = x_towns.split(), y_towns.split()
    if xs == ys and (not xt or not yt or xt == yt):
        total, pairs, street = 1.0 + bool(xt and yt), [(0, 0)] + [(1, 1)] * bool(xt and yt), 1.0
    else:
        mine, other = [xs, *xt], [ys, *yt]
        total, pairs = assign(mine, other)
        street = max((alike(mine[i], other[j]) for i, j in pairs if i == 0 or j == 0), default=0.0)
    if not any(i == 0 or j == 0 for i, j in pairs):
        return 0.0
    post = bool(x_post) and x_post == y_post
    town = len(pairs) > 1
    if not town and not post:
        if xt and yt or x_post and y_post:
            return 0.0
        if x_state and y_state and x_state != y_state:
            return 0.0
        if street < 0.85:
            return 0.0
    return total + post


def word_links(left: DataFrame, right: DataFrame) -> DataFrame:
    """(left_word, right_word): all words (column w, distinct) of both sides that alike takes for equal or near, but of words of up to three letters only equal ones.

    Only those deletion strings are written that the other side may have too.
    """
    left, right = stage(left, "words"), stage(right, "words")
    lw, rw = F.col("left_word"), F.col("right_word")
    near = (F.levenshtein(lw, rw, 4) >= 0) | F.startswith(lw, rw) | F.startswith(rw, lw)
    # beginnings of at least five letters, for words that are cut off
    met = words_that_meet(left, right, 5, False).where(near & ((lw == rw) | (F.greatest(F.length(lw), F.length(rw)) >= 4))).distinct()

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [alike(x, y) > 0 for x, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return met.mapInArrow(judge, "left_word string, right_word string")


def _components(forms: DataFrame) -> DataFrame:
    """Every component of every form: form, number, w, whether it is the street."""
    towns = F.transform(F.filter(F.split("towns", " "), lambda x: F.length(x) > 0), lambda x: F.struct(x.alias("w"), F.lit(False).alias("street")))
    return forms.select("form", "number", F.explode(F.array_distinct(F.concat(F.array(F.struct(F.col("street").alias("w"), F.lit(True).alias("street"))), towns))).alias("c")).select("form", "number", "c.w", "c.street")


def _may_be_near(x: str, y: str) -> Column:
    """Whether the localities of two forms allow one place: equal postcodes, neighbouring towns, or nothing that both name."""
    xt, yt, xp, yp = F.col(f"{x}.towns"), F.col(f"{y}.towns"), F.col(f"{x}.postcode"), F.col(f"{y}.postcode")
    words = lambda c: F.split(c, " ")
    # any component may stand for a town: parsers take streets for towns and towns for streets
    mine, other = F.concat(words(xt), F.array(F.col(f"{x}.street"))), F.concat(words(yt), F.array(F.col(f"{y}.street")))

    def close(s: Column, t: Column) -> Column:
        return (F.levenshtein(s, t, 4) >= 0) | F.startswith(s, t) | F.startswith(t, s)

    shared = F.size(F.filter(mine, lambda s: F.exists(other, lambda t: close(s, t)))) > 1
    silent = ((xt == "") | (yt == "")) & ((xp == "") | (yp == ""))
    return ((xp != "") & (xp == yp)) | silent | shared


def place_links(left: DataFrame, right: DataFrame, veto_unit: bool = False) -> DataFrame:
    """(left_form, right_form, likeness) of the forms that denote one place.

    left, right: distinct forms with the columns form and PARTS (see forms_of).
    Forms of equal street and towns need no assignment and are judged as columns.
    """
    left, right = stage(left, "forms"), stage(right, "forms")
    lc, rc = _components(left), _components(right)
    links = stage(word_links(lc.select("w").distinct(), rc.select("w").distinct()), "component-links")
    lw = lc.select(F.col("form").alias("left_form"), "number", F.col("w").alias("left_word"), F.col("street").alias("ls"))
    # a town only has to meet words that are a street on the other side
    streets = lc.groupBy(F.col("w").alias("left_word")).agg(F.max("street").alias("of_street"))
    rw = rc.select(F.col("form").alias("right_form"), "number", F.col("w").alias("right_word"), F.col("street").alias("rs")).join(links.join(streets, "left_word"), "right_word").where(F.col("rs") | F.col("of_street")).drop("right_word", "of_street")
    met = lw.join(rw, ["number", "left_word"]).where(F.col("ls") | F.col("rs")).select("left_form", "right_form").distinct()
    met = stage(met, "form-pairs")
    release(links)
    # the numbers of forms that met are equal
    parts = [p for p in PARTS if p != "number" and (veto_unit or p != "unit")]
    pairs = met.join(left.select(F.col("form").alias("left_form"), F.struct(*parts).alias("x")), "left_form").join(right.select(F.col("form").alias("right_form"), F.struct(*parts).alias("y")), "right_form")
    if veto_unit:
        pairs = pairs.where((F.col("x.unit") == "") | (F.col("y.unit") == "") | (F.col("x.unit") == F.col("y.unit")))
    pairs = pairs.where(_may_be_near("x", "y"))
    post = ((F.col("x.postcode") != "") & (F.col("x.postcode") == F.col("y.postcode"))).cast("double")
    same = (F.col("x.street") == F.col("y.street")) & (F.col("x.towns") == F.col("y.towns")) & (F.col("x.towns") != "")
    marked = pairs.withColumn("likeness", F.when(same, F.lit(2.0) + post))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            known = batch.column("likeness").to_pylist()
            sides = [[batch.column(s).field(p).to_pylist() for p in ("street", "towns", "postcode", "state")] for s in "xy"]
            like = [k if k is not None else likeness(*v) for k, *v in zip(known, *sides[0], *sides[1])]
            out = pa.RecordBatch.from_arrays([batch.column("left_form"), batch.column("right_form"), pa.array(like, pa.float64())], names=["left_form", "right_form", "likeness"])
            yield out.filter(pa.array([v > 0 for v in like], pa.bool_()))

    return marked.select("left_form", "right_form", "x", "y", "likeness").mapInArrow(judge, "left_form bigint, right_form bigint, likeness double")


def with_form(parsed: DataFrame) -> DataFrame:
    """Parsed records that denote a place, with the number of their form."""
    return parsed.where((F.length("number") > 0) & (F.length("street") > 0)).withColumn("form", F.xxhash64(*PARTS))


def forms_of(parsed: DataFrame) -> DataFrame:
    return parsed.select("form", *PARTS).dropDuplicates(["form"])


def match_addresses(left: DataFrame, right: DataFrame, left_id: str, right_id: str, address: str, veto_unit: bool = False) -> DataFrame:
    """(left_id, right_id, likeness): pairs of records located at the same place.

    A place is a house number, a street and a town; unit, floor, landmark and
    telephone don't count unless veto_unit, which keeps different units apart.
    A null or empty address, or one without number and street, denotes no place
    and is in no pair. Repeated rows give one pair. Addresses of any length are
    read whole. left_id and right_id name the id columns and must differ; other
    columns are not read. An empty side gives no pairs.
    """
    if left_id.lower() == right_id.lower():
        raise ValueError("left_id and right_id need different names")

    def read(df: DataFrame, key: str) -> DataFrame:
        rows = df.select(F.col(f"`{key}`").alias("_id"), F.col(f"`{address}`").alias("_address"), F.lit(None).cast("string").alias("_name")).dropDuplicates()
        return stage(with_form(parse_records(rows, "_name", "_address").drop("words")), "places")

    a, b = read(left, left_id), read(right, right_id)
    links = stage(place_links(forms_of(a), forms_of(b), veto_unit), "place-links")
    pairs = links.join(a.select(F.col("_id").alias(left_id), F.col("form").alias("left_form")), "left_form").join(b.select(F.col("_id").alias(right_id), F.col("form").alias("right_form")), "right_form")
    return pairs.groupBy(left_id, right_id).agg(F.max("likeness").alias("likeness"))
