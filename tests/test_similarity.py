import random

import pytest
from pyspark.sql import functions as F

from lodestone.functions.similarity import lcs_length, partial_ratio, ratio, safe_ratio, score_pairs, token_set_ratio, token_sort_ratio


def _lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = row[:]
        for j, y in enumerate(b, 1):
            row[j] = last[j - 1] + 1 if x == y else max(last[j], row[j - 1])
    return row[-1]


def test_lcs_against_the_table():
    rng = random.Random(1)
    for _ in range(300):
        a, b = ("".join(rng.choice("abc ") for _ in range(rng.randrange(0, 90))) for _ in "ab")
        assert lcs_length(a, b) == _lcs(a, b)


def test_ratio_values():
    assert ratio("kitten sitting", "sitting kitten") == pytest.approx(100 * 18 / 28)
    assert ratio("", "") == 100 and ratio("", "a") == 0
    assert token_sort_ratio("b a", "a b") == 100
    assert token_set_ratio("a b", "a b c") == 100 and token_set_ratio("", "a") == 0
    assert partial_ratio("abc", "xxabcxx") == 100 and partial_ratio("", "") == 100 and partial_ratio("", "a") == 0


def test_partial_ratio_is_the_best_window():
    rng = random.Random(2)
    for _ in range(200):
        a, b = ("".join(rng.choice("abcd") for _ in range(rng.randrange(1, 12))) for _ in "ab")
        short, long = sorted((a, b), key=len)
        ways = [(short, long)] + [(long, short)] * (len(a) == len(b))
        best = max(200 * _lcs(s, w) / (len(s) + len(w)) for s, t in ways for i in range(1 - len(s), len(t)) if (w := t[max(0, i) : i + len(s)]))
        assert partial_ratio(a, b) == pytest.approx(best)


def test_scores_as_a_column_and_own_scorer(spark):
    df = spark.createDataFrame([("ab", "ab"), (None, "x")], "a string, b string")
    got = df.select(score_pairs({"r": ("ratio", F.col("a"), F.col("b")), "same": (lambda x, y: float(x == y), F.col("a"), F.col("b"))}).alias("s")).select("s.*").collect()
    assert [tuple(r) for r in got] == [(100.0, 1.0), (0.0, 0.0)]
    sizes = spark.createDataFrame([(0, 0), (3, 6)], "a int, b int").select(safe_ratio(F.col("a"), F.col("b")).alias("r")).collect()
    assert [r["r"] for r in sizes] == [0.0, 0.5]
