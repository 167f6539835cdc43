import random
from itertools import permutations

from lodestone.llm.places import assign, hungarian, match_addresses


def test_two_edits_in_the_street_and_a_misspelt_town(spark):
    left = spark.createDataFrame([("a", "86 Nimosoba Street, Glanukinville, New York 10017"), ("b", "97 Lomumomex Street, Shoforor City")], "l string, address string")
    right = spark.createDataFrame([("x", "86 Nimooba Street , Glanukinille , N.Y."), ("y", "97 Lomummex Street,GA,Soforor City")], "r string, address string")
    got = {(r["l"], r["r"]) for r in match_addresses(left, right, "l", "r", "address").collect()}
    assert got == {("a", "x"), ("b", "y")}


def test_assignment_is_the_best_at_every_size():
    rng = random.Random(1)
    for _ in range(30):
        like = [[rng.choice([0.0, rng.random()]) for _ in range(6)] for _ in range(rng.randrange(1, 7))]
        best = max(sum(like[i][j] for i, j in enumerate(p)) for p in permutations(range(6), len(like)))
        assert abs(sum(like[i][j] for i, j in enumerate(hungarian(like))) - best) < 1e-9
    a = ["abcdefghij", "abcdefghik", "u1", "u2", "u3", "u4"]
    b = ["abcdefghik", "abcdefghix", "v1", "v2", "v3", "v4"]
    assert len(assign(a, b)[1]) >= 2
