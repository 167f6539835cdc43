import random

import pytest

from lodestone.llm.packing import Containers, count_tokens, pack_items, round_robin

SCHEMA = "id long, src string, n long"


def _packed(spark, rows, capacity=100, **more):
    return pack_items(spark.createDataFrame(rows, SCHEMA), "id", "src", "n", capacity, **more).collect()


def _check(rows, got, capacity):
    used: dict = {}
    for r in got:
        if r["container"] is None:
            assert r["size"] == 0
        else:
            used[r["container"]] = used.get(r["container"], 0) + r["size"]
    assert all(n <= capacity for n in used.values())
    assert sorted((r["id"], r["size"]) for r in got if r["size"] <= capacity and r["first_token"] == 0) and sum(r["size"] for r in got) == sum(max(n or 0, 0) for _, _, n in rows)
    return used


def test_nothing_is_lost_divided_or_overfull(spark):
    rng = random.Random(1)
    rows = [(i, rng.choice(["a", "a", "a", "b", "c"]), rng.choice([0, 1, 7, 30, 55, 99, 100, 101, 250, None])) for i in range(3000)]
    got = _packed(spark, rows, partition_windows=2, window_containers=8)
    used = _check(rows, got, 100)
    pieces = {}
    for r in got:
        pieces.setdefault(r["id"], []).append((r["piece"], r["first_token"], r["size"]))
    for i, _, n in rows:
        p = sorted(pieces[i])
        assert len(p) == max(1, -(-(n or 0) // 100)) and [x[1] for x in p] == [100 * k for k in range(len(p))]
    assert sum(used.values()) / (100 * len(used)) > 0.9


def test_sources_are_mixed_in_every_stretch(spark):
    rows = [(i, "big" if i % 3 else "small", 10) for i in range(6000)]
    got = _packed(spark, rows, partition_windows=2, window_containers=10)
    by_part: dict = {}
    for r in got:
        by_part.setdefault(r["container"] >> 24, []).append(r["source"])
    full = [s for p, s in sorted(by_part.items())][:-1]
    assert len(full) > 10 and all(abs(s.count("small") / len(s) - 1 / 3) < 0.05 for s in full)


def test_weights_hold_while_a_source_lasts(spark):
    rows = [(i, "a" if i < 1000 else "b", 10) for i in range(4000)]
    got = _packed(spark, rows, weights={"a": 1.0, "b": 1.0}, partition_windows=1, window_containers=20)
    first = [r["source"] for r in got if r["container"] >> 24 == 0]
    assert abs(first.count("a") / len(first) - 0.5) < 0.05
    _check(rows, got, 100)


def test_deficits_are_carried_across_windows():
    queues = {"a": [70] * 30, "b": [30] * 70}
    windows = list(round_robin(queues, {"a": 1.0, "b": 1.0}, {}, 300, 100))
    assert sum(map(len, windows)) == 100
    served = {"a": 0, "b": 0}
    for w in windows[:-2]:
        for s, p in w:
            served[s] += queues[s][p]
        assert abs(served["a"] - served["b"]) <= 170


def test_best_fit():
    c = Containers(10)
    assert [c.put(x) for x in (6, 7, 3, 4)] == [0, 1, 1, 0] and c.n == 2 and not c.open


def test_edges(spark):
    assert _packed(spark, []) == []
    assert [r["container"] for r in _packed(spark, [(1, None, None), (2, "a", 0)])] == [None, None]
    assert len(_packed(spark, [(1, None, 5), (1, None, 5)])) == 2
    with pytest.raises(ValueError):
        _packed(spark, [(1, "a", 1)], 0)
    df = spark.createDataFrame([("a", None), ("b", ""), ("c", "word " * 20_000)], "id string, text string")
    assert [r["n_tokens"] for r in count_tokens(df, "text").orderBy("id").collect()][:2] == [0, 0]
    assert count_tokens(df, "text").where("id = 'c'").first()["n_tokens"] >= 20_000
