import math
from collections import Counter

from pyspark.sql import functions as F

from lodestone.operators import learning, metrics, pairs
from lodestone.operators.retrieval import document_frequency, retrieve, term_counts

REFS = [("r1", "acme tools", "X"), ("r2", "acme toolz", "X"), ("r3", "bakery north", "X"), ("r4", "bakery", "Y"), ("r5", "", "X"), ("r6", None, "X")]
QUERIES = [("q1", "acme tool", "X"), ("q2", "bakery", "X"), ("q3", None, "X"), ("q4", "acme", None), ("q5", "unseen", "X")]
SCHEMA = "id string, name string, part string"


def _grams(t):
    out = []
    for w in (t or "").split():
        w = f" {w} "
        out += [w] if len(w) < 4 else [w[i : i + n] for n in (4, 5) for i in range(len(w) - n + 1)]
    return Counter(out)


def _brute(max_df):
    hits = {}
    for part in ("X", "Y"):
        refs = {i: _grams(t) for i, t, p in REFS if p == part}
        n, df = len(refs), Counter(g for c in refs.values() for g in c)
        idf = lambda g: math.log((1 + n) / (1 + df[g])) + 1

        def unit(c):
            w = {g: math.log1p(k) * idf(g) for g, k in c.items() if not df[g] > max_df * n}
            norm = math.sqrt(sum(x * x for x in w.values()))
            return {g: x / norm for g, x in w.items()}

        index = {i: unit(c) for i, c in refs.items()}
        for i, t, p in QUERIES:
            if p == part:
                q = unit(_grams(t))
                for j, r in index.items():
                    if s := sum(x * r.get(g, 0) for g, x in q.items()):
                        hits[i, j] = round(s, 6)
    return hits


def test_retrieval_against_brute_force(spark):
    q, r = spark.createDataFrame(QUERIES, SCHEMA), spark.createDataFrame(REFS, SCHEMA)
    got = {(x["q"], x["r"]): x["cos_name"] for x in retrieve(q, r, "part", "id", "id", {"name": (F.col("name"), 5)}, 0.5).collect()}
    assert got == _brute(0.5) and got
    assert retrieve(q, r, "part", "id", "id", {"name": (F.col("name"), 5)}).count() == 0  # under 100 references every gram is pruned
    assert retrieve(q.limit(0), r, "part", "id", "id", {"name": (F.col("name"), 5)}, 0.5).count() == 0


def test_equal_cosines_are_ordered_by_reference(spark):
    r = spark.createDataFrame([(f"r{i}", "same name", "X") for i in range(5)] + [(f"z{i}", f"word{i}", "X") for i in range(20)], SCHEMA)
    q = spark.createDataFrame([("q", "same name", "X")], SCHEMA)
    got = retrieve(q, r, "part", "id", "id", {"name": (F.col("name"), 3)}, 0.5).collect()
    assert sorted(x["r"] for x in got) == ["r0", "r1", "r2"]


def test_pruning_and_idf(spark):
    for n, pruned in ((99, True), (100, False)):
        rows = spark.createDataFrame([("r0", "zzzz", "X")] + [(f"r{i}", "", "X") for i in range(1, n)], SCHEMA)
        f = document_frequency(term_counts(rows, "part", "id", {"name": F.col("name")}), rows, "part")
        assert {x["pruned"] for x in f.collect()} == {pruned}
    rows = spark.createDataFrame([("a", "zz", "X"), ("b", "", "X"), ("c", "", "X")], SCHEMA)
    f = document_frequency(term_counts(rows, "part", "id", {"name": F.col("name")}), rows, "part").first()
    assert round(f["idf"], 6) == 1.693147


def test_margin_rule_and_lists(spark):
    p = spark.createDataFrame([("a", "x", 0.9), ("a", "y", 0.8), ("a", "z", 0.5), ("b", "x", 0.2)], "q string, r string, p double")
    kept = pairs.decide(p, "p", 0.6, 0.15)
    assert sorted(x["p"] for x in kept.collect()) == [0.8, 0.9]
    lists = {x["q"]: x["ids"] for x in pairs.id_lists(kept, p, [-F.col("p"), F.col("r")]).collect()}
    assert lists == {"a": ["x", "y"], "b": []}


def test_scores(spark):
    both = lambda rows: spark.createDataFrame(rows, "q string, ids array<string>")
    truth = both([("a", []), ("b", []), ("c", ["x", "y"]), ("d", ["x"])])
    got = metrics.macro_score(both([("b", ["x"]), ("c", ["x", "y", "z"]), ("d", ["z"])]), truth).first()["score"]
    assert round(got, 6) == round((1 + 0 + 1.25 * (2 / 3) / (0.25 * 2 / 3 + 1) + 0) / 4, 6)
    assert round(1.25 * (2 / 3) / (0.25 * 2 / 3 + 1), 3) == 0.714


def test_features_rerank_and_classifier(spark):
    cols = "key string, name_norm string, addr_norm string, skel string, digits string, src int"
    left = spark.createDataFrame([(f"q{i}", f"name{i}", "1 st", f"nm{i}", "1", 1) for i in range(30)], cols)
    right = spark.createDataFrame([(f"r{i}", f"name{i}", "" if i % 3 else "1 st", f"nm{i}", "", 2 + i % 2) for i in range(30)], cols)
    cand = spark.createDataFrame([(f"q{i}", f"r{j}", 0.9 if i == j else 0.1, 0.0, 0.5) for i in range(30) for j in range(i, min(30, i + 4))], "q string, r string, cos_blob double, cos_addr double, cos_name double")
    f = pairs.pair_labels(pairs.pair_features(cand, left, right), spark.createDataFrame([(f"q{i}", f"r{i}") for i in range(30)], "q string, r string")).cache()
    assert f.columns == ["q", "r", *pairs.FEATURES, "label"]
    row = f.where("q = 'q0' and r = 'r0'").first()
    assert (row["cos_rank"], row["n_cands"], row["n_idx_hit"], row["name_ratio"], row["label"]) == (0, 4, 2, 100, 1)
    assert pairs.rerank(cand, left, right, 2).groupBy("q").count().where("count > 2").count() == 0
    marked = f.withColumn("is_holdout", learning.is_holdout(F.col("q")))
    model = learning.fit_classifier(learning.downsample_negatives(marked), pairs.FEATURES, rounds=3, least=1)
    assert learning.score_pairs_with(model, marked, pairs.FEATURES).count() == cand.count()
