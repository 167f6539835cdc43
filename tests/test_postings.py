import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lodestone.functions.text import char_grams
from lodestone.operators import postings, retrieval
from tests.test_retrieval import SCHEMA, _grams

TEXTS = ["acme tools", "", "  a bb ccc  dddd eeeee ", "aaaa aaaa aaaaaaa", "straße 12", "x", "abरा", "東京 株式会社", "🙂🙂🙂🙂 z"]


def test_cut_as_char_grams(spark):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "i int, t string")
    want = {r["i"]: sorted(r["g"]) for r in rows.select("i", char_grams(F.col("t")).alias("g")).collect()}
    for texts in (TEXTS, TEXTS[:7]):
        row, index, grams = postings.cut(pa.array(texts))
        got = {i: [] for i in range(len(texts))}
        for r, k in zip(row, index):
            got[r].append(grams[int(k)].as_py())
        assert {i: sorted(g) for i, g in got.items()} == {i: want[i] for i in range(len(texts))}


def test_pack_and_unpack():
    grams, counts = pa.array([" ab", "b c", "cde "]), [3, 1, 12]
    (row,) = postings.pack(grams, pa.array(counts).to_numpy())
    back, n = postings.unpack(pa.array([row[0]]), pa.array([row[1]]))
    assert dict(zip(back.to_pylist(), n.tolist())) == dict(zip(grams.to_pylist(), counts))


@pytest.mark.parametrize("hits", [5, 1 << 20])
def test_shards_blocks_and_keys_in_several_partitions(spark, monkeypatch, hits):
    """Small shards and blocks give the same lists, and a key in two partitions keeps its best over both."""
    refs = [(f"r{i:03}", f"store {i % 7} north{i % 11} lane{i}", "X" if i % 3 else "Y") for i in range(120)]
    asked = [(f"q{i}", f"store {i} north{i % 11} lane{i}", "X") for i in range(30)] + [("q1", "store north4 lane3", "Y"), ("q2", "extra words", "X")]
    monkeypatch.setattr(retrieval, "HITS", hits)
    q, r = spark.createDataFrame(asked, SCHEMA), spark.createDataFrame(refs, SCHEMA)
    got = {(x["q"], x["r"]): x["cos_name"] for x in retrieval.retrieve(q, r, "part", "id", "id", {"name": (F.col("name"), 5)}, 0.5).collect()}
    want, best = {}, {}
    for p in ("X", "Y"):
        mine = [t for t in refs if t[2] == p]
        docs = {i: _grams(t) for i, t, _ in mine}
        texts = {}
        for i, t, part in asked:
            if part == p:
                texts[i] = f"{texts.get(i, '')} {t}"
        df = {g: sum(g in d for d in docs.values()) for d in docs.values() for g in d}
        unit = lambda c: _unit(c, df, len(mine))
        index = {i: unit(c) for i, c in docs.items()}
        for i, t in texts.items():
            x = unit(_grams(t))
            for j, y in index.items():
                if s := sum(v * y.get(g, 0) for g, v in x.items()):
                    best.setdefault(i, []).append((-round(s, 6), j))
    for i, hits_of in best.items():
        want |= {(i, j): -s for s, j in sorted(hits_of)[:5]}
    assert got == want and len(want) > 100


def _unit(c, df, n):
    import math

    w = {g: math.log1p(k) * (math.log((1 + n) / (1 + df.get(g, 0))) + 1) for g, k in c.items() if not df.get(g, 0) > 0.5 * n}
    norm = math.sqrt(sum(x * x for x in w.values()))
    return {g: x / norm for g, x in w.items()}
