import pytest

from lodestone.llm.lookalike import Rewriter, normalize_lookalikes

CASES = {"Ａcme": "Acme", "Acmе": "Acme", "ét": "ét", "a​b": "ab", "a b": "a b", "①": "1", "㎎": "mg", "Москва": "Москва", "été": "été", "": "", "９０": "90", "ﬁn": "fin"}


def test_values():
    r = Rewriter({})
    for s, plain in CASES.items():
        assert r(s) == plain, s
        assert r(r(s)) == r(s)
    assert r(None) is None and r("Ａ" * 50_000) == "A" * 50_000


def test_frame(spark):
    df = spark.createDataFrame([(1, "Ａcme"), (2, None), (3, ""), (1, "Ａcme")], "id int, name string")
    got = sorted((r["id"], r["name_plain"] or "") for r in normalize_lookalikes(df, ["name"]).collect())
    assert got == [(1, "Acme"), (1, "Acme"), (2, ""), (3, "")]
    assert normalize_lookalikes(df.limit(0), ["name"]).count() == 0
    with pytest.raises(ValueError):
        normalize_lookalikes(df.withColumn("name_plain", df.name), ["name"])
