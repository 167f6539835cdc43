import random

from lodestone.llm import records


def test_words_of_other_letters_are_told_apart_without_a_comparison(monkeypatch):
    tried = []
    few = records._few_changes
    monkeypatch.setattr(records, "_few_changes", lambda *x: tried.append(x) or few(*x))
    assert not records.near("nemosoba", "glartuki", 2) and not tried
    rng = random.Random(1)
    words = ["".join(rng.choice("abñ") for _ in range(rng.randrange(8))) for _ in range(60)]
    for a in words:
        for b in words:
            for k in (1, 2):
                assert records.near(a, b, k) == (records.distance(a, b) <= k)


def test_numbers_lose_leading_zeros():
    assert [records._number(n) for n in ("007", "0", "000", "12 bis", "a-03", "010/02")] == ["7", "0", "0", "12", "a3", "10/2"]
