import random

import pytest

from lodestone.llm.leaks import ItemIndex

ITEM = [f"w{i}" for i in range(60)]


def _found(words, item):
    return ItemIndex([1], [" ".join(item)]).search([" ".join(["x"] * 20 + words + ["y"] * 20)])


@pytest.mark.parametrize(
    "length, changed, put_in",
    [(40, range(18, 22), 0), (50, range(22, 27), 0), (40, (), 4), (30, (2, 3, 4), 0), (30, (), 3), (120, range(40, 52), 0)],
)
def test_stretch_with_changes_at_the_full_rate(length, changed, put_in):
    item = [f"w{i}" for i in range(length)]
    words = [f"z{i}" if i in set(changed) else w for i, w in enumerate(item)]
    words[length // 2 : length // 2] = ["z"] * put_in
    assert _found(words, item) == [(0, 0, length)]


def test_random_changes_at_the_full_rate():
    rng = random.Random(1)
    for n in (30, 40, 50, 59):
        for _ in range(50):
            hit = set(rng.sample(range(1, n - 1), n // 10))
            assert _found([f"z{i}" if i in hit else w for i, w in enumerate(ITEM[:n])], ITEM[:n]) == [(0, 0, n)]


def test_too_many_changes_or_too_short():
    assert _found(ITEM[:29], ITEM) == []
    assert _found([f"z{i}" if i in (7, 15, 16, 24) else w for i, w in enumerate(ITEM[:33])], ITEM) == []


def test_long_and_nested_notes_do_not_count():
    note = "(" + "noise [and (more) noise] " * 40 + ")"
    assert _found(ITEM[:20] + [note] + ITEM[20:40], ITEM) == [(0, 0, 40)]


def test_the_longest_stretch_is_reported():
    assert _found(ITEM[:30] + ["q"] * 60 + ITEM, ITEM) == [(0, 0, 60)]
