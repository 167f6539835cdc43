import random

from lodestone.llm.places import alike, word_links


def _words(seed, n):
    rng = random.Random(seed)
    return sorted({"".join(rng.choice("abcd") for _ in range(rng.randrange(2, 12))) for _ in range(n)} | {"nimosoba"[:k] for k in range(4, 9)})


def test_all_words_that_are_alike_and_no_strings_in_vain(spark):
    left, right = _words(1, 80), [*_words(2, 80), "nimoba", "ñimosoba"]
    frames = [spark.createDataFrame([(w,) for w in words], "w string") for words in (left, right)]
    links = word_links(*frames)
    got = [tuple(r) for r in links.collect()]
    assert len(got) == len(set(got))
    assert set(got) == {(a, b) for a in left for b in right if alike(a, b) > 0 and (a == b or max(len(a), len(b)) > 3)}
    # deletion strings are made and filtered in the tasks, not exploded and written
    assert "Generate" not in links._jdf.queryExecution().optimizedPlan().toString()
