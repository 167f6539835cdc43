"""No problem of TESTDATA.md is left out silently."""

import re
from pathlib import Path


def test_every_problem_has_a_query_or_is_open():
    import __spark_entry__ as e

    served = {int(m[1]) for name in e.queries() if (m := re.match(r"p(\d+)_", name))}
    text = (Path(__file__).resolve().parents[2] / "README.md").read_text()
    named_open = {int(n) for n in re.findall(r"^\* \*\*Problem (\d+)\*\*", text, re.M)}
    assert served | named_open == set(range(1, 11))
    assert not served & named_open
