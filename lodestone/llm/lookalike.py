"""One consistent form for text that looks alike but differs in its characters.

Look-alike pairs (of strings and of code points) come from rules over the
Unicode data and a short list of letters of other scripts. Union-find makes
them transitive, so that a full-width letter, a mathematical letter and a
Cyrillic letter that all look like the same Latin letter share a class. The
representative of a class is its member that is most frequent in the whole
table. Members that are mere variants are rewritten wherever they stand, in one
greedy leftmost-longest pass of a multi-pattern automaton; letters of another
script are rewritten only inside words that mix scripts.
"""

from __future__ import annotations

import sys
import unicodedata
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Letters of other scripts, each with the Latin letter it looks like.
CYRILLIC = {
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ј": "j", "ѕ": "s", "һ": "h", "ԁ": "d", "ԛ": "q", "ԝ": "w", "ѵ": "v", "ӏ": "l", "ү": "y", "г": "r",
    "А": "A", "В": "B", "Е": "E", "Н": "H", "К": "K", "М": "M", "О": "O", "Р": "P", "С": "C", "Т": "T", "У": "Y", "Х": "X", "І": "I", "Ј": "J", "Ѕ": "S", "Һ": "H", "Ԁ": "D", "Ԛ": "Q", "Ԝ": "W", "Ѵ": "V", "Ү": "Y", "З": "3",
    "к": "k", "ё": "ë", "Ё": "Ë", "ї": "ï", "Ї": "Ï",
}
GREEK = {
    "ο": "o", "ν": "v", "ρ": "p", "α": "a", "ι": "i", "υ": "u", "κ": "k", "χ": "x", "γ": "y", "τ": "t", "η": "n", "ω": "w", "ε": "e", "ϲ": "c", "ϳ": "j", "σ": "o",
    "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X", "Ϲ": "C", "Ϳ": "J",
}
ARMENIAN = {"օ": "o", "ս": "u", "հ": "h", "ո": "n", "ց": "g", "յ": "j", "Օ": "O", "Ս": "U", "Լ": "L"}
# Punctuation that looks like an ordinary mark.
PUNCTUATION = {
    "'": "‘’‚‛′ʼʹ`´", '"': "“”„‟″", "-": "‐‑‒–—―−", "/": "⁄∕", "*": "∗", ":": "∶", "~": "∼", ",": "‚",
}
PUNCTUATION["'"] = PUNCTUATION["'"].replace("‚", "").replace("`", "")

WORD = regex.compile(r"[\p{L}\p{M}]+")
SCRIPTS = {
    name: regex.compile(rf"\p{{Script={name}}}")
    for name in ("Latin", "Cyrillic", "Greek", "Armenian", "Devanagari", "Bengali", "Tamil", "Telugu", "Hebrew", "Arabic", "Georgian", "Cherokee", "Han", "Hiragana", "Katakana", "Hangul", "Thai")
}


class Classes:
    """Union-find over strings."""

    def __init__(self) -> None:
        self.parent: dict[str, str] = {}

    def find(self, s: str) -> str:
        root = s
        while self.parent.setdefault(root, root) != root:
            root = self.parent[root]
        while self.parent[s] != root:
            self.parent[s], s = root, self.parent[s]
        return root

    def union(self, a: str, b: str) -> None:
        a, b = self.find(a), self.find(b)
        if a != b:
            self.parent[max(a, b)] = min(a, b)

    def members(self) -> dict[str, list[str]]:
        out: dict[str, list[str]] = {}
        for s in sorted(self.parent):
            out.setdefault(self.find(s), []).append(s)
        return out


def invisible(c: str) -> bool:
    """Format and control characters, fillers and variation selectors: nothing is to be seen of them."""
    kind = unicodedata.category(c)
    return kind == "Cf" or (kind == "Cc" and c not in "\t\n\r") or c in "ᅟᅠㅤﾠ͏឴឵" or "︀" <= c <= "️" or "\U000e0100" <= c <= "\U000e01ef"


def ordinary(s: str) -> bool:
    """Whether s can stand for its class: composed, not a compatibility form, visible or empty."""
    return unicodedata.normalize("NFKC", s) == s and not any(invisible(c) for c in s)


@lru_cache(maxsize=1)
def lookalikes() -> tuple[Classes, frozenset[str]]:
    """All classes, and the letters of other scripts, which count only in mixed words."""
    classes, letters = Classes(), set()
    for code in range(1, sys.maxunicode + 1):
        if 0xD800 <= code <= 0xDFFF or 0xF900 <= code <= 0xFAFF or 0x2F800 <= code <= 0x2FA1F or 0xAC00 <= code <= 0xD7A3:
            continue
        c = chr(code)
        kind = unicodedata.category(c)
        if kind in ("Cn", "Co", "Lo") and not unicodedata.decomposition(c) and not invisible(c):
            continue
        if invisible(c):
            classes.union("", c)
        elif kind in ("Zs", "Zl", "Zp") and c != " ":
            classes.union(" ", c)
        elif kind == "Nd" and code > 127:
            classes.union(str(unicodedata.decimal(c)), c)
        else:
            plain = unicodedata.normalize("NFKC", c)
            # raised and lowered characters and fractions mean something else than the plain ones
            if plain != c and plain.strip() and not unicodedata.decomposition(c).startswith(("<super>", "<sub>", "<fraction>")):
                classes.union(plain, c)
            apart = unicodedata.normalize("NFD", c)
            if apart != c and unicodedata.normalize("NFC", c) == c:
                classes.union(c, apart)
                if len(apart) > 2:
                    classes.union(c, unicodedata.normalize("NFC", apart[:-1]) + apart[-1])
    for table in (CYRILLIC, GREEK, ARMENIAN):
        for c, latin in table.items():
            classes.union(latin, c)
            letters.add(c)
    for mark, others in PUNCTUATION.items():
        for c in others:
            classes.union(mark, c)
    return classes, frozenset(letters)


def script(c: str) -> str | None:
    if not c.isalpha():
        return None
    if c < "ɐ":
        return "Latin"
    return next((name for name, p in SCRIPTS.items() if p.match(c)), None)


class Rewriter:
    """Greedy rewriting to the representatives chosen from the counts of members."""

    def __init__(self, counts: dict[str, int]) -> None:
        import ahocorasick

        classes, letters = lookalikes()
        self.letters: dict[str, dict[str, str]] = {}  # look-alike letter: {script: letter of that script}
        always: dict[str, str] = {}
        for members in classes.members().values():
            if "" in members:
                always.update((m, "") for m in members if m)
                continue
            fit = [m for m in members if ordinary(m) and m not in letters] or [m for m in members if ordinary(m)]
            if not fit:
                continue
            best = min(fit, key=lambda m: (-counts.get(m, 0), len(m), m))
            by_script: dict[str, str] = {}
            for m in sorted((m for m in members if len(m) == 1 and ordinary(m) and script(m)), key=lambda m: (-counts.get(m, 0), m)):
                by_script.setdefault(script(m), m)
            for m in members:
                if m in letters or (len(m) == 1 and m == best and len(by_script) > 1):
                    self.letters[m] = by_script
                if m not in letters and m != best and not (ordinary(m) and len(m) == 1 and m.isalnum() and m.isascii()):
                    always[m] = best
        self.always = {m: r for m, r in always.items() if m != r}
        self.automaton = ahocorasick.Automaton()
        for m, r in self.always.items():
            self.automaton.add_word(m, (len(m), r))
        self.automaton.make_automaton()

    def _greedy(self, s: str) -> str:
        out, at = [], 0
        for end, (n, r) in self.automaton.iter_long(s):
            out += (s[at : end - n + 1], r)
            at = end + 1
        return "".join((*out, s[at:])) if out else s

    def _word(self, m: regex.Match) -> str:
        word = m[0]
        scripts = {x for c in word if (x := script(c))}
        if len(scripts) < 2:
            return word
        own = Counter(script(c) for c in word if c not in self.letters and script(c))
        if own:
            target = max(own, key=lambda x: (own[x], x == "Latin"))
        else:
            target = "Latin"
        return "".join(self.letters[c].get(target, c) if c in self.letters and script(c) != target else c for c in word)

    def __call__(self, s: str | None) -> str | None:
        if s is None or s.isascii() and not any(c < " " and c not in "\t\n\r" or c == "\x7f" for c in s):
            return s
        seen: set[str] = set()
        while s not in seen:  # a removed character can bring letter and accent together
            seen.add(s)
            s = unicodedata.normalize("NFC", WORD.sub(self._word, self._greedy(s)))
        return s


def member_counts(df: DataFrame, columns: list[str]) -> dict[str, int]:
    """How often each look-alike string stands in the columns, over all rows; its size is that of the fixed table."""
    classes, _ = lookalikes()
    single = np.array(sorted(ord(m) for m in classes.parent if len(m) == 1), dtype=np.uint32)
    longer: dict[str, list[str]] = {}
    for m in classes.parent:
        if len(m) > 1:
            longer.setdefault(m[-1], []).append(m)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for batch in batches:
            for column in batch.columns:
                text = "\n".join(x for x in column.to_pylist() if x)
                codes, n = np.unique(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32), return_counts=True)
                hit = np.isin(codes, single)
                for c, k in zip(codes[hit].tolist(), n[hit].tolist()):
                    total[chr(c)] += k
                if codes.size and codes[-1] > 127:
                    for c in map(chr, codes.tolist()):
                        if not c.isascii():
                            for m in longer.get(c, ()):
                                if k := text.count(m):
                                    total[m] += k
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], names=["member", "n"])

    rows = df.select(*[F.col(f"`{c}`").cast("string").alias(f"c{i}") for i, c in enumerate(columns)]).mapInArrow(count, "member string, n bigint").groupBy("member").agg(F.sum("n").alias("n")).collect()
    return {r["member"]: r["n"] for r in rows}


def normalize_lookalikes(df: DataFrame, columns: list[str], suffix: str = "_plain", counts: dict[str, int] | None = None) -> DataFrame:
    """df with the consistent form of each of `columns`, in a new column of that name with suffix.

    Compatibility forms, decomposed accents, odd blanks, digits and marks become
    the ordinary ones, invisible characters vanish, and in words that mix scripts
    look-alike letters become those of the script that the word's other letters
    have. Accented letters and words wholly in another script stay. A null stays
    null, an empty text empty; texts of any length are processed whole. Repeated
    rows stay repeated, an empty frame stays empty. A new name that df already
    has raises ValueError.
    """
    new = [c + suffix for c in columns]
    if clash := {c.lower() for c in df.columns} & {c.lower() for c in new}:
        raise ValueError(f"df already has {sorted(clash)}")
    counts = member_counts(df, columns) if counts is None else counts

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rewriter = None
        for batch in batches:
            rewriter = rewriter or Rewriter(counts)
            plain = [pa.array([rewriter(x) for x in batch.column(c).to_pylist()], pa.string()) for c in columns]
            yield pa.RecordBatch.from_arrays([*batch.columns, *plain], names=[*batch.schema.names, *new])

    schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields], *[f"`{c}` string" for c in new]])
    return df.mapInArrow(rewrite, schema)
