"""Normalization of names and addresses as Column functions.

Everything runs in the JVM but `romanize`, which an Arrow UDF does for the texts
that aren't ASCII; Spark has no Unicode decomposition. Null counts as "".
"""

from __future__ import annotations

import unicodedata
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from lodestone.functions.lookups import CYRILLIC, GREEK, LATIN, LEGAL_SUFFIX, ORDINAL_ENDS, STATE_MAP, STOP_TOKENS, STREET_ABBR

_ALPHABETS = {**CYRILLIC, **GREEK, **LATIN}


def _text(c: Column | str) -> Column:
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(""))


def is_ascii(c: Column | str) -> Column:
    return _text(c).rlike("^[\\x00-\\x7F]*$")


@lru_cache(maxsize=20_000)
def _roman_letter(c: str) -> str:
    """Latin letters for one decomposed character, from a table of its alphabet or from its Unicode name."""
    if c.isascii():
        return c
    low = c.lower()
    if low in _ALPHABETS:
        return _ALPHABETS[low]
    name = unicodedata.name(c, "")
    if name.endswith("ANUSVARA"):
        return "n"
    if " DIGIT " in name:
        return str(unicodedata.digit(c, "")) if unicodedata.digit(c, None) is not None else ""
    if " LETTER " not in name and " VOWEL SIGN " not in name:
        return " " if not c.isalnum() and unicodedata.category(c)[0] in "PSZ" else ""
    sound = name.split()[-1].lower()
    if " LETTER " in name and len(sound) > 1 and sound[-1] == "a" and sound[-2] not in "aeiou":
        sound = sound[:-1]  # a consonant with its inherent vowel
    if len(sound) > 1 and sound[0] == sound[1]:
        sound = sound[1:]
    return "s" + sound[2:] if sound.startswith("sh") else sound


def romanize_text(s: str) -> str:
    """Compatibility decomposition, combining marks dropped, what isn't ASCII then written in Latin letters."""
    if s.isascii():
        return s
    s = "".join(c for c in unicodedata.normalize("NFKD", s) if not unicodedata.combining(c))
    return s if s.isascii() else "".join(map(_roman_letter, s))


@F.pandas_udf(StringType())
def _romanize(s: pd.Series) -> pd.Series:
    return s.map(lambda x: x if x is None else romanize_text(x))


def strip_marks(c: Column | str) -> Column:
    """Without combining marks, after compatibility decomposition."""

    @F.pandas_udf(StringType())
    def strip(s: pd.Series) -> pd.Series:
        return s.map(lambda x: x if x is None or x.isascii() else "".join(k for k in unicodedata.normalize("NFKD", x) if not unicodedata.combining(k)))

    return strip(_text(c))


def romanize(c: Column | str) -> Column:
    return _romanize(_text(c))


def strip_punctuation(c: Column | str) -> Column:
    """Everything but letters, digits, underscore and blanks becomes a blank."""
    return F.regexp_replace(_text(c), r"[^\w\s]", " ")


def collapse_blanks(c: Column | str) -> Column:
    return F.trim(F.regexp_replace(_text(c), r"\s+", " "))


def fold_ascii(c: Column | str) -> Column:
    """Lower case, punctuation to blanks, blanks collapsed, of a text that is ASCII already."""
    return collapse_blanks(strip_punctuation(F.lower(_text(c))))


def fold(c: Column | str) -> Column:
    return fold_ascii(romanize(c))


def tokens(c: Column) -> Column:
    return F.filter(F.split(c, " "), lambda x: x != "")


def drop_stop_tokens(a: Column) -> Column:
    return F.filter(a, lambda x: ~x.isin(STOP_TOKENS))


def drop_long_numbers(a: Column) -> Column:
    """Without tokens of seven digits or more, which are telephone numbers."""
    return F.filter(a, lambda x: ~x.rlike(r"^\d{7,}$"))


def strip_ordinals(a: Column) -> Column:
    return F.transform(a, lambda x: F.regexp_replace(x, rf"^(\d+)(?:{'|'.join(ORDINAL_ENDS)})$", "$1"))


def split_alnum(a: Column) -> Column:
    """Tokens cut where digits and other characters meet."""
    return F.flatten(F.transform(a, lambda x: F.regexp_extract_all(x, F.lit(r"(\d+|\D+)"), F.lit(1))))


def strip_zeros(a: Column) -> Column:
    return F.transform(a, lambda x: F.regexp_replace(x, r"^0+(?=\d+$)", ""))


def replace_tokens(a: Column, mapping: dict[str, str]) -> Column:
    table = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    return F.transform(a, lambda x: F.coalesce(F.try_element_at(table, x), x))


def canon_tokens(folded: Column, mapping: dict[str, str], drop_stop: bool = True) -> Column:
    """Canonical tokens of a folded text: stop tokens, telephone numbers, ordinals and leading zeros go, known words get one spelling."""
    a = tokens(folded)
    a = drop_stop_tokens(a) if drop_stop else a
    a = strip_zeros(split_alnum(strip_ordinals(drop_long_numbers(a))))
    return replace_tokens(replace_tokens(a, mapping), STATE_MAP)


def canon_name(folded: Column) -> Column:
    return F.array_join(canon_tokens(folded, LEGAL_SUFFIX, drop_stop=False), " ")


def canon_address(folded: Column) -> Column:
    return F.array_join(canon_tokens(folded, STREET_ABBR), " ")


def skeleton(c: Column | str) -> Column:
    """Without blanks and vowels, so that transliterations agree."""
    return F.regexp_replace(_text(c), "[aeiou ]", "")


def digit_set(address: Column | str) -> Column:
    """The distinct numbers of a canonical address, sorted as text."""
    return F.array_join(F.array_sort(F.array_distinct(F.filter(tokens(_text(address)), lambda x: x.rlike(r"^\d+$")))), " ")


def blob(name: Column | str, address: Column | str) -> Column:
    """Name, a blank and address; the blank stays if one is empty."""
    return F.concat(_text(name), F.lit(" "), _text(address))


def char_length(c: Column | str) -> Column:
    return F.length(_text(c))


def has_prefix(c: Column, *prefixes: str) -> Column:
    out = F.lit(False)
    for p in prefixes:
        out = out | F.startswith(c, F.lit(p))
    return out


def split_ids(c: Column | str) -> Column:
    """The ids of a comma list without empty ones."""
    return F.filter(F.split(_text(c), ","), lambda x: x != "")


def header_names(c: Column | str) -> Column:
    """Column names of a header line: trimmed and in lower case."""
    return F.transform(F.split(_text(c), "\t"), lambda x: F.lower(F.trim(x)))


def char_grams(text: Column | str, low: int = 4, high: int = 5) -> Column:
    """Character n-grams within words, each padded by one blank; a padded word no longer than `low` is one gram."""
    words = F.transform(F.filter(F.split(_text(text), r"\s+"), lambda w: w != ""), lambda w: F.concat(F.lit(" "), w, F.lit(" ")))

    def windows(w: Column, n: Column, k: int) -> Column:
        return F.transform(F.sequence(F.lit(1), F.greatest(n - (k - 1), F.lit(1))), lambda i: F.substring(w, i, F.lit(k)))

    def grams(w: Column) -> Column:
        n = F.length(w)
        each = [F.when(n >= k, windows(w, n, k)).otherwise(F.array().cast("array<string>")) for k in range(low, high + 1)]
        return F.when(n < low, F.array(w)).otherwise(F.concat(*each))

    return F.flatten(F.transform(words, grams))


def normalize_record(name: Column | str, address: Column | str) -> tuple[Column, Column]:
    """The folded name and address; canonical forms, skeleton and numbers follow from them (see normalize_records)."""
    return fold(name), fold(address)


def normalize_records(df, name: str, address: str):
    """df with name_norm, addr_norm, skel and digits.

    A null or empty name or address gives empty strings. Columns of these names
    are replaced.
    """
    n, a = normalize_record(name, address)
    folded = df.withColumns({"_fn": n, "_fa": a})
    canon = folded.withColumns({"name_norm": canon_name(F.col("_fn")), "addr_norm": canon_address(F.col("_fa"))}).drop("_fn", "_fa")
    return canon.withColumns({"skel": skeleton("name_norm"), "digits": digit_set("addr_norm")})
