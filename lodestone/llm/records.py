"""Reading noisy business names and postal addresses into comparable parts.

Everything here is per value and pure, so it runs in any task; the only thing
learned from the data is the vocabulary of frequent name words, whose size is
bounded because a word enters it only above a share of all records.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.llm.lookalike import Rewriter

# Legal forms, prefixes and remarks that say nothing about which business it is.
LEGAL = frozenset("co company llp ltd limited inc incorporated llc corp corporation private pvt sarl sa sas eurl ag kg gmbh ek mbh gesellschaft mit beschraenkter haftung ohg ug plc lp pte".split())
REMARKS = frozenset("the sri m s ms messrs ets ste firma fa regd closed branch prop proprietor dba trading as d b a and et und y of de du des la le les l am zur zum der die das en formerly fka t p c o e k u r g h n".split())
# Abbreviated and translated words of names.
WORDS = {
    "assoc": "associates", "assocs": "associates", "associes": "associates", "asoc": "associates", "bros": "brothers", "bro": "brothers", "freres": "brothers", "gebruder": "brothers", "ptnrs": "partners",
    "engg": "engineering", "engrg": "engineering", "constns": "constructions", "svcs": "services", "svc": "services", "service": "services", "agcs": "agencies", "agency": "agencies", "tpts": "transports", "tpt": "transport",
    "trans": "transport", "manuf": "manufacturing", "mfg": "manufacturing", "rpr": "repair", "grp": "group", "wks": "works", "mgmt": "management", "mgt": "management", "technology": "technologies",
    "cnslt": "consulting", "consultg": "consulting", "ctr": "center", "centre": "center", "elex": "elec", "electronic": "electronics", "inds": "industries", "entps": "enterprises", "enterprise": "enterprises",
    "trdrs": "traders", "tradrs": "traders", "gle": "gen", "automobile": "auto", "st": "street", "saint": "street", "maschinenb": "maschinenbau", "elektrotechn": "elektrotechnik",
    "end": "and", "elelpi": "llp", "praivet": "private", "ko": "co", "brdrs": "brothers", "svits": "sweets", "medikls": "medicals", "sns": "sons", "injiniyring": "engineering", "vrks": "works",
    "tekstails": "textiles", "indstrij": "industries", "hospitl": "hospital", "stors": "stores", "motrs": "motors", "tredrs": "traders", "ejensij": "agencies", "stil": "steel", "srvisej": "services",
    "entrpraijej": "enterprises",
}
# Short forms that begin several words; they agree with any word that begins so.
BEGINNINGS = frozenset("const constr med pharm elec immo gen tech hosp masch ins ind ent eng sec".split())
# Short forms of given names.
GIVEN = {
    "robert": "rob bob", "katherine": "kate kathy", "james": "jim jamie", "margaret": "peggy maggie", "anthony": "tony ant", "susannah": "susie sue", "edward": "ed ned ted", "joseph": "joe jo", "frederick": "freddy fred",
    "theodore": "theo ted", "elizabeth": "beth liz", "william": "bill will", "richard": "rick dick", "alexander": "alex sandy", "michael": "mike mick", "lakshmi": "laxmi luxmi", "chaudhari": "chowdhury choudhary",
    "mohammad": "mohd md", "balakrishnan": "bala balu", "venkateswara": "venkat venky", "krishnamurthy": "krishna kittu", "subramaniam": "subbu mani", "rajendra": "rajender raju", "frederic": "fredo fred",
    "genevieve": "ginou viviane", "elisabeth": "lise babette", "benoit": "benoist ben", "alexandre": "sacha alex", "baptiste": "jb", "sebastian": "seb basti", "friedrich": "fritz fried", "joachim": "jochen achim jo",
    "johannes": "hans hannes jo", "gunther": "gunter guenther", "katharina": "kathe katja",
}
_ALL_SHORT = [s for shorts in GIVEN.values() for s in shorts.split()]
SHORT_GIVEN = {s: full for full, shorts in GIVEN.items() for s in shorts.split() if _ALL_SHORT.count(s) == 1}
# Latin letters for Devanagari, Cyrillic and Greek ones. A consonant's inherent vowel isn't written.
DEVANAGARI = dict(zip("कखगघङचछजझञटठडढणतथदधनपफबभमयरलवशषसहळ", "k kh g gh n ch chh j jh n t th d dh n t th d dh n p f b bh m y r l v sh sh s h l".split())) | dict(
    zip("अआइईउऊएऐओऔािीुूेैोौॉऑंँः", "a a i i u u e ai o au a i i u u e ai o au o o n n h".split())
)
CYRILLIC = dict(zip("абвгдежзийклмнопрстуфхцчшщыэюя", "a b v g d e x z i j k l m n o p r s t u f h c ch sh sh y e yu ya".split()))
GREEK = dict(zip("αβγδεζηθικλμνξοπρστυφχψω", "a b g d e z i th i k l m n x o p r s t u f h ps w".split())) | {"ς": "s"}
ROMAN = {ord(k): v for t in (DEVANAGARI, CYRILLIC, GREEK) for k, v in t.items()} | {0x94D: "", 0x93C: ""}
_MARKS = re.compile("[̀-ͯ]+")
_ALIEN = re.compile("[Ͱ-ӿऀ-ॿ]")
_DEVA = re.compile("[ऀ-ॿ]")
_rewriter: Rewriter | None = None


_JOINED = re.compile(r"(?<=[a-z]{3})(?=[A-Z][a-z]{2})")


def fold(s: str | None) -> str:
    """Lower case Latin text without accents or look-alike characters; case of joined words is kept apart by a blank."""
    global _rewriter
    if not s:
        return ""
    if not s.isascii():
        _rewriter = _rewriter or Rewriter({})
        s = _rewriter(s).replace("ß", "ss").replace("°", " ")
    s = _JOINED.sub(" ", s).lower()
    if not s.isascii():
        s = _MARKS.sub("", unicodedata.normalize("NFD", s))
        if _ALIEN.search(s):
            s = unicodedata.normalize("NFC", s).translate(ROMAN)
    return s


_SOUNDS = str.maketrans("cqwvyziu", "kkbbejeo")


@lru_cache(maxsize=200_000)
def sound(w: str) -> str:
    """A word as it sounds, so that spellings and transliterations of one word agree."""
    w = w.replace("ph", "f").replace("ck", "k").translate(_SOUNDS).replace("ks", "x")
    return re.sub(r"(.)\1+", r"\1", w)


_ALIAS = re.compile(r"^.*?\b(?:d/?b/?a|trading as|t/a)\b\s*")
_DOTS = re.compile(r"(?<=\b[a-z])\.(?=[a-z]\b)")
_REMARK = re.compile(r"\[[^\]]*\]|\*")
_PLTD = re.compile(r"\(p\)")
_LETTERS = re.compile(r"[^\W\d_]+")


def name_words(name: str | None) -> list[str]:
    """Words of a name: folded, legal forms and remarks dropped, abbreviations and short given names written out."""
    s = fold(name)
    if not s:
        return []
    deva = name is not None and _DEVA.search(name) is not None
    s = _REMARK.sub(" ", _PLTD.sub(" ", s))
    if alias := _ALIAS.match(s):
        s = s[alias.end() :]
    s = _DOTS.sub("", s).replace(".", " ").replace("'", "")
    out = []
    for w in _LETTERS.findall(s):
        w = WORDS.get(w, w)
        w = SHORT_GIVEN.get(w, w)
        if w in LEGAL or w in REMARKS or len(w) < 2:
            continue
        out.append(("~" if deva else "") + w)
    return out


# ---------------------------------------------------------------- addresses
# Kinds of streets; English and Indian ones follow the name, French ones precede it, German ones end it.
STREET_AFTER = frozenset("street st str saint avenue ave av road rd raod drive dr lane ln court ct place pl boulevard blvd boul bd highway hwy hiway terrace terr ter nagar ngr nagr marg mg layout lyt lay colony col cly cross crs x main mn way parkway square sq strasse weg platz gasse ring".split())
STREET_BEFORE = frozenset("rue r chemin ch che allee all avenue ave av boulevard bd boul place pl impasse imp quai cours des du de la".split())
STREET_GERMAN = ("strasse", "str", "weg", "platz", "pl", "gasse", "g", "allee", "all", "ring", "w")
# Words of addresses that are no names of streets or towns.
GENERAL = frozenset(
    "city falls sur orle en brume le vieux les bains near nr behind opp opposite across from next to beside face a la pres de derriere gegenuber dem neben hinter nahe vor water tank tower govt gvt school grain silo exit fire station old mill poste bahnhof "
    "null na nan none n no nos h hno house out road lay out sector phase ward unit ste suite apt appt flat office shop door lot bat batiment whg og plot ph tel mob phone bis stage block po box "
    "ohio illinois oregon texas virginia washington georgia florida carolina north south new york uttar pradesh tamil nadu tamilnadu gujarat gujrat bengal west karnataka krnataka rajasthan rajsthan kerala kerela maharashtra maharastra "
    "oh il ore or tx tex va wa ga fl fla nc ny up tn gj wb ka rj kl mh w u p y b c g ill wash".split()
)
STATES = {
    "ohio": "oh", "illinois": "il", "oregon": "or", "ore": "or", "texas": "tx", "tex": "tx", "virginia": "va", "washington": "wa", "georgia": "ga", "florida": "fl", "fla": "fl", "carolina": "nc", "york": "ny", "pradesh": "up",
    "nadu": "tn", "tamilnadu": "tn", "gujarat": "gj", "gujrat": "gj", "bengal": "wb", "karnataka": "ka", "krnataka": "ka", "rajasthan": "rj", "rajsthan": "rj", "kerala": "kl", "kerela": "kl", "maharashtra": "mh", "maharastra": "mh",
    "oh": "oh", "il": "il", "or": "or", "tx": "tx", "va": "va", "wa": "wa", "ga": "ga", "fl": "fl", "nc": "nc", "ny": "ny", "up": "up", "tn": "tn", "gj": "gj", "wb": "wb", "ka": "ka", "rj": "rj", "kl": "kl", "mh": "mh",
}

_PHONE = re.compile(r"\b(?:ph|tel|mob|phone|mobile|fon|telefon)\b[.:]?\s*\+?[\d(][\d\s()/-]{5,}")
_HAS_PHONE = re.compile("ph|tel|mob|fon")
_LANDMARK = re.compile(
    r"(?:\bb/h\b|\b(?:near|nr|nahe|behind|opp|opposite|across from|next to|beside|en face de|derriere|face a|pres de|gegenuber|neben|hinter|vor)\b)\.?\s*(?:(?:la|le|the|dem|der)\s+)?(?:exit\s+\d+|(?:water|grain|govt|fire|old)\s+[a-z]+|[a-z]*poste|bahnhof|[a-z]+)"
)
_AREA = re.compile(r"\b(?:sector|phase|ward\s*(?:no|nr)?|stage)\b\.?\s*\d+")
_FLOOR = re.compile(r"\b\d+\s*\.?\s*og\b")
_UNIT = re.compile(r"\b(?:unit|ste|suite|apt|appt|flat|office|shop|door|lot|bat|batiment|whg)\b\.?\s*(?:no\b|nr\b|n\b)?\.?\s*#?\s*([a-z]?-?\d+)\b")
_SLASHED = re.compile(r"(?<=\d)\s*/\s*(?=\d)")
_LETTERED = re.compile(r"(^\W*|[,;.]\s*|\s-\s*)([a-mo-z])\s{0,3}(\d)")
_TOKEN = re.compile(r"([a-z]-\s?\d+(?:/\d+)?|\d+(?:/\d+)?(?:\s?bis\b)?)|([a-z]+)|([,;.#-]+)")


@lru_cache(maxsize=200_000)
def _general(w: str) -> bool:
    if w in GENERAL or len(w) < 3:
        return True
    if len(w) < 6:
        return False
    return any(near(w, g, 1) for v in _shortened(w) for g in _GENERAL_BY_CUT.get(v, ()))


def _shortened(w: str) -> list[str]:
    """w and all strings with one letter left out; two words with one change between them share one."""
    return [w, *(w[:i] + w[i + 1 :] for i in range(len(w)))]


_GENERAL_BY_CUT: dict[str, list[str]] = {}
for _g in sorted(GENERAL):
    if len(_g) >= 6:
        for _v in _shortened(_g):
            _GENERAL_BY_CUT.setdefault(_v, []).append(_g)


def near(a: str, b: str, k: int) -> bool:
    """Whether at most k letters differ (insertion, deletion, change or swap of neighbours)."""
    return distance(a, b, k) <= k


@lru_cache(maxsize=500_000)
def _letter_set(w: str) -> int:
    out = 0
    for c in w:
        out |= 1 << (ord(c) & 63)
    return out


def _few_changes(a: str, b: str, k: int) -> int:
    """distance for a k of 2 at most: what begins and ends both words is left out, then each first change is tried."""
    n, m = len(a), len(b)
    if abs(n - m) > k:
        return k + 1
    i, least = 0, min(n, m)
    while i < least and a[i] == b[i]:
        i += 1
    while least > i and a[n - 1] == b[m - 1]:
        n, m, least = n - 1, m - 1, least - 1
    if i == n or i == m:
        return n + m - 2 * i
    if k < 1:
        return 1
    swap = n - i > 1 and m - i > 1 and a[i] == b[i + 1] and a[i + 1] == b[i]
    if k == 1:
        return 1 if n - i == m - i == 1 or swap and n - i == m - i == 2 else 2
    a, b = a[i:n], b[i:m]
    d = min(_few_changes(a[1:], b[1:], 1), _few_changes(a[1:], b, 1), _few_changes(a, b[1:], 1))
    if swap and d:
        d = min(d, _few_changes(a[2:], b[2:], 1))
    return 1 + d


def distance(a: str, b: str, k: int = 99) -> int:
    """Restricted edit distance; stops above k."""
    if a == b:
        return 0
    if abs(len(a) - len(b)) > k:
        return k + 1
    if k <= 2:
        # a change brings one letter and takes one at most
        return k + 1 if (_letter_set(a) ^ _letter_set(b)).bit_count() > 2 * k else _few_changes(a, b, k)
    prev2: list[int] = []
    prev = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            d = min(prev[j] + 1, row[-1] + 1, prev[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and y == a[i - 2]:
                d = min(d, prev2[j - 2] + 1)
            row.append(d)
        if min(row) > k:
            return k + 1
        prev2, prev = prev, row
    return prev[-1]


def _number(raw: str) -> str:
    if raw.isascii() and raw.isdigit():
        return raw.lstrip("0") or "0"
    n = re.sub(r"[\s-]", "", raw).replace("bis", "")
    return "/".join(re.sub(r"(?<![0-9])0+(?=\d)", "", part) for part in n.split("/"))


@lru_cache(maxsize=200_000)
def _german(w: str) -> str | None:
    """The name in a German compound of name and kind of street."""
    for end in ("strasse", "allee", "gasse", "platz", "weg", "str", "pl", "g"):
        if w.endswith(end) and len(w) - len(end) >= 5:
            return w[: -len(end)]
    return None


def parse_address(address: str | None) -> tuple[str, str, str, str, str, str] | None:
    """(number, street, towns, postcode, state, unit) or None for an empty address.

    street and towns are as they sound; towns are joined by blanks; what is
    missing is empty. Number and street are found together or not at all.
    """
    s = fold(address)
    if not s:
        return None
    if _HAS_PHONE.search(s):
        s = _PHONE.sub(" ", s)
    s = _LANDMARK.sub(" , ", s)
    s = _LETTERED.sub(r"\1\2-\3", _SLASHED.sub("/", s))
    units = _UNIT.findall(s)
    s = _UNIT.sub(" , ", _FLOOR.sub(" , ", _AREA.sub(" , ", s)))
    tokens: list[tuple[str, str]] = []  # kind: n number, w word, t kind of street, s separator
    postcode = state = ""
    for num, word, sep in _TOKEN.findall(s):
        if num:
            digits = num.strip()
            if digits.isdigit() and 5 <= len(digits) <= 6 and not digits.startswith("00"):
                postcode = postcode or digits
                tokens.append(("s", ","))
            elif digits.isdigit() and len(digits) >= 7:
                continue
            else:
                tokens.append(("n", _number(digits)))
        elif word:
            if word in STREET_AFTER or word in STREET_BEFORE:
                if word in STATES and not state:
                    state = STATES[word]
                tokens.append(("t", word))
            elif _general(word):
                state = state or STATES.get(word, "")
                if word not in ("no", "n", "h", "hno", "plot", "house", "nr"):
                    tokens.append(("g", word))
            else:
                tokens.append(("w", word))
        else:
            if "#" in sep and sep.strip("#") == "":
                continue
            tokens.append(("s", sep))
    best: tuple[float, str, str, int] | None = None
    for i, (kind, value) in enumerate(tokens):
        if kind != "n":
            continue
        # name after the number: 12 [,] [rue] Name [Road]
        j = i + 1
        crossed = 0
        while j < len(tokens) and (tokens[j][0] == "s" or tokens[j][0] == "t" and tokens[j][1] in STREET_BEFORE):
            crossed += tokens[j][0] == "s"
            j += 1
        if j < len(tokens) and tokens[j][0] == "w":
            before = any(tokens[k][0] == "t" for k in range(i + 1, j))
            after = j + 1 < len(tokens) and tokens[j + 1][0] == "t"
            score = 1.0 + 3.5 * (before or after) - 0.5 * crossed
            if best is None or score > best[0]:
                best = (score, value, tokens[j][1], j)
        # name before the number: Namestrasse 12, Name Strasse 12
        j = i - 1
        kind_word = False
        while j >= 0 and tokens[j][0] in "tgs" and (tokens[j][1] in STREET_GERMAN or tokens[j][1] in (".", "no") or tokens[j][1] == "," and i - j == 1):
            kind_word = kind_word or tokens[j][1] in STREET_GERMAN
            j -= 1
        if j >= 0 and tokens[j][0] == "w" and (i - j == 1 or kind_word or _german(tokens[j][1])):
            stem = _german(tokens[j][1]) if not kind_word else None
            score = 1.2 + 2.5 * bool(kind_word or (stem and not tokens[j][1].endswith("g"))) - (0 if kind_word or stem else 1.0) - 0.5 * any(tokens[k][1] == "," for k in range(j + 1, i))
            if stem and tokens[j][1].endswith("g") and j + 1 < len(tokens) and tokens[j + 1][1].startswith("."):
                score += 2.5
            if best is None or score > best[0]:
                best = (score, value, stem or tokens[j][1], j)
    _, number, street, at = best or (0.0, "", "", -1)
    towns = " ".join(sound(v) for k, (t, v) in enumerate(tokens) if t == "w" and k != at and len(v) >= 4)
    return number, sound(street), towns, postcode, state, units[0].replace("-", "") if units else ""


PARSED = "words array<string>, number string, street string, towns string, postcode string, state string, unit string"


#: Words that are general whatever their frequency, as they sound.
KNOWN = frozenset(sound(w) for w in {*WORDS, *WORDS.values(), *BEGINNINGS, *GIVEN, *_ALL_SHORT})
_SHORT_SOUNDS = {(sound(full), sound(s)) for full, shorts in GIVEN.items() for s in shorts.split()}
_BEGINNINGS = frozenset(sound(w) for w in BEGINNINGS)


def same_general(a: str, b: str) -> bool:
    """Whether two general words can stand for each other: equal, one a short form or the beginning of the other, or misspelt."""
    if a == b or (a, b) in _SHORT_SOUNDS or (b, a) in _SHORT_SOUNDS:
        return True
    short, long = sorted((a, b), key=len)
    if long.startswith(short) and (short in _BEGINNINGS or len(short) >= 4 and len(long) - len(short) <= 4):
        return True
    return len(short) >= 5 and near(a, b, 1)


class Vocabulary:
    """General words of names, as they sound; other words are rare and tell businesses apart."""

    def __init__(self, words: list[str]) -> None:
        words = sorted({*words, *KNOWN})
        self.words = frozenset(words)
        self.cut: dict[str, str] = {}
        self.bones: dict[str, str] = {}
        for w in sorted(words, reverse=True):
            self.bones[_bones(w)] = w
            if len(w) >= 5:
                for i in range(len(w)):
                    self.cut[w[:i] + w[i + 1 :]] = w
        self.known: dict[str, list[tuple[str, bool]]] = {}

    def read(self, word: str) -> list[tuple[str, bool]]:
        """[(word as it sounds, whether it is frequent)]; a misspelt frequent word is put right, a joined one cut."""
        got = self.known.get(word)
        if got is None:
            if len(self.known) > 300_000:
                self.known.clear()
            got = self.known[word] = self._read(word)
        return got

    def _read(self, word: str) -> list[tuple[str, bool]]:
        foreign = word.startswith("~")
        w = sound(word.lstrip("~"))
        if w in self.words:
            return [(w, True)]
        if foreign and len(_bones(w)) >= 3 and (v := self.bones.get(_bones(w))):
            return [(v, True)]
        if len(w) >= 6:
            for c in [w, *(w[:i] + w[i + 1 :] for i in range(len(w)))]:
                v = self.cut.get(c) or (c if c in self.words and len(c) >= 5 else None)
                if v and near(v, w, 1 if len(w) < 9 else 2):
                    return [(v, True)]
        for i in range(4, len(w) - 3):
            if len(w) - i >= 6 and w[i:] in self.words:
                return [*self._read(w[:i]), (w[i:], True)]
            if i >= 6 and w[:i] in self.words:
                return [(w[:i], True), *self._read(w[i:])]
        return [(w, False)]

    def split(self, words: list[str] | None) -> tuple[list[str], list[str]]:
        """(rare words in their order, frequent words sorted)."""
        rare: list[str] = []
        common: set[str] = set()
        for word in words or ():
            for w, frequent in self.read(word):
                if frequent:
                    common.add(w)
                elif w not in rare:
                    rare.append(w)
        return rare, sorted(common)


def _bones(w: str) -> str:
    return re.sub("[aeo]", "", w)


#: A word is frequent above this share of all records, so there are at most a few thousand frequent ones.
FREQUENT_SHARE = 2e-4
FREQUENT_LEAST = 12


def vocabulary(parsed: DataFrame) -> Vocabulary:
    """The frequent words of all records of parsed."""
    words = parsed.select(F.explode(F.array_distinct("words")).alias("w")).groupBy("w").agg(F.count(F.lit(1)).alias("n"))
    n = parsed.count()
    rows = words.where(F.col("n") > max(FREQUENT_LEAST, FREQUENT_SHARE * n)).collect()
    return Vocabulary(sorted({sound(r["w"].lstrip("~")) for r in rows}))


def split_words(parsed: DataFrame, vocab: Vocabulary) -> DataFrame:
    """parsed with rare and common instead of words."""
    kept = [c for c in parsed.columns if c != "words"]
    frequent = sorted(vocab.words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = Vocabulary(frequent)
        for batch in batches:
            both = [v.split(w) for w in batch.column("words").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in kept], pa.array([b[0] for b in both], pa.list_(pa.string())), pa.array([b[1] for b in both], pa.list_(pa.string()))], names=[*kept, "rare", "common"]
            )

    schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in parsed.schema.fields if f.name in kept], "rare array<string>", "common array<string>"])
    return parsed.select(*kept, "words").mapInArrow(run, schema)


def parse_records(df: DataFrame, name: str = "business_name", address: str = "business_address") -> DataFrame:
    """df without name and address, with their parts (see PARSED); a null or empty value has none."""
    kept = [c for c in df.columns if c not in (name, address)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cache: dict = {}
            words = [name_words(x) for x in batch.column(name).to_pylist()]
            parts: list[list] = [[], [], [], [], [], []]
            for a in batch.column(address).to_pylist():
                p = cache.get(a, 0)
                if p == 0:
                    p = cache[a] = parse_address(a)
                for column, value in zip(parts, p or ("",) * 6):
                    column.append(value or "")
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in kept], pa.array(words, pa.list_(pa.string())), *[pa.array(p, pa.string()) for p in parts]],
                names=[*kept, "words", "number", "street", "towns", "postcode", "state", "unit"],
            )

    schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields if f.name in kept], PARSED])
    return df.select(*kept, F.col(name), F.col(address)).mapInArrow(run, schema)
