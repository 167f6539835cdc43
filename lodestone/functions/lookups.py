"""Lookup tables of the normalization chain."""

# Spellings of legal forms, kinds of streets and states, and words without identity.
LEGAL_SUFFIX = {
    "corporation": "corp", "corporated": "corp", "corp": "corp",
    "incorporated": "inc", "inc": "inc",
    "limited": "ltd", "ltd": "ltd", "limitd": "ltd",
    "private": "pvt", "pvt": "pvt", "pvtltd": "pvt", "praivet": "pvt",
    "company": "co", "co": "co", "compant": "co",
    "llc": "llc", "llp": "llp", "elelpi": "llp",
    "plc": "plc", "sarl": "sarl", "sas": "sas", "sa": "sa", "eurl": "eurl",
    "gmbh": "gmbh", "and": "&", "et": "&",
}
STREET_ABBR = {
    "road": "rd", "rd": "rd", "street": "st", "st": "st", "saint": "st", "str": "st",
    "avenue": "ave", "ave": "ave", "av": "ave", "drive": "dr", "dr": "dr", "lane": "ln", "ln": "ln",
    "boulevard": "blvd", "blvd": "blvd", "boulevar": "blvd", "court": "ct", "ct": "ct", "place": "pl", "pl": "pl",
    "terrace": "ter", "ter": "ter", "highway": "hwy", "hwy": "hwy", "square": "sq", "sq": "sq",
    "parkway": "pkwy", "pkwy": "pkwy", "circle": "cir", "cir": "cir", "trail": "trl", "trl": "trl",
    "apartment": "apt", "apt": "apt", "suite": "ste", "ste": "ste", "building": "bldg", "bldg": "bldg", "block": "blk", "blk": "blk",
    "cross": "crs", "main": "main", "sector": "sec", "sec": "sec", "nagar": "ngr", "ngr": "ngr", "colony": "cly", "cly": "cly",
    "rue": "rue", "boulevard_fr": "blvd",
}
US_STATES = {
    "alabama": "al", "alaska": "ak", "arizona": "az", "arkansas": "ar", "california": "ca", "colorado": "co", "connecticut": "ct", "delaware": "de",
    "florida": "fl", "georgia": "ga", "hawaii": "hi", "idaho": "id", "illinois": "il", "indiana": "in", "iowa": "ia", "kansas": "ks",
    "kentucky": "ky", "louisiana": "la", "maine": "me", "maryland": "md", "massachusetts": "ma", "michigan": "mi", "minnesota": "mn", "mississippi": "ms",
    "missouri": "mo", "montana": "mt", "nebraska": "ne", "nevada": "nv", "ohio": "oh", "oklahoma": "ok", "oregon": "or", "pennsylvania": "pa",
    "tennessee": "tn", "texas": "tx", "utah": "ut", "vermont": "vt", "virginia": "va", "washington": "wa", "wisconsin": "wi", "wyoming": "wy",
}
IN_STATES = {
    "andhra": "ap", "telangana": "tg", "karnataka": "ka", "krnatk": "ka", "kerala": "kl", "tamilnadu": "tn", "tmilnadu": "tn",
    "maharashtra": "mh", "mharastr": "mh", "gujarat": "gj", "gujrat": "gj", "rajasthan": "rj", "rajsthan": "rj",
    "punjab": "pb", "haryana": "hr", "hriyana": "hr", "delhi": "dl", "dilli": "dl",
    "uttarpradesh": "up", "uttrprdes": "up", "uttrpradesh": "up", "madhyapradesh": "mp", "mdhyprdes": "mp",
    "westbengal": "wb", "pscimbngal": "wb", "bihar": "br", "odisha": "or", "orissa": "or", "jharkhand": "jh",
    "assam": "as", "chhattisgarh": "cg", "uttarakhand": "uk", "goa": "ga", "himachalpradesh": "hp", "jammu": "jk", "kashmir": "jk",
}
STATE_MAP = US_STATES | IN_STATES
STOP_TOKENS = (
    "null none na nil po box pobox unit no nos door doorno near opp opposite behind the of at shop floor flr ph phone mob mobile tel"
).split()
ORDINAL_ENDS = "st nd rd th s e er eme".split()

# Latin letters for scripts whose letters aren't named after their sound alone.
CYRILLIC = dict(zip("абвгдежзийклмнопрстуфхцчшщъыьэюя", "a b v g d e zh z i i k l m n o p r s t u f kh ts ch sh shch  y  e yu ya".split(" ")))
GREEK = dict(zip("αβγδεζηθικλμνξοπρστυφχψως", "a b g d e z i th i k l m n x o p r s t y f ch ps o s".split()))
LATIN = {"ß": "ss", "æ": "ae", "œ": "oe", "ø": "o", "ł": "l", "đ": "d", "ð": "d", "þ": "th", "ı": "i"}
