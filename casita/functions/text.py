"""Text normalization as Column expressions (N1 to N20, N27 to N37). No Python runs on the executors."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accented letters and their plain forms.
_ACCENTED = "áàâäãåéèêëíìîïóòôöõúùûüçÁÀÂÄÃÅÉÈÊËÍÌÎÏÓÒÔÖÕÚÙÛÜÇ"
_PLAIN = "aaaaaaeeeeiiiiooooouuuucAAAAAAEEEEIIIIOOOOOUUUUC"
# Letter pairs that a wrong decoding leaves, in the order of repair.
MOJIBAKE = (("√±", "ñ"), ("√ë", "Ñ"), ("Ã±", "ñ"), ("Ã‘", "Ñ"), ("Ã¡", "á"), ("Ã©", "é"), ("Ãí", "í"), ("Ã³", "ó"), ("Ãú", "ú"), ("ÃÁ", "Á"), ("Ã‰", "É"), ("ÃÍ", "Í"), ("Ã“", "Ó"), ("Ãš", "Ú"), ("Â", ""))
# Typographic characters and their plain forms.
_TYPOGRAPHIC = "‘’‚“”„–—−…•"
_ASCII = "'''\"\"\"---.*"
_ZERO_WIDTH = "​‌‍⁠﻿"
_SPACES = "\u00a0\u2007\u202f\u3000"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value computed once, however often body uses it; keeps expressions small."""
    return F.transform(F.array(value), body)[0]


def squeeze(x: Column) -> Column:
    """Runs of white space become one space, the ends go."""
    return F.trim(F.regexp_replace(x, r"\s+", " "))


def fold(x: Column) -> Column:
    """Accents off, ñ kept: a closed set of Latin letters, the same everywhere."""
    return F.translate(x, _ACCENTED, _PLAIN)


def fold_n(x: Column) -> Column:
    """Accents off, ñ as n."""
    return F.translate(fold(x), "ñÑ", "nN")


def fold_lower(x: Column) -> Column:
    """Without accents, lower, single spaces."""
    return squeeze(F.lower(fold_n(F.translate(x, "²³", "23"))))


def fold_upper(x: Column) -> Column:
    """Without accents (ñ as n), upper."""
    return F.upper(fold_n(x))


def fold_upper_keep_n(x: Column) -> Column:
    """Without accents, ñ preserved, upper."""
    return F.upper(fold(x))


def join_key(x: Column) -> Column:
    """N2, other punctuation than / . - & ' as space, single spaces."""
    return squeeze(F.regexp_replace(fold_upper(x), r"[^A-ZÑ0-9\s/.\-&']", " "))


def fix_mojibake(x: Column) -> Column:
    """The repairs, in order."""
    for bad, good in MOJIBAKE:
        x = F.replace(x, F.lit(bad), F.lit(good))
    return x


def cell(x: Column) -> Column:
    """Lower, single spaces; null as empty."""
    return F.coalesce(squeeze(F.lower(x)), F.lit(""))


def null_text(x: Column) -> Column:
    """Empty text, nan and none are null (1.2)."""
    return F.when(F.lower(F.trim(x)).isin("", "nan", "none", "null"), None).otherwise(x)


def preclean_place(raw: Column) -> Column:
    """The place at the start of a noisy cell: boulevard heads as they are; descriptions, offers, prices and brackets cut off."""
    return let(F.upper(fix_mojibake(F.coalesce(raw, F.lit("")))), _bare_place)


# A colon, a dot and dash, a bracket or an amount ends a place.
_PLACE_END = r"(?iu):|\.-\s|[()（）]|(?:\$|LPS?\.?|USD|HNL|LEMPIRAS?)\s*\d"


def _bare_place(s: Column) -> Column:
    head = F.regexp_extract(s, r"^BLVD\s+[A-ZÑ]+", 0)
    boulevard = F.regexp_extract(s, r"\bBLVD(\s+[A-ZÑ]+){1,2}", 0)
    described = r"(?iu)\b(CASA|DEPARTAMENTO|CONDO|VENTA|ALQUILER|RENTA)\b"
    cut = None
    for mark in (" - ", " | ", " / "):
        hit = F.coalesce(F.substring(s, F.instr(s, mark) + len(mark), F.lit(2**30)).rlike(described), F.lit(False)) & F.contains(s, F.lit(mark))
        bare = F.substring(s, F.lit(1), F.instr(s, mark) - 1)
        cut = F.when(hit, bare) if cut is None else cut.when(hit, bare)
    cut = cut.otherwise(s)
    # all that ends a place is sought at once: what stands before the first of it is the place
    place = F.get(F.split(cut, _PLACE_END, 2), 0)
    bare = squeeze(F.regexp_replace(place, r"(?iu)\b(?:VENTA|ALQUILER|RENTA|SALE|PRECIO|PRICE)\b", " "))
    t = F.regexp_replace(F.regexp_replace(bare, r"\.{2,}", "."), r"[.·․。]+\s*$", "")
    return F.when(head != "", F.regexp_replace(head, r"\s+", " ")).when(boulevard != "", boulevard).otherwise(t)


def words_pattern(words: list[str]) -> str:
    """An alternation of whole words and phrases, longest first, any spaces, commas or dots between a phrase's words."""
    distinct = sorted({w.strip() for w in words if w.strip()}, key=lambda w: (-len(w), w))
    return r"(?iu)\b(" + "|".join(r"[\s,.]*".join(re.escape(p) for p in w.split()) for w in distinct) + r")\b"


def remove_words(x: Column, words: list[str]) -> Column:
    """The words and phrases go, wherever they stand whole; a null cell becomes empty."""
    plain = F.coalesce(x, F.lit(""))
    return squeeze(F.regexp_replace(plain, words_pattern(words), "")) if any(w.strip() for w in words) else squeeze(plain)


def slug(x: Column) -> Column:
    """Lower, other than a-z 0-9 as single hyphens; empty or null as na."""
    return F.coalesce(F.nullif(F.regexp_replace(F.regexp_replace(F.lower(F.trim(x)), "[^a-z0-9]+", "-"), "^-|-$", ""), F.lit("")), F.lit("na"))


def agency_key(x: Column) -> Column:
    """Without accents, lower, only letters and digits."""
    return F.regexp_replace(fold_lower(F.coalesce(x, F.lit(""))), "[^a-z0-9]", "")


# Words that do not tell places apart.
STOP_WORDS = (
    "CASA", "APTO", "APARTAMENTO", "CONDOMINIO", "TOWN", "HOUSE", "VILLA", "LOCAL", "BODEGA", "EDIF", "EDIFICIO", "TORRE", "RESIDENCIA", "RESIDENCIAL", "RES", "RES.",
    "URB", "URB.", "URBANIZACION", "COL", "COL.", "COLONIA", "BARRIO", "BO", "BO.", "AVE", "AVE.", "AV", "AV.", "BLVD", "BLVD.", "BOULEVARD",
    "$", "US$", "USD", "HNL", "L.", "LPS", "LPS.",
)


def label(x: Column) -> Column:
    """Upper without accents, an amount at the start and marks at the end off, punctuation but dots as space."""
    s = F.trim(fold_upper(F.coalesce(x, F.lit(""))))
    s = F.regexp_replace(s, r"^(\$|US\$|USD|HNL|LPS?\.?|L\.)[\s\d.,\-]*", "")
    return squeeze(F.regexp_replace(F.regexp_replace(s, r"[\s,;:/|\-]*$", ""), r"[^A-Z0-9_\s.]", " "))


def label_tokens(x: Column, stop: tuple[str, ...] = STOP_WORDS) -> Column:
    """Distinct tokens of a label less stop words and bare numbers, in order."""
    return F.array_distinct(F.filter(F.split(label(x), " "), lambda t: (t != "") & ~t.isin(*stop) & ~t.rlike("^[0-9]+$")))


def base_tokens(x: Column, stop: tuple[str, ...] = STOP_WORDS) -> Column:
    """Sorted tokens less stop words and single letters; single digits stay."""
    return F.array_sort(F.array_distinct(F.filter(F.split(label(x), " "), lambda t: ~t.isin(*stop) & ((F.length(t) > 1) | t.rlike("^[0-9]$")))))


def sanitize(x: Column) -> Column:
    """Zero-width characters off, typographic marks and odd spaces plain, single spaces."""
    return squeeze(F.translate(F.translate(F.translate(x, _ZERO_WIDTH, ""), _TYPOGRAPHIC, _ASCII), _SPACES, " " * len(_SPACES)))


def plain_key(x: Column) -> Column:
    """The sanitized cell without accents, lower."""
    return fold_lower(sanitize(x))


# Names of currencies.
CURRENCIES = {"$": "USD", "US$": "USD", "USD$": "USD", "DOLAR": "USD", "DOLARES": "USD", "DOLLAR": "USD", "DOLLARS": "USD", "L": "HNL", "L.": "HNL", "LPS": "HNL", "LPS.": "HNL", "LP": "HNL", "LEMPIRA": "HNL", "LEMPIRAS": "HNL"}


def currency(x: Column, aliases: dict[str, str] = CURRENCIES) -> Column:
    """A name in the list, else three letters as they are (upper), else null."""
    up = fold_upper(F.trim(x))
    known = F.create_map(*[F.lit(v) for kv in aliases.items() for v in kv])
    return F.coalesce(F.try_element_at(known, up), F.when(up.rlike("^[A-Z]{3}$"), up))


# Date layouts, in the order they are tried.
DATE_FORMATS = (("^\\d{4}-\\d{1,2}-\\d{1,2}$", "y-M-d"), ("^\\d{4}/\\d{1,2}/\\d{1,2}$", "y/M/d"), ("^\\d{8}$", "yyyyMMdd"), ("^\\d{1,2}/\\d{1,2}/\\d{4}$", "d/M/y"), ("^\\d{1,2}-\\d{1,2}-\\d{4}$", "d-M-y"), ("^\\d{1,2}\\.\\d{1,2}\\.\\d{4}$", "d.M.y"), ("^\\d{4}\\.\\d{1,2}\\.\\d{1,2}$", "y.M.d"), ("^\\d{1,2}/\\d{1,2}/\\d{4}$", "M/d/y"))


def date(x: Column) -> Column:
    """The first layout that fits; else three groups of digits, two-digit years below 70 after 2000; else null."""
    t = F.trim(x)
    tried = [F.when(t.rlike(pattern), F.try_to_timestamp(t, F.lit(layout)).cast("date")) for pattern, layout in DATE_FORMATS]
    group = lambda k: F.nullif(F.regexp_extract(t, r"^(\d{1,2})\D+(\d{1,2})\D+(\d{2})$", k), F.lit("")).cast("int")
    year = F.when(group(3) < 70, group(3) + 2000).otherwise(group(3) + 1900)
    rescued = F.try_to_timestamp(F.format_string("%d-%d-%d", year, group(2), group(1)), F.lit("y-M-d")).cast("date")
    return F.coalesce(*tried, F.when(t.rlike(r"^\d{1,2}\D+\d{1,2}\D+\d{2}$"), rescued))


def yyyymmdd(x: Column, missing: str | None = "00000000") -> Column:
    """An ISO date as yyyymmdd; what is none as `missing`, or an error if that is None."""
    got = F.date_format(F.when(F.trim(x).rlike(r"^\d{4}-\d{2}-\d{2}$"), F.try_to_timestamp(F.trim(x), F.lit("yyyy-MM-dd"))), "yyyyMMdd")
    return F.coalesce(got, F.lit(missing) if missing is not None else F.raise_error(F.concat(F.lit("no date: "), F.coalesce(x, F.lit("null")))))


def amount(x: Column) -> Column:
    """Digits, a leading minus and the first dot of a text, as a number; null if no digit is left."""
    kept = F.regexp_replace(x, r"[^0-9.\-]", "")
    sign = F.when(kept.startswith("-"), "-").otherwise("")
    bare = F.replace(kept, F.lit("-"), F.lit(""))
    first = F.substring_index(bare, ".", 1)
    rest = F.replace(F.substring(bare, F.length(first) + 2, F.lit(2**30)), F.lit("."), F.lit(""))
    return number(F.concat(sign, first, F.when(rest != "", F.concat(F.lit("."), rest)).otherwise("")))


def number(x: Column) -> Column:
    """A plain decimal number, else null (no suffixes, no nan, no infinities)."""
    t = F.trim(x.cast("string"))
    return F.when(t.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"), t.try_cast("double"))


def half_even(x: Column, digits: int = 2) -> Column:
    """A double rounded half to even of its scaled value."""
    return F.rint(x * 10**digits) / 10**digits


def year_month(x: Column) -> Column:
    """N32."""
    return F.date_format(x, "yyyy-MM")


def zero_padded(x: Column, width: int = 4) -> Column:
    """Padded with zeros, never cut."""
    return F.format_string(f"%0{width}d", x)


def hash_of(parts: list[Column], how: str = "md5", sep: str = "|") -> Column:
    """The digest of parts joined; a null part counts as empty."""
    text = F.concat_ws(sep, *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.md5(text) if how == "md5" else F.sha1(text)


def place_code(x: Column) -> Column:
    """The first three letters of the first two telling words, filled with X."""
    words = F.filter(F.split(label(x), " "), lambda t: (t != "") & ~t.isin(*STOP_WORDS))
    part = lambda k: F.rpad(F.substring(F.coalesce(F.get(words, k), F.lit("")), 1, 3), 3, "X")
    return F.concat(part(0), part(1))


def zone_text(x: Column) -> Column:
    """A zone on one line; null is empty."""
    return F.translate(F.trim(F.coalesce(x.cast("string"), F.lit(""))), "\r\n", "  ")


# Repairs of scanned lines, in order.
SCAN_REPAIRS = (
    (r"\$\.", r"\$ "), (r"(?i)(Lps?|L)\.(\d)", "$1. $2"), (r"(?i)US\$(\d)", r"US\$ $1"), (r"(?i)\bbafios\b", "baños"), (r"(?i)\bbanos\b", "baños"), (r"(?i)\bbano\b", "baño"),
    (r"(?i)\b(mts?2|mt2|m2)\b", "m²"), (r"(?i)\b(vr2|vrs2|v2)\b", "vrs²"), (r"(\$)(\d)", "$1 $2"), (r"(?i)(Lps?\.?|US\$)(\s*)(\d)", "$1 $3"),
    ("\u2022", "*"), ("\u00ad", ""), ("[\u2018\u2019]", "'"), ("[\u201c\u201d]", '"'),
)


def scanned(x: Column) -> Column:
    """Usual misreadings repaired, words joined over a line's end, single blanks within lines."""
    t = F.coalesce(x, F.lit(""))
    for pattern, good in SCAN_REPAIRS:
        t = F.regexp_replace(t, pattern, good)
    t = F.regexp_replace(F.regexp_replace(t, r"-\s*\n\s*", ""), r"[ \t]+", " ")
    return F.regexp_replace(F.regexp_replace(t, r"\r\n?", "\n"), r"^\n+|\n+$", "")


def web_text(x: Column) -> Column:
    """Tags, entities for spaces and pictographs off, single spaces."""
    bare = F.regexp_replace(F.regexp_replace(x, r"<[^>]*>", " "), r"&nbsp;|&#160;", " ")
    return squeeze(F.regexp_replace(F.replace(bare, F.lit("&amp;"), F.lit("&")), "[\U0001f300-\U0001faff☀-➿️]", ""))
