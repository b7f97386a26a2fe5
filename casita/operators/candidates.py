"""Place candidates: noise off, a key, and how it was done (N7, N8); a place by strategy, catalog or usual heads (X11e)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from casita.functions.listing import place
from casita.functions.text import fix_mojibake, fold_upper_keep_n, let, squeeze

# Short months and what they stand for.
MONTHS = (
    (r"\bENE\.?\b", "ENERO"), (r"\bFEB\.?\b", "FEBRERO"), (r"\bMAR\.?\b", "MARZO"), (r"\bABR\.?\b", "ABRIL"), (r"\bMAY\.?\b", "MAYO"), (r"\bJUN\.?\b", "JUNIO"), (r"\bJUL\.?\b", "JULIO"),
    (r"\bAGO\.?\b", "AGOSTO"), (r"\bSET\.?\b|\bSEP\.?T?\.?\b", "SEPTIEMBRE"), (r"\bOCT\.?\b", "OCTUBRE"), (r"\bNOV\.?\b", "NOVIEMBRE"), (r"\bDIC\.?\b", "DICIEMBRE"),
)
# What a candidate may hold besides a place; all but the level and the marks make it a noisy one.
NOISE = {
    "price": r"(?i)(?:US\$|USD|\$|HNL|LPS?\.?|L\.)\s*[\d.,]+(?:\s*(?:K|MIL|M|MM))?",
    "area": r"(?iu)\b[\d.,]+\s*(?:M2|M\^2|M²|MT2|MTS2|MTS|METROS CUADRADOS|FT2|FT\^2|FT²|VARAS|VRS2|HA|HECTAREAS|HECTÁREAS)\b",
    "beds": r"(?i)\b(?:DE\s*)?\d+(?:[.,]\d+)?\s*(?:HAB(?:IT(?:A\w*)?)?|HABS?|DORM(?:ITORIOS?)?|DORMS?|CUARTOS?)\b",
    "baths": r"(?iu)\b(?:DE\s*)?\d+(?:[.,]\d+)?\s*(?:BAÑ?O(?:S)?|BANO(?:S)?)\b",
    "level": r"(?i)\b\d+\s*(?:PISOS?|NIVELES?)\b",
    "phone": r"\b\d{7,}\b",
    "email": r"(?i)[A-Z0-9._%+-]+@[A-Z0-9.-]+\.[A-Z]{2,}",
    "url": r"(?i)\bhttps?://\S+|www\.\S+\b",
    "offer": r"(?i)\b(?:VENTA|ALQUILER|RENTA|RENT|SALE|PRECIO|PRICE)\b",
    "kind": r"(?i)\b(?:CASA|HOUSE|APARTAMENTOS?|APART\.?|APT\.?|CONDOMINIO|CONDO|DUPLEX|TRIPLEX|OFICINA|LOCAL|BODEGA|TERRENO|LOTES?)\b",
    "marks": r"[*|•]+",
}
QUIET = ("level", "marks")
PREFIX = r"(?i)^(?:COLONI|COLONIA|COL\.?|BARRIO|RESIDENCIAL|RES\.?|APARTAM|APARTAMENTO[S]?|APT\.?)\s+"
BOULEVARD = r"(?iu)\b(BLVD\.?|BLV\.?)\s+([A-ZÁÉÍÓÚÜÑ0-9]+)"
# Heads of places, in the order they are tried.
HEADS = (r"(?iu)Col\.?\s?[A-Za-zÁÉÍÓÚÑñ ]+", r"(?i)Loma\s+[A-Za-z]+", r"(?i)Altos\s+de\s+[A-Za-z]+", r"(?i)San\s+[A-Za-z]+", r"(?i)Res\.?\s?[A-Za-z ]+")


def place_key(x: Column) -> Column:
    """Upper without accents but ñ; letters, digits, / - and . kept, single spaces."""
    return squeeze(F.regexp_replace(fold_upper_keep_n(F.coalesce(x, F.lit(""))), r"[^A-ZÑ0-9\s/\-.]", " "))


def expand_months(x: Column) -> Column:
    """Short months become whole ones."""
    return reduce(lambda t, m: F.regexp_replace(t, "(?i)" + m[0], m[1]), MONTHS, x)


def prepared_key(x: Column) -> Column:
    """Repaired, months whole, what a bad scan glued behind a month off, as a key."""
    whole = expand_months(fix_mojibake(F.coalesce(x, F.lit(""))))
    return place_key(F.regexp_replace(whole, r"(?i)\b(SEPTIEMBRE|SEPT|SEP|SET)\.[A-Z*]+\b", "$1"))


def clean_candidate(candidate: Column, raw: Column | None = None) -> Column:
    """(clean, norm, mode). A boulevard named in the raw text wins (blvd); a candidate that holds an offer, an amount,
    a contact or a kind of property loses all noise, then its prefix (heavy); any other only its prefix (light)."""
    bare = lambda t: squeeze(F.regexp_replace(t, PREFIX, ""))
    quiet = lambda t: reduce(lambda s, p: F.regexp_replace(s, p, " "), NOISE.values(), t)
    said = lambda clean, mode: F.struct(clean.alias("clean"), place_key(clean).alias("norm"), F.lit(mode).alias("mode"))

    def cleaned(t: Column) -> Column:
        loud = reduce(lambda a, b: a | b, [t.rlike(p) for k, p in NOISE.items() if k not in QUIET])
        # prefixes are looked for before the ends are trimmed
        return F.when(loud, said(bare(quiet(t)), "heavy")).otherwise(said(bare(t), "light"))

    own = let(fix_mojibake(F.coalesce(candidate, F.lit(""))), cleaned)
    if raw is None:
        return own
    full = fix_mojibake(F.coalesce(raw, F.lit("")))
    part = lambda k: F.regexp_replace(F.upper(F.regexp_extract(full, BOULEVARD, k)), r"\.$", "")
    return F.when(full.rlike(BOULEVARD), said(F.concat_ws(" ", part(1), part(2)), "blvd")).otherwise(own)


def match_place(text: Column, catalog: list[tuple[str, list[str]]], strategy: str | None = None) -> Column:
    """X11e: what the strategy finds; else the first catalog entry (name, aliases) whose name or alias the text contains
    (letters and digits only, lower); else the first usual head with what follows it; else empty. Upper case.

    The catalog is configuration: a list in the plan. For a table of aliases, see lookup.contained_alias.
    """
    plain = lambda t: F.regexp_replace(F.lower(t), r"[^\p{L}\p{N}_\s]", "")
    own = F.coalesce(text, F.lit(""))
    entries = [F.struct(F.lit(name.upper()).alias("name"), plain(F.lit(n)).alias("n")) for name, more in catalog for n in (name, *more)]
    known = let(plain(own), lambda t: F.get(F.filter(F.array(*entries), lambda e: F.contains(t, e.n)), 0)["name"]) if entries else F.lit(None).cast("string")
    heads = [F.nullif(F.upper(F.trim(F.regexp_extract(own, p, 0))), F.lit("")) for p in HEADS]
    by_strategy = [F.nullif(F.upper(place(own, strategy)), F.lit(""))] if strategy else []
    return F.coalesce(*by_strategy, known, *heads, F.lit(""))
