"""Rule engines: property-type scores, transaction decisions, rejection causes."""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casita.functions.text import cell, fold_lower, let

# Words and patterns of the property-type rules.
TERMS = {
    "house": ["casa", "casas", "residencia", "residencias", "familiar", "familiares", "vivienda", "viviendas", "townhouse", "condominio", "condominios"],
    "apt": ["apartamento", "apartamentos", "apartament", "departamento", "departamentos", "apto", "aptos", "condominio", "condominios", "penthouse"],
    "bedroom": ["habitacion", "hab", "ha", "habitaciones", "habit", "recamara", "recamaras", "dormitorio", "dormitorios", "alcoba", "alcobas", "cuartos", "cuarto"],
    "rooms": ["sala", "salas", "comedor", "comedo", "cocina", "terraza", "familiar", "oficina", "lavanderia", "patio", "estudio"],
    "amenity": ["balcon", "piscina", "gimnasio", "areas comunes", "walk closet", "cuarto de empleada", "elevador", "area verde"],
    "apt_adj": ["nuevo", "amueblado", "amplio", "edificio", "centrico", "preciosos", "equipado", "semiamueblado"],
    "house_adj": ["nivel", "niveles", "planta", "plantas", "amplia", "nueva", "moderna", "peatonal", "amueblada", "jardin", "salas"],
    "construction": ["construccion", "construida", "construido", "area construida", "edificada", "edificado", "plantas", "finos acabados"],
    "land": ["terreno", "lote", "lotes", "solar", "parcela", "finca", "manzana", "manzanas"],
    "area": ["m2", "mts2", "mts", "metros", "vrs2", "vara", "varas"],
    "unit": [
        "local comercial", "locales comerciales", "salon", "salones", "oficina", "oficinas", "oficina medica", "oficinas medicas", "colegio", "colegios", "edificio", "hotel", "hoteles",
        "clinica", "clinicas", "galeria", "galerias", "nave industrial", "naves industriales", "plaza comercial", "plazas comerciales", "kiosco", "kioscos",
    ],
    "bodega": ["bodega", "ofi-bodega"],
    "corporate": ["corporativo", "edificio corporativo", "edificio comercial"],
    "comm_use": ["comercial", "coworking", "co-working"],
    "comm_amenity": ["ascensor", "elevador", "lobby", "recepcion", "seguridad", "vigilancia", "fibra optica", "planta electrica", "estacionamiento", "parqueos", "parqueo"],
    "partial": ["obra gris", "media construccion", "sin terminar"],
    "plantel": ["plantel"],
    "use_phrase": ["ideal para oficina", "ideal para oficinas", "excelente para negocio", "excelente para negocios", "apto para oficina", "apto para oficinas", "apto para negocio", "apto para negocios", "apto para comercio", "ideal para comercio", "ideal para comercial"],
}
PATTERNS = {
    "zero_bed": r"\b(habitaciones?|hab(?:s)?|bedrooms?)\s*(?:=|:)?\s*0\b",
    "price_m2": r"\$\s*\d+(?:[.,]\d+)?\s*(?:x|por)\s*m2",
    "area_m2": r"\b\d+(?:[.,]\d+)?\s*(?:m2|mts?2?|metros?\s+cuadrados?)\b",
    "area_varas": r"\b\d+(?:[.,]\d+)?\s*(?:vara(?:s)?(?:\s+cuadrada(?:s)?)?|v(?:rs)?\s*2)\b",
    "dim_x": r"\b\d{1,3}\s*[x×]\s*\d{1,3}\s*m(?:t|ts|trs)?\b",
    "unit_price_x": r"(?:u\$|usd|\$)\s*\d+(?:[.,]\d+)?(?:\s*\+\s*[a-z]{1,10})?\s*[x×]\s*(?:mts?\s*2|metros?\s*2|metros|mts?|m\s*2|m)\.?(?:[^a-z0-9]|$)",
    "land_unit_price": r"\b\d+(?:[.,]\d+)?\s*(?:por|/|x|×)\s*(?:v(?:rs)?\s*2|vara(?:s)?(?:\s+cuadrada(?:s)?)?)|\b\d+(?:[.,]\d+)?\s*(?:v(?:rs)?\s*2|vara(?:s)?(?:\s+cuadrada(?:s)?)?)\s*(?:a|x|×)\s*(?:\$|l\.?)?\s*\d+",
    "bodega_text": r"\bbodega\b",
}
TYPES = ("House", "Apartment", "Commercial", "Land")
#: Points by cue: (House, Apartment, Commercial, Land).
POINTS = {
    "apt": (0, 10, 0, -15), "apt_adj": (-5, 10, 0, 0), "bedroom": (6, 2, -3, -15), "amenity": (1, 4, -3, 0), "area": (0, 3, 0, 10), "area_m2": (0, 3, 0, 0),
    "land": (0, -6, 0, 10), "dim_x": (-5, -3, 5, 0), "area_varas": (0, -10, 0, 0), "house_adj": (5, -5, 0, 0), "house": (10, 0, 0, 0), "rooms": (2, 0, 0, 0),
    "zero_bed": (-5, 0, 0, 0), "bodega": (-5, 0, 5, 0), "bodega_text": (0, 0, 5, 0), "unit_price_x": (-5, 0, 5, 0), "land_unit_price": (-5, 0, 0, 10),
    "use_phrase": (0, 0, 5, 0), "unit": (0, 0, 10, 0), "corporate": (0, 0, 2, 0), "comm_amenity": (0, 0, 2, 0), "plantel": (0, 0, 8, 0), "comm_use": (0, 0, 3, 0), "construction": (0, 0, 0, -5),
}
#: Points for two cues together (a third, negated, after a minus sign).
JOINT_POINTS = {("apt", "comm_use"): (0, -15, 0, 0), ("house", "comm_use"): (-15, 0, 0, 0), ("comm_use", "zero_bed"): (0, 0, 8, 0)}


def _any_word(words: list[str]) -> str:
    return r"\b(?:" + "|".join(re.escape(w) for w in sorted(words, key=lambda w: (-len(w), w))) + r")\b"


def _capitalized(x: Column) -> Column:
    """The first letter upper, the rest lower."""
    return F.concat(F.upper(F.substring(x, 1, 1)), F.lower(F.substring(x, F.lit(2), F.length(x))))


def property_scores(df: DataFrame, text: Column, original: Column) -> DataFrame:
    """df with property_type_new, _reason, _changed, the four scores, margin and tie.

    Each pattern is searched once, as a boolean column; scores are sums of points. A plantel cue sets what House and
    Apartment have from the prior and the unit price to nothing, then the other points are added. No cue or a tie keeps
    the original type; so do dormitories and buildings that are not finished.
    """
    searched = {**{k: _any_word(v) for k, v in TERMS.items()}, **PATTERNS}
    df = df.withColumn("__text", fold_lower(text)).withColumn("__original", _capitalized(F.trim(F.coalesce(original, F.lit("")))))
    df = df.withColumns({f"__{k}": F.col("__text").rlike(p) for k, p in searched.items()})
    cue = lambda k: F.col(f"__{k}")
    point = lambda hit, n: F.when(hit, n).otherwise(0)
    scores = {}
    for i, kind in enumerate(TYPES):
        prior = point(F.col("__original") == kind, 11 if kind == "Apartment" else 6) + point(cue("price_m2"), (-5, -2, 3, 2)[i])
        if i < 2:
            prior = F.when(cue("plantel"), 0).otherwise(prior)
        own = [point(cue(k), p[i]) for k, p in POINTS.items() if p[i]] + [point(cue(a) & cue(b), p[i]) for (a, b), p in JOINT_POINTS.items() if p[i]]
        if kind == "House":
            own.append(point((cue("area") | cue("area_m2")) & cue("house"), 5))
        if kind == "Land":
            own.append(point(cue("area") & ~cue("house"), 5))
        scores[f"score_{kind.lower()}"] = reduce(lambda a, b: a + b, own, prior)
    df = df.withColumns(scores)
    ranked = F.reverse(F.array_sort(F.array(*[F.col(c) for c in scores])))
    best = F.get(ranked, 0)
    winners = F.array_compact(F.array(*[F.when(F.col(f"score_{k.lower()}") == best, k) for k in TYPES]))
    df = df.withColumns({"margin": best - F.get(ranked, 1), "tie": F.size(winners) > 1, "__winners": winners, "__best": best})
    new = F.when(F.col("__original") == "Dorms", "Dorms").when(cue("partial"), "Partial_Construction").when((F.col("__best") == 0) | F.col("tie"), F.col("__original")).otherwise(F.get("__winners", 0))
    reason = (
        F.when(F.col("__original") == "Dorms", "KEEP:ORIGINAL_DORMS")
        .when(cue("partial"), "KEEP:PARTIAL_CONSTRUCTION")
        .when(F.col("__best") == 0, "KEEP:NO_CUES")
        .when(F.col("tie"), F.concat(F.lit("KEEP:TIE("), F.array_join("__winners", "|"), F.lit(")")))
        .otherwise(F.format_string("POINTS:%s(%d)", F.get("__winners", 0), F.col("__best")))
    )
    df = df.withColumns({"property_type_new": new, "property_type_reason": reason}).withColumn("property_type_changed", F.col("property_type_new") != F.col("__original"))
    return df.drop("__text", "__original", "__winners", "__best", *[f"__{k}" for k in searched])


@dataclass(frozen=True)
class TransactionRules:
    # Price bounds and words.
    min_price: dict = field(default_factory=lambda: {"APARTMENT": 50, "HOUSE": 60})
    rent_max: dict = field(default_factory=lambda: {"APARTMENT": 10_000, "HOUSE": 20_000})
    sale_min: dict = field(default_factory=lambda: {"APARTMENT": 15_000, "HOUSE": 15_000})
    sale_words: tuple[str, ...] = ("venta", "en venta", "se vende", "sale", "for sale")
    rent_words: tuple[str, ...] = ("alquiler", "renta", "se alquila", "rent", "for rent")
    ambiguous: tuple[str, ...] = (r"venta\s+o\s+renta", r"renta\s+o\s+venta", r"alquiler\s+o\s+venta")


def notes_signal(notes: Column, rules: TransactionRules) -> Column:
    """SALE, RENT, AMBIGUOUS or NONE."""

    def found(t: Column) -> Column:
        words = lambda ws: t.rlike(_any_word(list(ws)))
        return F.struct(words(rules.sale_words).alias("sale"), words(rules.rent_words).alias("rent"), t.alias("t"))

    def named(f: Column) -> Column:
        return F.when((f.sale & f.rent) | f.t.rlike("|".join(rules.ambiguous)), "AMBIGUOUS").when(f.sale, "SALE").when(f.rent, "RENT").otherwise("NONE")

    return let(let(F.lower(F.trim(F.coalesce(notes, F.lit("")))), found), named)


def transaction_decision(ptype: Column, declared: Column, notes: Column, price: Column, rules: TransactionRules = TransactionRules()) -> Column:
    """F16: (final, flag, polarity, source, confidence); the first rule that applies decides."""
    bound = lambda kind, d: F.coalesce(*[F.when(kind == k, F.lit(float(v))) for k, v in d.items()])
    row = lambda *v: F.struct(*[x.alias(n) if isinstance(x, Column) else F.lit(x).cast("string").alias(n) for n, x in zip(("final", "flag", "polarity", "source", "confidence"), v, strict=True)])
    corrected = ("CORRECTED_PRICE_BOUNDARY", "POSITIVE", "price+ptype", "HIGH")
    read = F.struct(F.upper(F.trim(ptype)).alias("kind"), F.upper(F.trim(declared)).alias("said"), notes_signal(notes, rules).alias("signal"), price.alias("price"))

    def weighed(x: Column) -> Column:
        has, noted = F.coalesce(x.said.isin("SALE", "RENT"), F.lit(False)), x.signal.isin("SALE", "RENT")
        return F.struct(
            F.when(has, x.said).when(noted, x.signal).alias("hint"),
            F.when(has, "declared").when(noted, "notes").otherwise("none").alias("source"),
            F.when(has, "HIGH").when(noted, "MEDIUM").otherwise("LOW").alias("confidence"),
            (x.price <= bound(x.kind, rules.rent_max)).alias("rent_ok"),
            (x.price >= bound(x.kind, rules.sale_min)).alias("sale_ok"),
            F.coalesce(x.kind.isin(*rules.min_price), F.lit(False)).alias("in_scope"),
            (x.price.isNull() | (x.price < bound(x.kind, rules.min_price))).alias("no_price"),
        )

    def decided(y: Column) -> Column:
        rent, sale = y.hint == "RENT", y.hint == "SALE"
        return (
            F.when(~y.in_scope, row(None, "FLAG_OUT_OF_SCOPE", "NEGATIVE", "scope", "NONE"))
            .when(y.no_price, row(None, "REMOVED_INVALID_PRICE", "NEGATIVE", "price_min", "NONE"))
            .when((rent & y.rent_ok) | (sale & y.sale_ok), row(y.hint, "OK_DECLARED", "POSITIVE", y.source, y.confidence))
            .when(sale & y.rent_ok, row("RENT", *corrected))
            .when(rent & y.sale_ok, row("SALE", *corrected))
            .otherwise(row(None, "REMOVED_PRICE_OUT_OF_RANGE", "NEGATIVE", "price+ptype", "HIGH"))
        )

    return let(let(read, weighed), decided)


def with_causes(df: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """Df with `causes`, the names of the checks that hold, each followed by a semicolon; one pass, no join."""
    return df.withColumn("causes", F.concat(*[F.when(F.coalesce(c, F.lit(False)), f"{name};").otherwise("") for name, c in checks.items()]))


def listed(df: DataFrame, column: str, banned: DataFrame, name: str, mode: str = "exact") -> DataFrame:
    """df with a boolean `name`: whether the column is in the one-column list (lower, single spaces), or contains an entry.

    Exact membership is an equi-join on distinct keys. Substring mode takes the list to the driver: lists are configuration,
    and one of over 10,000 entries is refused.
    """
    key = banned.select(cell(F.col(f"`{banned.columns[0]}`")).alias("__key")).where("__key <> ''").distinct()
    if mode == "exact":
        return df.withColumn("__own", cell(F.col(column))).join(key.withColumn(name, F.lit(True)), F.col("__own") == F.col("__key"), "left").withColumn(name, F.coalesce(name, F.lit(False))).drop("__own", "__key")
    words = [r[0] for r in key.limit(10_001).collect()]
    if len(words) > 10_000:
        raise ValueError("substring lists hold 10,000 entries at most")
    return df.withColumn(name, cell(F.col(column)).rlike("|".join(re.escape(w) for w in sorted(words))) if words else F.lit(False))


def is_no(x: Column) -> Column:
    """false, 0, no or n; null is not."""
    return F.coalesce(F.lower(F.trim(x.cast("string"))).isin("false", "0", "no", "n"), F.lit(False))


def is_yes(x: Column) -> Column:
    """F12."""
    return F.coalesce(F.lower(F.trim(x.cast("string"))).isin("y", "yes", "1", "true", "sí", "si"), F.lit(False))


def require_columns(df: DataFrame, names: list[str]) -> DataFrame:
    """raises when one is missing."""
    if gone := [n for n in names if n not in df.columns]:
        raise ValueError(f"columns are missing: {', '.join(gone)}")
    return df


def require_all(df: DataFrame, ok: Column, message: str) -> DataFrame:
    """raises, with a few examples, when a row fails the predicate."""
    if bad := df.where(~F.coalesce(ok, F.lit(False))).limit(5).collect():
        raise ValueError(f"{message}: {bad}")
    return df


def valid_rows(df: DataFrame, ok: Column, policy: str = "skip", columns: list[str] | None = None) -> DataFrame:
    """rows that fail are left out, raise, or have the named columns set to null."""
    if policy == "skip":
        return df.where(F.coalesce(ok, F.lit(False)))
    if policy == "error":
        return require_all(df, ok, "invalid rows")
    return df.withColumns({c: F.when(ok, F.col(c)) for c in columns or []})
