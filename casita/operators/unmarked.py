"""Issues without marks: listings found by what their lines look like."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casita.functions.text import fold_lower, let, squeeze
from casita.operators.segment import HEADER

_TITLE = r"^[A-ZÁÉÍÓÚÑ][a-záéíóúñ]+$"
_SEPARATORS = r"[\s,;:()\-]+"


@dataclass(frozen=True)
class Gates:
    # Words and patterns of the gates.
    exceptions: tuple[str, ...] = (
        "Mts.", "Mts", "mt2", "m²", "mts", "mts2", "Lps", "Lps.", "L.", "$", "vr2", "vrs", "Vrs", "Vr²", "Vrs²", "area", "área", "baños", "baño", "habitaciones", "hab.", "cubículos", "dormitorios",
        "garaje", "lavandería", "cocina", "sala", "comedor",
    )
    features: tuple[str, ...] = (
        "amueblado", "semiamueblado", "incluye", "con", "sin", "oferta", "promocion", "baño", "baños", "hab", "habitaciones", "rec", "dormitorios", "m2", "m²", "mts", "garaje", "cochera", "terraza",
        "jardin", "patio", "sala", "comedor",
    )
    family: tuple[str, ...] = ("Res.", "Col.", "Colonia", "Barrio", "Bo.")
    connectors: tuple[str, ...] = ("de", "del", "la", "las", "los", "y", "el")
    months: str = "enero|febrero|marzo|abril|mayo|junio|julio|agosto|septiembre|setiembre|octubre|noviembre|diciembre"
    price: str = r"(?:Lps\.|\$)\s?\d{1,3}(?:[.,]\d{3})*(?:[.,]\d{2})?"
    area_first: str = r"^\s*\d+(?:[.,]\d+)?\s*(?:m2|mts?2?|vr2|vrs2?)\b"
    currency_first: str = r"^\s*(?:US\$|\$|Lps\.?|L\.)\s*\d"
    head_chars: int = 60
    price_chars: int = 320
    family_tokens: int = 7
    #: Names of places that count like capitalized words.
    names: tuple[str, ...] = ()


def _folded(words: tuple[str, ...]) -> list[str]:
    import unicodedata

    plain = lambda w: "".join(c for c in unicodedata.normalize("NFKD", w.lower()) if not unicodedata.combining(c))
    return sorted({plain(w) for w in words} | {w.lower() for w in words})


def unmarked_start(line: Column, g: Gates = Gates()) -> Column:
    """Whether a line begins a listing. Lines that begin with an amount, an area, a feature or an exception do not; those
    that begin with a dated name, a family of places and a name, two capitalized words, or have an early price and a
    capitalized word near their start do."""
    known = [*_folded(g.names)] or [""]
    title = lambda t: t.rlike(_TITLE) | fold_lower(t).isin(*known)
    feature = lambda t: fold_lower(t).isin(*_folded(g.features))
    link = lambda t: fold_lower(t).isin(*_folded(g.connectors))
    words = lambda t: F.filter(F.split(t, _SEPARATORS), lambda w: (w != "") & ~link(w))
    head = F.substring_index(fold_lower(line), " ", 1)
    stopped = head.isin(*_folded(g.exceptions), *_folded(g.features)) | line.rlike(g.currency_first) | fold_lower(line).rlike(g.area_first)
    dated = line.rlike(rf"(?iu)^[\s\"'“”‘’]*\d{{1,2}}(?:º|ro|er)?\s+(?:de|del)\s+(?:{g.months})\b")
    family = rf"^\s*(?:{'|'.join(re.escape(t) for t in sorted(g.family, key=len, reverse=True))})"
    numeral = lambda t: fold_lower(t).rlike(r"^(?:i{1,3}|iv|v|vi|vii|viii|ix|x|\d{1,2})$")
    named = lambda ws: F.get(F.transform(F.filter(ws, lambda w: title(w) | numeral(w) | feature(w)), lambda w: title(w) | numeral(w)), 0)
    tail = F.filter(F.slice(F.split(F.trim(F.regexp_replace(line, family, "")), _SEPARATORS), 1, g.family_tokens), lambda w: (w != "") & ~link(w))
    burst = lambda ws: F.coalesce(title(F.get(ws, 0)) & ~feature(F.get(ws, 0)) & title(F.get(ws, 1)) & ~feature(F.get(ws, 1)), F.lit(False))
    near = F.substring(line, 1, g.head_chars)
    priced = F.substring(line, 1, g.price_chars).rlike(g.price) & near.rlike(r"(?U)\b[A-ZÁÉÍÓÚÑ][a-záéíóúñ]+\b")
    return ~stopped & (dated | (line.rlike(family) & F.coalesce(let(tail, named), F.lit(False))) | let(words(near), burst) | priced)


def unmarked_listings(lines: DataFrame, g: Gates = Gates()) -> DataFrame:
    """(file, block_no, kind, text, line_numbers, change) of headers and listings in order.

    A line that starts nothing joins the open listing. Without one it opens one itself if it holds a price and a capitalized
    word near its start, else it is left out. Listings without a price are left out; headers stay as they are. `change` is
    what was done: header_verbatim, glued_lines or whitespace_collapsed_only.
    """
    line = F.col("line")
    rows = lines.where(F.trim(line) != "").withColumn("__header", line.rlike(HEADER)).withColumn("__price", line.rlike(g.price))
    rows = rows.withColumn("__start", ~F.col("__header") & unmarked_start(line, g))
    by_file = Window.partitionBy("file").orderBy("line_no")
    rows = rows.withColumn("__section", F.sum(F.col("__header").cast("int")).over(by_file))
    section = Window.partitionBy("file", "__section").orderBy("line_no")
    soft = ~F.col("__header") & ~F.col("__start") & F.col("__price") & F.substring(line, 1, g.head_chars).rlike(r"(?U)\b[A-ZÁÉÍÓÚÑ][a-záéíóúñ]+\b")
    rows = rows.withColumn("__soft", soft & (F.sum(F.col("__start").cast("int")).over(section) == 0))
    first_soft = F.col("__soft") & (F.sum(F.col("__soft").cast("int")).over(section) == 1)
    rows = rows.withColumn("__open", F.col("__start") | first_soft)
    rows = rows.withColumn("__own", F.sum(F.col("__open").cast("int")).over(section)).where("__header OR __own > 0")
    rows = rows.withColumn("block_no", F.sum((F.col("__header") | F.col("__open")).cast("int")).over(by_file))
    row = F.struct("line_no", "line", "__header", "__price")
    blocks = rows.groupBy("file", "block_no").agg(F.array_sort(F.collect_list(row)).alias("rows"))
    header = F.get("rows", 0)["__header"]
    text = F.when(header, F.get("rows", 0).line).otherwise(squeeze(F.array_join(F.transform("rows", lambda r: r.line), " ")))
    change = F.when(header, "header_verbatim").when(F.size("rows") > 1, "glued_lines").otherwise("whitespace_collapsed_only")
    kept = blocks.where(header | F.exists("rows", lambda r: r["__price"]))
    out = kept.select("file", F.when(header, "header").otherwise("listing").alias("kind"), text.alias("text"), F.transform("rows", lambda r: r.line_no).alias("line_numbers"), change.alias("change"), F.col("block_no").alias("__b"))
    return out.withColumn("block_no", F.row_number().over(Window.partitionBy("file").orderBy("__b"))).drop("__b")
