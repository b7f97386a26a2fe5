"""A simple parser of marked or unmarked lists (X14, G17, X25): all prices of a listing, areas in varas and manzanas, rooms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casita.functions.text import let, number, squeeze

# Square metres of a square vara and of a manzana, and the patterns.
VARA_M2, MANZANA_M2 = 0.6989, 6987.0
_AMOUNT = r"\d[\d.,\s]*"
_MONEY = rf"(?i)(LPS\.?|L\.?|\$)?\s*({_AMOUNT})"
_PER_VARA = rf"(?i)(LPS\.?|L\.?|\$)\s*({_AMOUNT})\s*(?:LA\s*)?V[²2](?![\w])"
_VARAS = r"(?i)\b(\d+(?:[¼½¾]|/\d+)?)\s*V[²2](?![\w])"
_MANZANAS = r"(?i)\b(\d+(?:[¼½¾]|/\d+)?)\s*MANZANAS?\b"
_BEDS = r"(?i)\b(\d{1,2})\s*(?:HABIT|HAB|HABS|DORM)\b"
_BATHS = r"(?iu)\b(\d{1,2}(?:\.\d)?)\s*(?:BAÑOS|BANOS|BAÑO|BANO)(?![\wñÑ])"
_BULLET = r"^\s*[*\-•]\s*(.+)$"
_SPREAD = r"(?<![\wÁÉÍÓÚÜÑ])(?:[A-ZÁÉÍÓÚÜÑ](?![\wÁÉÍÓÚÜÑáéíóúüñ])[.\s]*){2,}"
_LEADS = ("CASA ", "APTO ", "APARTAMENTO ", "APART ", "LOCAL ", "OFICINA ", "OFICINAS ")


def close_spread(x: Column) -> Column:
    """Spread capitals become a word: C A S A is CASA; what stands between and after them goes."""
    parts = F.struct(F.split(x, _SPREAD, -1).alias("gaps"), F.regexp_extract_all(x, F.lit(_SPREAD), F.lit(0)).alias("runs"))
    joined = lambda p: F.array_join(F.transform(p.gaps, lambda g, i: F.concat(g, F.coalesce(F.regexp_replace(F.get(p.runs, i), r"[.\s]", ""), F.lit("")))), "")
    return F.when(x.rlike(_SPREAD), let(parts, joined)).otherwise(x)


def fixed_number(raw: Column) -> Column:
    """Two digits after the last separator are decimals, all other separators go: 6, 000.00 is 6000."""
    s = F.regexp_replace(raw, r"(?<=\d)\s+(?=[\d,.])|\s+$", "")
    digits = F.regexp_replace(s, r"\D", "")
    cents = s.rlike(r"[.,]\D*\d\D*\d\D*$") & ~s.rlike(r"[.,]\D*\d\D*\d\D*\d\D*$")
    whole = F.length(digits) - 2
    spelled = F.when(cents, F.concat(F.lit("0"), F.substring(digits, F.lit(1), whole), F.lit("."), F.substring(digits, whole + 1, F.lit(2)))).otherwise(digits)
    return F.coalesce(let(spelled, number), F.lit(0.0))


def moneys(text: Column) -> Column:
    """array of (currency, amount, at): all amounts above zero; those without a currency take the first one that is named."""

    def read(p: Column) -> Column:
        one = lambda m, i: F.struct(F.upper(F.regexp_extract(m, _MONEY, 1)).alias("c"), fixed_number(F.regexp_extract(m, _MONEY, 2)).alias("amount"), F.length(F.concat(F.array_join(F.slice(p.gaps, F.lit(1), i + 1), ""), F.array_join(F.slice(p.hits, F.lit(1), i), ""))).alias("at"))
        return F.filter(F.transform(p.hits, one), lambda r: r.amount > 0)

    def named(rows: Column) -> Column:
        code = lambda r: F.when(F.contains(r.c, F.lit("$")), "USD").when(F.contains(r.c, F.lit("L")), "HNL")
        first = F.get(F.array_compact(F.transform(rows, code)), 0)
        return let(first, lambda f: F.transform(rows, lambda r: F.struct(F.coalesce(code(r), f, F.lit("")).alias("currency"), r.amount.alias("amount"), r["at"].alias("at"))))

    hits = F.struct(F.split(text, _MONEY, -1).alias("gaps"), F.regexp_extract_all(text, F.lit(_MONEY), F.lit(0)).alias("hits"))
    return let(let(hits, read), named)


def fraction(x: Column) -> Column:
    """¼, ½, ¾ and a/b as numbers."""
    t = squeeze(F.regexp_replace(F.regexp_replace(F.regexp_replace(x, "¼", " 1/4"), "½", " 1/2"), "¾", " 3/4"))
    top, bottom = number(F.substring_index(t, "/", 1)), number(F.substring_index(t, "/", -1))
    return F.when(F.contains(t, F.lit("/")), top / F.nullif(bottom, F.lit(0.0))).otherwise(number(t))


def scalars(text: Column) -> Column:
    """(raw, title, prices, per_v2, per_v2_currency, manzanas, varas, area_m2, bedrooms, bathrooms) of a listing's text."""
    group = lambda t, p, k=1: F.nullif(F.regexp_extract(t, p, k), F.lit(""))

    def read(s: Column) -> Column:
        varas, manzanas = fraction(group(s, _VARAS)), fraction(group(s, _MANZANAS))
        per = F.upper(F.regexp_extract(s, _PER_VARA, 1))

        def made(m: Column) -> Column:
            before = F.when(F.size(m) > 0, F.substring(s, F.lit(1), F.get(m, 0)["at"])).otherwise(s)
            return F.struct(
                s.alias("raw"), F.when(F.size(m) > 0, squeeze(F.regexp_replace(before, r"^[\s,.\-]+|[\s,.\-]+$", ""))).otherwise(s).alias("title"),
                F.transform(m, lambda x: F.struct(x.currency.alias("currency"), x.amount.alias("amount"))).alias("prices"),
                F.when(per != "", fixed_number(F.regexp_extract(s, _PER_VARA, 2))).alias("per_v2"), F.when(per != "", F.when(F.contains(per, F.lit("$")), "USD").otherwise("HNL")).alias("per_v2_currency"),
                manzanas.alias("manzanas"), varas.alias("varas"), F.coalesce(varas * VARA_M2, manzanas * MANZANA_M2).alias("area_m2"), group(s, _BEDS).alias("bedrooms"), group(s, _BATHS).alias("bathrooms"),
            )

        return let(moneys(s), made)

    return let(squeeze(close_spread(F.coalesce(text, F.lit("")))), read)


def place_and_type(title: Column) -> Column:
    """(neighborhood, property_type): a kind of property that leads the title goes, and names the type."""
    up = F.upper(title)
    place = F.coalesce(*[F.when(up.startswith(lead), F.trim(F.substring(title, F.lit(len(lead) + 1), F.length(title)))) for lead in _LEADS], title)
    kind = F.when(up.startswith("CASA "), "House").when(up.startswith("APTO ") | up.startswith("APART"), "Apartment").when(up.rlike("LOCAL|OFICINA"), "Commercial")
    return F.struct(place.alias("neighborhood"), kind.when(F.array_contains(F.slice(F.split(up, r"\s+"), 1, 2), "CASA"), "House").otherwise("").alias("property_type"))


def simple_listings(lines: DataFrame) -> DataFrame:
    """(file, listing_no, category, s) of files (file, line_no, line): where a file has a bullet, bullets begin listings
    and other lines go to their raw text; else a line with an amount after a letter does. Headers name the category."""
    by_file = Window.partitionBy("file").orderBy("line_no")
    rows = lines.where(F.trim("line") != "").withColumn("__head", F.upper(squeeze(F.nullif(F.regexp_extract("line", r"^\s*#\s*(.+?)\s*$", 1), F.lit("")))))
    rows = rows.withColumn("__bullets", F.max(F.col("line").rlike(_BULLET)).over(Window.partitionBy("file")))
    money = F.regexp_instr("line", F.lit(_MONEY))
    letters = (money > 1) & F.substring("line", F.lit(1), money - 1).rlike(r"\p{L}")
    head = F.col("__head").isNotNull()
    rows = rows.withColumn("__start", ~head & F.when(F.col("__bullets"), F.col("line").rlike(_BULLET)).otherwise(letters | F.coalesce(F.lag(head).over(by_file), F.lit(True))))
    rows = rows.withColumn("category", F.coalesce(F.last("__head", ignorenulls=True).over(by_file), F.lit(""))).withColumn("__n", F.sum(F.col("__start").cast("int")).over(by_file))
    own = rows.where(~head & (F.col("__n") > 0)).groupBy("file", "__n", "__bullets").agg(F.array_sort(F.collect_list(F.struct("line_no", "line", "category"))).alias("r"))
    bare = F.regexp_replace(F.get("r", 0).line, r"^\s*[*\-•]\s*", "")
    whole = F.array_join(F.transform("r", lambda x: x.line), " ")
    read = own.select("file", F.col("__n").alias("listing_no"), F.get("r", 0).category.alias("category"), scalars(F.when(F.col("__bullets"), bare).otherwise(whole)).alias("s"), F.when(F.col("__bullets"), F.array_join(F.transform(F.slice("r", F.lit(2), F.size("r")), lambda x: squeeze(close_spread(x.line))), " ")).alias("more"))
    return read.withColumn("s", F.col("s").withField("raw", squeeze(F.concat_ws(" ", F.col("s.raw"), F.col("more"))))).drop("more")


def simple_rows(listings: DataFrame, agency: str, date: str) -> DataFrame:
    """Simple listings in the columns of a listings table; the first price counts."""
    place, first = place_and_type(F.col("s.title")), F.get("s.prices", 0)
    return listings.select(
        "file", F.col("listing_no").alias("ListingID"), F.col("s.title").alias("title"), place.neighborhood.alias("neighborhood"), F.col("s.bedrooms").alias("bedrooms"), F.col("s.bathrooms").alias("bathrooms"), F.col("s.per_v2").alias("AT"),
        F.when(F.col("s.per_v2").isNotNull(), "V2").alias("AT_unit"), F.coalesce("s.varas", "s.manzanas").alias("area"), F.when(F.col("s.varas").isNotNull(), "V2").when(F.col("s.manzanas").isNotNull(), "MANZANA").alias("area_unit"),
        F.round("s.area_m2", 2).alias("area_m2"), first.amount.alias("price"), first.currency.alias("currency"), F.when(F.contains("category", F.lit("ALQUILER")), "Rent").otherwise("Sale").alias("transaction"),
        place.property_type.alias("property_type"), F.lit(agency).alias("agency"), F.lit(date).alias("date"), F.col("s.raw").alias("notes"),
    )
