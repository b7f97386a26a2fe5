"""Lookup joins: validated rates, last-wins dictionaries, mnemonics, containment, ids by configuration."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casita.functions.text import date, fold_lower, half_even, squeeze


def unique_by(df: DataFrame, keys: list[str]) -> DataFrame:
    """df, or an error that names repeated keys (a many-to-one join needs one row a key)."""
    if bad := df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1").limit(5).collect():
        raise ValueError(f"repeated keys: {bad}")
    return df


def rate_join(df: DataFrame, rates: DataFrame, on: str, price: str = "price", currency: str = "currency", base: str = "HNL", to: str = "USD", on_missing: str = "null") -> DataFrame:
    """Price in `to` by the rate of the same month or day; own currency has rate 1.

    rates (on, base, quote, rate) must have one row a key for the pair; what else it holds is ignored. Missing rates give
    null or, on request, an error. Rounded half to even at two digits.
    """
    pair = unique_by(rates.where((F.col("base") == base) & (F.col("quote") == to)).select(on, "rate"), [on])
    out = df.join(pair, on, "left")
    own, other = F.col(currency) == to, F.col(currency) == base
    used = F.when(own, 1.0).when(other, F.col("rate"))
    out = out.withColumns({f"price_{to.lower()}": half_even(F.col(price) * used), "fx_rate_used": used, "fx_method": F.when(own, "identity").when(other & F.col("rate").isNotNull(), on)})
    if on_missing == "error" and (bad := out.where(F.col(price).isNotNull() & used.isNull()).limit(5).collect()):
        raise ValueError(f"no rate for {bad}")
    return out


def last_wins(catalog: DataFrame, key: Column, order: str, values: list[str]) -> DataFrame:
    """One row a key, the values of its last row by order; null keys go. Combines on the map side."""
    return catalog.where(key.isNotNull()).groupBy(key.alias("key")).agg(F.max_by(F.struct(*values), F.col(order)).alias("v")).select("key", *[F.col(f"v.{v}") for v in values])


def catalog_match(df: DataFrame, column: str, catalog: DataFrame, alias: str, order: str, values: list[str]) -> DataFrame:
    """Df with the values of the catalog row whose alias equals the column (upper, trimmed), last row wins, and `matched`."""
    norm = lambda c: F.nullif(F.upper(F.trim(c)), F.lit(""))
    own = last_wins(catalog, norm(F.col(alias)), order, values).withColumn("__hit", F.lit(True))
    out = df.withColumn("__key", norm(F.col(column))).join(own, F.col("__key") == F.col("key"), "left")
    return out.withColumn("matched", F.coalesce("__hit", F.lit(False))).drop("key", "__key", "__hit")


def mnemonic(df: DataFrame, agency: Column, names: DataFrame, fallback: Column | None = None) -> DataFrame:
    """Df with `mnemonic` by agency key; names (key, mnemonic) one row a key; a slug, or null, where there is none."""
    out = df.withColumn("__key", agency).join(unique_by(names, ["key"]), F.col("__key") == F.col("key"), "left").drop("key", "__key")
    return out.withColumn("mnemonic", F.coalesce("mnemonic", fallback)) if fallback is not None else out


def without_partner(df: DataFrame, other: DataFrame, on: str) -> DataFrame:
    """Distinct values of `on` that other lacks, in order."""
    return df.select(on).distinct().join(other.select(on).distinct(), on, "left_anti").orderBy(on)


def contained_alias(texts: DataFrame, text: str, aliases: DataFrame) -> DataFrame:
    """Texts with `alias_ord`, the first (by ord) of the aliases (ord, alias) that stands in the text as whole words.

    Aliases are met by an equi-join on the word runs of the texts, of the lengths that the list has, so no text is compared
    to the whole list. Whole words only: an alias inside a longer word is no match.
    """
    words = F.filter(F.split(F.upper(F.trim(F.col(text))), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    lengths = [r.n for r in aliases.select(F.size(F.filter(F.split(F.trim("alias"), r"[^\p{L}\p{N}]+"), lambda w: w != "")).alias("n")).where("n > 0").distinct().collect()]
    runs = F.flatten(F.transform(F.array(*[F.lit(n) for n in sorted(lengths) or [1]]), lambda n: F.transform(F.sequence(F.lit(1), F.greatest(F.size("__w") - n + 1, F.lit(1))), lambda i: F.array_join(F.slice("__w", i, n), " "))))
    key = F.array_join(F.filter(F.split(F.upper(F.trim("alias")), r"[^\p{L}\p{N}]+"), lambda w: w != ""), " ")
    rows = texts.withColumn("__id", F.xxhash64(F.col(text))).withColumn("__w", words)
    each = rows.select(F.col(text).alias("__text"), "__id", F.explode(F.array_distinct(runs)).alias("run")).distinct()
    hit = each.join(aliases.select("ord", key.alias("run")).where("run <> ''"), "run").groupBy("__text").agg(F.min("ord").alias("alias_ord"))
    return rows.drop("__id", "__w").join(hit, F.col(text) == F.col("__text"), "left").drop("__text")


def agency_mnemonic(df: DataFrame, agency: str, configs: DataFrame, stop: tuple[str, ...] = ("inmobiliaria", "agencia", "agency")) -> DataFrame:
    """Df with `mnemonic`, upper, of the configuration (name, mnemonic) of its agency; an error names agencies without one.

    Names are compared without accents, lower, with single spaces, with and without "agency_" or "cfg_" before them and
    with hyphens as spaces; then without the words in stop. Of configurations with one key the first by name counts.
    """
    key = lambda c: squeeze(fold_lower(c))
    name = F.lower("name")
    forms = F.array(name, F.regexp_replace(name, "^agency_", ""), F.regexp_replace(name, "^cfg_", ""), F.replace(name, F.lit("-"), F.lit(" ")))
    known = configs.select("name", "mnemonic", F.explode(F.array_distinct(F.transform(forms, key))).alias("key")).groupBy("key").agg(F.min_by(F.upper(F.trim("mnemonic")), "name").alias("m"))
    rows = df.withColumn("__key", key(F.coalesce(F.col(agency).cast("string"), F.lit(""))))
    short = key(F.regexp_replace("__key", r"\b(?:" + "|".join(stop) + r")\b", " "))
    first = known.select(F.col("key").alias("__k1"), F.col("m").alias("__m1"))
    second = known.select(F.col("key").alias("__k2"), F.col("m").alias("__m2"))
    out = rows.withColumn("__short", short).join(first, F.col("__key") == F.col("__k1"), "left").join(second, F.col("__short") == F.col("__k2"), "left")
    found = F.coalesce("__m1", "__m2")
    missing = F.raise_error(F.concat(F.lit("no configuration for agency "), F.col("__key")))
    return out.withColumn("mnemonic", F.coalesce(found, missing.cast("string"))).drop("__key", "__short", "__k1", "__k2", "__m1", "__m2")


def sequence_uid(df: DataFrame, agency: str, day: str, number: str, configs: DataFrame, name: str = "listing_uid") -> DataFrame:
    """T4: df with the id MNEMONIC-yyyymmdd-number, from a number that the rows bring, first; empty without a number. A
    table that has the id already stays as it is; a date that cannot be read is an error."""
    if name in df.columns:
        return df
    rows = agency_mnemonic(df, agency, configs)
    own = F.trim(F.coalesce(F.col(number).cast("string"), F.lit("")))
    text = F.date_format(date(F.col(day).cast("string")), "yyyyMMdd")
    text = F.coalesce(text, F.raise_error(F.concat(F.lit("no date: "), F.coalesce(F.col(day).cast("string"), F.lit("null")))).cast("string"))
    return rows.select(F.when(own == "", "").otherwise(F.concat_ws("-", "mnemonic", text, own)).alias(name), *df.columns)
