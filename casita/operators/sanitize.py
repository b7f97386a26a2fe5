"""Sanitizer profiles of rate and listing tables, with counters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casita.functions.text import amount, currency, date, fold_upper_keep_n, sanitize


def with_plain_headers(df: DataFrame, rates: bool = False) -> DataFrame:
    """Column names sanitized; in a table of rates `from` and `to` become base and quote."""
    import unicodedata

    known = {"from": "base", "to": "quote"} if rates else {}
    plain = [" ".join(unicodedata.normalize("NFKC", c).split()) for c in df.columns]
    return df.toDF(*[known.get(c.lower(), c) for c in plain])


def sanitize_rates(df: DataFrame) -> DataFrame:
    """Df with `valid`, and in valid rows an ISO date, currency codes of three letters and a plain rate.

    A row is valid when its date, base, quote and rate can all be read; others keep what they had.
    """
    rows = with_plain_headers(df, rates=True)
    rows = rows.withColumns({"source": sanitize(F.col("source"))}) if "source" in rows.columns else rows
    code = lambda c: F.upper(F.trim(F.col(c)))
    day, rate = F.date_format(date(F.col("date")), "yyyy-MM-dd"), amount(F.col("rate").cast("string"))
    ok = day.isNotNull() & rate.isNotNull() & F.coalesce(code("base").rlike("^[A-Z]{3}$") & code("quote").rlike("^[A-Z]{3}$"), F.lit(False))
    rows = rows.withColumn("__x", F.when(ok, F.struct(day.alias("date"), code("base").alias("base"), code("quote").alias("quote"), rate.cast("string").alias("rate"))))
    kept = {c: F.coalesce(F.col(f"__x.{c}"), F.col(c).cast("string")) for c in ("date", "base", "quote", "rate")}
    return rows.withColumns(kept).withColumn("valid", F.col("__x").isNotNull()).drop("__x")


def sanitize_listings(df: DataFrame, currency_col: str = "currency", date_col: str = "date", amount_col: str | None = "price", accentless: tuple[str, ...] = ()) -> DataFrame:
    """Currency, date and amount made plain where they can be read, else left; <column>_key in upper case without
    accents for the columns named; `changed`, a struct of three booleans. No row is invalid."""
    rows = with_plain_headers(df)
    made = {currency_col: currency(F.col(currency_col)), date_col: F.date_format(date(F.col(date_col)), "yyyy-MM-dd"), amount_col: amount(F.col(amount_col).cast("string")).cast("string") if amount_col else None}
    made = {c: v for c, v in made.items() if c in rows.columns and v is not None}
    names = {currency_col: "currency", date_col: "date", amount_col: "amount"}
    changed = F.struct(*[F.coalesce(v != F.col(c).cast("string"), v.isNotNull()).alias(names[c]) for c, v in made.items()])
    keys = {f"{c}_key": sanitize(fold_upper_keep_n(F.col(c))) for c in accentless if c in rows.columns}
    rows = rows.withColumn("changed", changed).withColumns(keys) if keys else rows.withColumn("changed", changed)
    return rows.withColumns({c: F.coalesce(v, F.col(c).cast("string")) for c, v in made.items()})


def counters(sanitized: DataFrame) -> DataFrame:
    """One row: rows, and how many were invalid, or had their currency, date or amount changed."""
    count = lambda c: F.coalesce(F.sum(c.cast("long")), F.lit(0)).alias
    own = [count(~F.col("valid"))("errors")] if "valid" in sanitized.columns else [count(F.col(f"changed.{c}"))(f"changed_{c}") for c in sanitized.schema["changed"].dataType.names]
    return sanitized.agg(F.count("*").alias("rows"), *own)
