"""As-of joins (J4, J14): the latest rate on or before a date, straight, inverted or over a pivot currency.

Quotes and rows are put in one stream, ordered by pair and date, and the last quote is carried forward by a window. The
window is cut by month within a pair, with each month's opening quote found from a table of one row a pair and month, so
that a pair that holds most rows spreads over its months.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def asof(rows: DataFrame, quotes: DataFrame, by: list[str], at: str, quote_at: str, values: list[str]) -> DataFrame:
    """rows with the values (and quote_at) of the last quote of the same `by` at or before `at`; nulls where there is none.

    Of quotes at one time the one with the greatest values counts.
    """
    month = lambda c: F.date_trunc("month", F.col(c))
    value = F.struct(F.col(quote_at).alias("q_at"), *[F.col(v).alias(f"q_{v}") for v in values])
    quote = quotes.where(F.col(quote_at).isNotNull()).select(*by, F.col(quote_at).alias("t"), month(quote_at).alias("m"), value.alias("q"))
    closing = quote.groupBy(*by, "m").agg(F.max("q").alias("close"))
    # the opening quote of each month that rows or quotes have: the last close of an earlier month
    months = rows.select(*by, month(at).alias("m")).union(quote.select(*by, "m")).distinct().join(closing, [*by, "m"], "left")
    earlier = Window.partitionBy(*by).orderBy("m").rowsBetween(Window.unboundedPreceding, -1)
    opening = months.withColumn("open", F.last("close", ignorenulls=True).over(earlier)).select(*by, "m", "open")
    own = rows.select(*by, F.col(at).alias("t"), month(at).alias("m"), F.lit(None).cast(quote.schema["q"].dataType).alias("q"), F.struct(*rows.columns).alias("row"), F.lit(1).alias("kind"))
    both = own.unionByName(quote.withColumn("kind", F.lit(0)), allowMissingColumns=True)
    w = Window.partitionBy(*by, "m").orderBy("t", "kind", "q").rowsBetween(Window.unboundedPreceding, 0)
    seen = both.withColumn("in_month", F.last("q", ignorenulls=True).over(w)).where("kind = 1").join(opening, [*by, "m"], "left")
    got = F.coalesce("in_month", "open")
    return seen.select("row.*", got.q_at.alias(quote_at), *[got[f"q_{v}"].alias(v) for v in values])


def resolve_rates(rows: DataFrame, quotes: DataFrame, row_id: str, base: str, quote: str, at: str, pivots: tuple[str, ...] = ("USD",)) -> DataFrame:
    """Rows with rate, method (parity, direct, inverse, pivot) and rate_date.

    quotes (base, quote, date, rate). A pivot rate is the product of two legs, each direct, dated by the later one.
    Candidates are joined by as-of on (base, quote); the first that exists is taken.
    """
    legs = [("direct", F.col(base), F.col(quote)), ("inverse", F.col(quote), F.col(base))]
    for p in pivots:
        legs += [(f"{p}1", F.col(base), F.lit(p)), (f"{p}2", F.lit(p), F.col(quote))]
    need = rows.select(row_id, F.col(at).alias("at"), F.explode(F.array(*[F.struct(F.lit(n).alias("leg"), a.alias("base"), b.alias("quote")) for n, a, b in legs])).alias("x")).select(row_id, "at", "x.*")
    got = asof(need, quotes, ["base", "quote"], "at", "date", ["rate"]).groupBy(row_id).agg(F.map_from_entries(F.collect_list(F.struct("leg", F.struct("rate", "date")))).alias("legs"))
    leg: dict[str, Column] = {n: F.col("legs")[n] for n, _, _ in legs}
    pick = lambda rate, method, date: F.struct(rate.cast("double").alias("rate"), F.lit(method).alias("method"), date.alias("rate_date"))
    found = F.when(F.col(base) == F.col(quote), pick(F.lit(1.0), "parity", F.col(at))).when(leg["direct"].rate.isNotNull(), pick(leg["direct"].rate, "direct", leg["direct"].date))
    found = found.when(leg["inverse"].rate != 0, pick(1.0 / F.nullif(leg["inverse"].rate, F.lit(0.0)), "inverse", leg["inverse"].date))
    for p in pivots:
        a, b = leg[f"{p}1"], leg[f"{p}2"]
        usable = a.rate.isNotNull() & b.rate.isNotNull() & (F.col(base) != p) & (F.col(quote) != p)
        found = found.when(usable, pick(a.rate * b.rate, "pivot", F.greatest(a.date, b.date)))
    return rows.join(got, row_id, "left").withColumn("__x", found).select(*rows.columns, "__x.rate", "__x.method", "__x.rate_date")


# Digits after the point that a currency has; two for any other.
MINOR_UNITS = {"USD": 2, "EUR": 2, "HNL": 2}


def enrich_prices(rows: DataFrame, quotes: DataFrame, row_id: str, price: str = "price", currency: str = "currency", at: str = "date", to: str = "USD", pivots: tuple[str, ...] = ("USD",), on_missing: str = "empty") -> DataFrame:
    """Rows with std_price (half up to the currency's smallest unit), std_currency, fx_rate_used, fx_base_date, fx_pair,
    fx_method and fx_source, the last from the quotes' `source` if they have one and the rate is direct. Rows without
    price, currency, date or rate have nulls, or are an error on request."""
    own = rows.withColumn("__to", F.lit(to))
    complete = F.col(price).isNotNull() & F.col(currency).isNotNull() & F.col(at).isNotNull()
    got = resolve_rates(own.where(complete).select(row_id, F.col(currency).alias("__from"), "__to", F.col(at).alias("__at")), quotes, row_id, "__from", "__to", "__at", pivots)
    if "source" in quotes.columns:
        said = quotes.groupBy(F.col("base").alias("s_base"), F.col("quote").alias("s_quote"), F.col("date").alias("s_date")).agg(F.max(F.struct("rate", "source")).alias("s"))
        got = got.join(said, (F.col("__from") == F.col("s_base")) & (F.col("__to") == F.col("s_quote")) & (F.col("rate_date") == F.col("s_date")) & (F.col("method") == "direct"), "left").withColumn("source", F.col("s.source"))
    else:
        got = got.withColumn("source", F.lit(None).cast("string"))
    value = (F.col(price).cast("decimal(28,10)") * F.col("rate").cast("decimal(28,10)")).alias("v")
    out = own.drop("__to").join(got.select(F.col(row_id).alias("__id"), "rate", "method", "rate_date", "source"), F.col(row_id) == F.col("__id"), "left")
    if on_missing == "error":
        missing = F.raise_error(F.concat(F.lit("no rate for row "), F.col(row_id).cast("string"))).cast("double")
        out = out.withColumn("rate", F.when(complete, F.coalesce("rate", missing)))
    found = F.col("rate").isNotNull()
    new = {
        "std_price": F.round(value, MINOR_UNITS.get(to.upper(), 2)).cast("double"), "std_currency": F.when(found, to), "fx_rate_used": F.col("rate"), "fx_base_date": F.col("rate_date"),
        "fx_pair": F.when(found, F.concat(F.col(currency), F.lit(f"/{to}"))), "fx_method": F.col("method"), "fx_source": F.col("source"),
    }
    return out.withColumns(new).select(*rows.columns, *new)
