"""Column expressions shared by the jobs.  All of them run inside code generation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def lower_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.lower() for c in df.columns])


def without(df: DataFrame, *names: str) -> DataFrame:
    """Drop columns by name, whatever their case; absent names are ignored."""
    gone = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in gone])


def pick(df: DataFrame, wanted: Sequence[tuple[str, str]]) -> DataFrame:
    """Select (name, type) pairs; a column the input lacks becomes a typed NULL."""
    have = {c.lower(): c for c in df.columns}
    return df.select(*[
        (F.col(f"`{have[n.lower()]}`") if n.lower() in have else F.lit(None)).cast(t).alias(n)
        for n, t in wanted
    ])


def text(value: Column) -> Column:
    """Cast to string and keep NULL a NULL."""
    return value.cast("string")


def no_nan(value: Column) -> Column:
    return F.when(F.isnan(value), None).otherwise(value)


def short_name(first: Column, last: Column) -> Column:
    return F.trim(F.concat(F.coalesce(first, F.lit("")), F.lit(" "), F.coalesce(last, F.lit(""))))


def full_name(first: Column, middle: Column, last: Column) -> Column:
    return F.concat(first, F.lit(" "), F.coalesce(F.concat(middle, F.lit(" ")), F.lit("")), last)


def fiscal_year(day: Column) -> Column:
    """The fiscal year starts on 1 July of the calendar year before it."""
    return F.year(F.add_months(day.cast("date"), 6))


def week_start(day: Column) -> Column:
    """The Sunday on or before ``day``."""
    return F.date_sub(day, F.dayofweek(day) - 1)


def month_start(day: Column) -> Column:
    return F.trunc(day, "MM")


def years_since(first: Column, as_of: Column) -> Column:
    return F.coalesce(F.year(as_of) - F.year(first), F.lit(0))


def ratio(top: Column, bottom: Column, scale: float = 1.0) -> Column:
    """Unrounded double ratio; NULL where the denominator is zero or NULL."""
    share = top.cast("double") / F.nullif(bottom.cast("double"), F.lit(0.0))
    return share if scale == 1.0 else share * F.lit(scale)


def line_total(price: Column, discount: Column, quantity: Column) -> Column:
    return F.coalesce(price * (F.lit(1) - discount) * quantity, F.lit(0)).cast("decimal(19,4)")


def total_due(subtotal: Column, tax: Column, freight: Column) -> Column:
    zero = F.lit(0).cast("decimal(19,4)")
    return F.coalesce(subtotal + tax + freight, zero).cast("decimal(19,4)")


def stocked(received: Column, rejected: Column) -> Column:
    return F.coalesce(received - rejected, F.lit(0))


def order_number(order_id: Column) -> Column:
    return F.concat(F.lit("SO"), order_id.cast("string"))


def account_number(customer_id: Column) -> Column:
    digits = customer_id.cast("string")
    # lpad shortens longer text, so ids of more than eight digits pass through unpadded
    return F.concat(F.lit("AW"), F.when(F.length(digits) >= 8, digits).otherwise(F.lpad(digits, 8, "0")))


def money(value: Column) -> Column:
    """Text such as ``$1,234.50`` as decimal(19,4); NULL where it is not a number."""
    return F.regexp_replace(F.trim(value), "[$,]", "").try_cast("decimal(19,4)")


def flag(value: Column) -> Column:
    """Text flags.  Files hold 0 and 1, which a typed CSV read would turn into NULL; so does unknown text here."""
    plain = F.lower(F.trim(value))
    return F.when(plain.isin("1", "t", "true", "y", "yes"), True).when(plain.isin("0", "f", "false", "n", "no"), False)


def clean_uuid(value: Column) -> Column:
    return F.lower(F.regexp_replace(value, "[{}]", ""))


def clock(value: Column) -> Column:
    """``07:00:00.7500000`` as ``07:00:00.75`` and without a fraction of zero; NULL for other text."""
    known = r"^((?:[01]\d|2[0-3]):[0-5]\d:[0-5]\d)(?:(\.\d*?[1-9])0*|\.0*)?$"
    return F.when(value.rlike(known), F.regexp_replace(value, known, "$1$2"))
