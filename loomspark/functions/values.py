"""Small scalar functions: blanks as nulls, dates, rounding, vectors."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def first_filled(*cols: Column) -> Column:
    """The first that is neither null nor blank."""
    return F.coalesce(*[F.when(F.trim(c) != "", c) for c in cols])


def split_multi(cell: Column, by: str = "[,;]") -> Column:
    return F.filter(F.transform(F.split(cell, by), lambda x: F.trim(x)), lambda x: x != "")


def parse_date(text: Column, formats: tuple[str, ...] = ("yyyy-MM-dd", "d/M/yyyy", "d MMMM yyyy")) -> Column:
    return F.coalesce(*[F.try_to_date(text, f) for f in formats]) if hasattr(F, "try_to_date") else F.coalesce(*[F.try_to_timestamp(text, F.lit(f)).cast("date") for f in formats])


def year(text: Column) -> Column:
    """The first 19xx or 20xx."""
    return F.nullif(F.regexp_extract(text, r"((?:19|20)\d{2})", 1), F.lit("")).cast("int")


def half_even(x: Column, digits: int) -> Column:
    return F.bround(x, digits)


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: Column, b: Column) -> Column:
    return dot(a, b) / (norm(a) * norm(b))


def unit(a: Column) -> Column:
    n = norm(a)
    return F.transform(a, lambda x: F.when(n > 0, x / n).otherwise(0.0))


def by_keywords(text: Column, rules: list[tuple[str, tuple[str, ...]]], fallback: str = "other") -> Column:
    """Name of the first rule one of whose keywords occurs."""
    out = F.lit(fallback)
    for name, words in reversed(rules):
        hit = F.lit(False)
        for w in words:
            hit = hit | F.contains(F.lower(text), F.lit(w.lower()))
        out = F.when(hit, name).otherwise(out)
    return out


def era(year: Column, bounds: tuple[int, ...]) -> Column:
    """Label of the band of years: before the first bound, between bounds, from the last."""
    out = F.lit(f"{bounds[-1]}+")
    for low, high in reversed(list(zip((None, *bounds[:-1]), bounds, strict=True))):
        out = F.when(year < high, F.lit(f"<{high}" if low is None else f"{low}-{high - 1}")).otherwise(out)
    return F.when(year.isNull(), "unknown").otherwise(out)


def token_cost(chars: Column, per_million: float, discount: float = 0.0, per_token: float = 4.0) -> Column:
    return chars / per_token * per_million / 1e6 * (1 - discount)
