"""Small scalar helpers used at the edges of the tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .clock import col


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN and null mean the same thing upstream but not in Spark: keep only null."""
    floats = [f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: F.nanvl(F.col(c), F.lit(None).cast("double")) for c in floats})


def finite(x) -> Column:
    """True only for a real number: null, NaN and both infinities fail closed."""
    v = col(x).cast("double")
    return v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf")))


def clip(x, low, high) -> Column:
    """Null stays null; a null bound does not clip."""
    v = col(x)
    return F.when(v.isNotNull(), F.greatest(F.least(v, col(high)), col(low)))


def optional(x, digits: int = 1) -> Column:
    return F.round(col(x), digits)


def features_json(features_map) -> Column:
    """A map of doubles as a JSON object with sorted keys."""
    entries = F.array_sort(F.map_entries(col(features_map)))
    return F.to_json(F.map_from_entries(entries))


def features_from_json(text, names) -> dict[str, Column]:
    parsed = F.from_json(col(text), "map<string,double>")
    return {n: F.element_at(parsed, n) for n in names}


def joined_names(names_array) -> Column:
    return F.array_join(col(names_array), " ")


def split_names(text) -> Column:
    return F.filter(F.split(col(text), " "), lambda n: n != F.lit(""))
