"""V1-V6: History -> staging view (typed, cleaned, filtered observations)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from immolens.functions import capitalize_first, epoch_day_to_date, price_per_m2, whole_price_per_m2


def _as_date(df: DataFrame, name: str):
    """V5: a date column passes through, an epoch-day integer is converted."""
    dtype = df.schema[name].dataType
    if isinstance(dtype, T.DateType):
        return F.col(name)
    if isinstance(dtype, (T.IntegerType, T.LongType, T.ShortType, T.ByteType)):
        return epoch_day_to_date(name)
    return F.col(name).cast("date")


def is_staged() -> Column:
    """V6: rows with a price and a positive surface (on source columns)."""
    return F.col("price_eur").isNotNull() & (F.col("surface_m2") > 0)


def staging_columns(history: DataFrame, names: Sequence[str] | None = None) -> list[Column]:
    """The staging columns (all, or some) over the History's columns."""
    whole = all(isinstance(history.schema[c].dataType, T.IntegerType) for c in ("price_eur", "surface_m2"))
    columns = {
        "id_annonce": F.col("id_annonce").cast("string"),
        "title": capitalize_first("title"),
        "price_eur": F.col("price_eur").cast("double"),
        "surface_m2": F.col("surface_m2").cast("double"),
        "nb_pieces": F.col("nb_pieces").cast("int"),
        "price_m2": (whole_price_per_m2 if whole else price_per_m2)("price_eur", "surface_m2"),
        "city": capitalize_first("city"),
        "description": F.trim("description"),
        "date_scraping": _as_date(history, "date_scraping"),
    }
    return [columns[n].alias(n) for n in names or columns]


def to_staging(history: DataFrame) -> DataFrame:
    """Typed staging rows: price and surface as double, capitalised title and
    city, price per m² recomputed from the source columns, trimmed
    description; keeps rows with a price and a positive surface.

    The filter sits on source columns so it reaches the Parquet scan.
    """
    return history.where(is_staged()).select(*staging_columns(history))
