"""The room-count reference table (seed)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from immolens.schema import SEED_TYPOLOGY

# The reference table rows (rooms, label, description).
TYPOLOGY_ROWS = [
    (1, "Studio", "Logement d'une seule pièce"),
    (2, "T2", "Deux pièces principales"),
    (3, "T3", "Trois pièces principales"),
    (4, "T4", "Quatre pièces principales"),
    (5, "T5 et plus", "Logement de grande surface"),
]


def typology_seed(spark: SparkSession) -> DataFrame:
    """The built-in reference table (5 rows)."""
    return spark.createDataFrame(TYPOLOGY_ROWS, SEED_TYPOLOGY)


def read_seed(spark: SparkSession, path: str) -> DataFrame:
    """A seed CSV with a header, read with its fixed schema."""
    return spark.read.schema(SEED_TYPOLOGY).option("header", True).csv(path)


def typology_label_key(rooms: Column, open_ended_from: int = 5) -> Column:
    """Seed key of a room count: counts from ``open_ended_from`` up share the
    last row. A CASE, not ``least``, so a null count stays null."""
    return F.when(rooms >= open_ended_from, F.lit(open_ended_from)).otherwise(rooms)
