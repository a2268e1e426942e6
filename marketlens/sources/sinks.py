"""Writers. Every table replaces its previous version as a whole."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from marketlens.functions.text import clean_cell


def write_table(df: DataFrame, path: str) -> DataFrame:
    """Write Parquet and return the table as read back, free of its lineage."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").options(header=True, escape='"', encoding="UTF-8").csv(path)


def write_clean_csv(df: DataFrame, path: str, columns: Sequence[str]) -> int:
    """Write the listed columns as cleaned text (missing ones empty); the number of rows."""
    rows = Observation("rows")
    cells = [clean_cell(c).alias(c) if c in df.columns else F.lit("").alias(c) for c in columns]
    write_csv(df.select(*cells).observe(rows, F.count(F.lit(1)).alias("n")), path)
    return rows.get["n"]


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def export(df: DataFrame, folder: str, name: str, order: Sequence[Column | str] = ()) -> DataFrame:
    """Write a gold table as Parquet and, from the stored table, as CSV, in `order` if there is one."""
    stored = write_table(df, f"{folder}/{name}")
    export_csv(stored, folder, name, order)
    return stored


def export_csv(stored: DataFrame, folder: str, name: str, order: Sequence[Column | str] = ()) -> None:
    """The CSV export of a stored gold table, in `order` if there is one."""
    write_csv(stored.orderBy(*order) if order else stored, f"{folder}/csv/{name}")


def write_selection(df: DataFrame, path: str) -> None:
    """Export a user's selection as UTF-8 CSV."""
    write_csv(df, path)
