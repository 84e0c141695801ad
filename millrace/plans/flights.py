"""Flights: incremental load, dimensions, clean table, clustering."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.columns import first_part
from ..functions.fixed import FLIGHT_COLUMNS
from ..operators.joins import left_lookup
from ..sources.csv import csv_view
from ..sources.tables import cluster, files_needed, replace_table, write_partitioned
from ..streaming.incremental import copy_new_files, loaded, loaded_table


def load_flights(spark: SparkSession, source: str, target: str, checkpoint: str, table: str | None = None) -> DataFrame:
    """Load the flight files that are new and return all flights loaded, none before the first file.

    With ``table`` they are the rows of that typed catalog table.
    """
    copy_new_files(spark, source, target, checkpoint, FLIGHT_COLUMNS)
    if table is not None:
        return loaded_table(spark, table, target, FLIGHT_COLUMNS)
    return loaded(spark, target, FLIGHT_COLUMNS)


def load_dimension(spark: SparkSession, path: str, view: str, table: str, root: str) -> DataFrame:
    """Dimension CSV as text columns, into a table that is replaced."""
    return replace_table(csv_view(spark, path, view), table, root)


def clean_flights(flights: DataFrame, carriers: DataFrame, delimiter: str = ":") -> DataFrame:
    """Flights with their year and the airline's name.

    A flight without a matching carrier stays, with a NULL airline; a carrier
    id that occurs twice repeats its flights.
    """
    names = carriers.select(F.col("ID").alias("_id"), first_part(F.col("Carrier"), delimiter).alias("Airline"))
    joined = left_lookup(flights, names, flights["Reporting_Airline"] == names["_id"])
    kept = ("OriginCityName", "OriginState", "DestCityName", "DestState", "ArrDelayMinutes", "DepDelayMinutes")
    return joined.select("FlightDate", F.year("FlightDate").alias("Year"), *kept, "Airline")


def publish(clean: DataFrame, path: str) -> str:
    """Clean flights in one folder per year."""
    return write_partitioned(clean, path, "Year")


def publish_table(clean: DataFrame, name: str, root: str) -> DataFrame:
    """Clean flights as a catalog table partitioned by year, created or replaced."""
    return replace_table(clean, name, root, partition_by="Year")


def optimize(spark: SparkSession, path: str, out: str, files: int | None = None) -> str:
    """Cluster the clean flights of each year on the airline, in as many files as their bytes need."""
    return cluster(spark.read.parquet(path), "Airline", out, files or files_needed(spark, path), partition_by="Year")
