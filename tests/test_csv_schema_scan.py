from conftest import SMALL
from pyspark.sql import functions as F

from millrace.registry import storage


def test_csv_files_grow_with_the_input_and_hold_every_row(spark, monkeypatch):
    written = []
    write = storage.write_csv
    monkeypatch.setattr(storage, "write_csv", lambda df, path: written.append(write(df, path)) or path)
    monkeypatch.setattr(storage, "CSV_FILE_INPUT", 1 << 14, raising=False)  # a small input of many files' worth
    read = storage.csv_schema_scan(spark, SMALL)
    lines = spark.read.parquet(f"{SMALL}/lineitem.parquet")
    assert len(spark.read.text(written[0]).inputFiles()) > 4
    keys = lambda df: df.agg(F.count("*"), F.sum("l_orderkey"), F.sum("l_linenumber")).first()
    assert keys(read) == keys(lines)
