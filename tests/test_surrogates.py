import pytest
from pyspark.sql import functions as F

from millrace.functions import entities as e
from millrace.functions.surrogates import number_surrogate, permuted_digits
from millrace.sources.csv import arrow_uri


@pytest.mark.parametrize("length", [1, 2, 3, 4])
def test_all_numbers_of_a_length_are_permuted(spark, length):
    given = spark.range(10**length).select(F.lpad(F.col("id").cast("string"), length, "0").alias("d"))
    found = [r.o for r in given.select(permuted_digits(F.col("d"), "k").alias("o")).collect()]
    assert sorted(found) == [str(i).zfill(length) for i in range(10**length)]


def test_key_decides_and_odd_inputs(spark):
    df = spark.createDataFrame([("4111111111111111",), ("0" * 36,), ("",), (None,)], "d string")
    one, same, other = ([r.o for r in df.select(permuted_digits(F.col("d"), k).alias("o")).collect()] for k in ("a", "a", "b"))
    assert one == same and one[:2] != other[:2]
    assert [len(x) for x in one[:3]] == [16, 36, 0] and one[3] is None


def test_phones_keep_their_form_and_do_not_meet(spark):
    given = spark.range(30000).select(F.format_string("+1 (212) %03d-%04d", (F.col("id") / 10000).cast("int"), (F.col("id") % 10000).cast("int")).alias("t"))
    out = given.select(number_surrogate(F.col("t"), "k").alias("o"))
    assert out.distinct().count() == 30000
    assert out.where(~F.col("o").rlike(r"^\+1 \([0-9]{3}\) [0-9]{3}-[0-9]{4}$")).count() == 0


def test_obfuscation_with_a_key(spark):
    text = "Call +1 (212) 555-0143 or (212) 555-0143, ssn 123-45-6789, card 4111-1111-1111-1111, on 2024-01-01."
    df = spark.createDataFrame([(text,)], "t string")
    plain, keyed = df.select(e.obfuscated(F.col("t"), F.lit("s")).alias("a"), e.obfuscated(F.col("t"), F.lit("s"), "k").alias("b")).first()
    assert plain != keyed and "555-0143" not in keyed and "123-45-6789" not in keyed and "4111-1111" not in keyed
    first, second = keyed[len("Call +1 ") :][:14], keyed[len(text[: text.index(" or (") + 4]) :][:14]
    assert first == second  # with and without +1
    assert plain[plain.index(", on ") :] == keyed[keyed.index(", on ") :]


def test_addresses_of_stores():
    assert arrow_uri("s3a://b/x y.csv") == "s3://b/x y.csv" and arrow_uri("s3n://b/x") == "s3://b/x"
    assert arrow_uri("wasbs://c@a.blob.core.windows.net/p/q.csv") == "abfss://c@a.dfs.core.windows.net/p/q.csv"
    assert arrow_uri("wasb://c@a.blob.core.windows.net/p") == "abfs://c@a.dfs.core.windows.net/p"
    assert arrow_uri("dbfs:/mnt/p.csv") == arrow_uri("dbfs:///mnt/p.csv") == "file:///dbfs/mnt/p.csv"
    for same in ("file:///a/b.csv", "hdfs://n:8020/a", "gs://b/a", "abfss://c@a.dfs.core.windows.net/p", "/plain/path"):
        assert arrow_uri(same) == same
