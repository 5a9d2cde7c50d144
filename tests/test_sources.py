from __future__ import annotations

import datetime

import pytest
from pyspark.sql import types as T
from trip_rows import AS_OF

from silverlode.functions.contract import TRIP_CONTRACT
from silverlode.functions.rules import Rule
from silverlode.operators import clean
from silverlode.operators import route as routing
from silverlode.sources import readers

PAIR = T.StructType(
    [T.StructField("a", T.IntegerType(), False), T.StructField("b", T.IntegerType(), True)]
)


@pytest.fixture
def malformed(tmp_path) -> str:
    path = tmp_path / "in.csv"
    path.write_text("a,b\n1,2\nxx,3\n4,5,6\n7\n")
    return str(path)


def test_permissive_keeps_every_row_and_its_text(spark, malformed):
    df = readers.read_csv(spark, malformed, PAIR, keep_corrupt=True)
    good, bad = readers.split_corrupt(df)
    assert [tuple(r) for r in good.collect()] == [(1, 2)]
    assert sorted(r["_corrupt_record"] for r in bad.collect()) == ["4,5,6", "7", "xx,3"]


def test_permissive_is_the_default(spark, malformed):
    assert readers.read_csv(spark, malformed, PAIR).count() == 4


def test_dropmalformed(spark, malformed):
    df = readers.read_csv(spark, malformed, PAIR, mode="DROPMALFORMED")
    assert [tuple(r) for r in df.collect()] == [(1, 2)]


def test_failfast(spark, malformed):
    with pytest.raises(Exception, match="(?i)malformed|parse|cast"):
        readers.read_csv(spark, malformed, PAIR, mode="FAILFAST").collect()


def test_unknown_mode(spark, malformed):
    with pytest.raises(ValueError):
        readers.read_csv(spark, malformed, PAIR, mode="LENIENT")


def test_not_null_is_not_enforced_by_the_reader(spark, malformed):
    assert readers.read_csv(spark, malformed, PAIR).schema["a"].nullable


def test_corrupt_rows_are_routed_as_schema_mismatch(spark, malformed):
    df = readers.read_csv(spark, malformed, PAIR, keep_corrupt=True, lineage=True)
    from pyspark.sql import functions as F

    result = routing.route(df, ["a"], ["a"], {}, [Rule("b_high", F.col("b") > 100)], AS_OF)
    counts = {r.verdict: r.n for r in result.verdict_counts().collect()}
    assert counts["schema_mismatch"] == 3
    letters = result.dead_letters.collect()
    assert sorted(r["_original_record"] for r in letters) == ["4,5,6", "7", "xx,3"]
    assert all(r["_source_file"].endswith("in.csv") for r in letters)


def test_lineage_survives_the_shuffle(spark, small):
    df = readers.read_parquet(spark, f"{small}/orders.parquet", lineage=True)
    files = routing.dedup(df, ["o_orderkey"]).select("_source_file").distinct().collect()
    assert len(files) == 1 and files[0][0].endswith("orders.parquet")


def test_explicit_int_schema_gives_null_for_decimal_text(spark, tmp_path):
    path = tmp_path / "x.csv"
    path.write_text("a,b\n1.0,2\n")
    row = readers.read_csv(spark, str(path), PAIR).first()
    assert row.a is None and row.b == 2


def test_inferred_types(spark, tmp_path):
    path = tmp_path / "x.csv"
    path.write_text("i,d,s\n1,1.5,x\n2,2.5,y\n")
    assert dict(readers.read_csv(spark, str(path)).dtypes) == {"i": "int", "d": "double", "s": "string"}


def test_encoding(spark, tmp_path):
    path = tmp_path / "x.csv"
    path.write_bytes("s\ncafé\n".encode("latin-1"))
    schema = T.StructType([T.StructField("s", T.StringType())])
    assert readers.read_csv(spark, str(path), schema, encoding="ISO-8859-1").first().s == "café"
    path.write_bytes("s\ncafé\n".encode())
    spark.catalog.clearCache()
    again = tmp_path / "y.csv"
    again.write_bytes("s\ncafé\n".encode())
    assert readers.read_csv(spark, str(again), schema).first().s == "café"


def test_contract_schema_reads_a_trip_file(spark, tmp_path):
    header = ",".join(TRIP_CONTRACT.names)
    line = "1,2023-05-01 10:00:00,2023-05-01 10:20:00,2.0,3.5,1.0,N,10,20,1," + ",".join(["1.5"] * 10)
    path = tmp_path / "trips.csv"
    path.write_text(f"{header}\n{line}\n")
    df = readers.read_csv(spark, str(path), TRIP_CONTRACT.to_struct(), keep_corrupt=True)
    row = df.first()
    assert row["_corrupt_record"] is None
    assert row.tpep_pickup_datetime == datetime.datetime(2023, 5, 1, 10)
    assert row.cbd_congestion_fee == 1.5


def test_json_keeps_corrupt_lines(spark, tmp_path):
    path = tmp_path / "x.json"
    path.write_text('{"a": 1, "b": 2}\n{"a": oops\n')
    df = readers.read_json(spark, str(path), PAIR, keep_corrupt=True)
    good, bad = readers.split_corrupt(df)
    assert [tuple(r) for r in good.collect()] == [(1, 2)]
    assert bad.first()["_corrupt_record"].startswith('{"a": oops')


def test_months_with_a_new_column(spark, tmp_path):
    spark.createDataFrame([(1,)], "a int").write.parquet(str(tmp_path / "m1"))
    spark.createDataFrame([(2, 3.0)], "a int, fee double").write.parquet(str(tmp_path / "m2"))
    df = readers.read_months(spark, [str(tmp_path / "m1"), str(tmp_path / "m2")])
    assert sorted(map(tuple, df.collect())) == [(1, None), (2, 3.0)]


def test_smoke_rows(spark):
    rows = [(1, 8.5, 1), (2, 12.0, 2), (3, 25.3, 1), (4, 6.0, 3)]
    df = readers.from_rows(spark, rows, "trip_id bigint, fare double, passenger_count bigint")
    assert df.count() == 4
    assert sorted(r.fare for r in df.filter("fare > 10").collect()) == [12.0, 25.3]


TEXTS = ["1", " 2 ", "+3", "-4", ".5", "1e3", "6.", "\t7", "\x008", "NaN", "-inf", "Infinity", "1_0"]
TEXTS += ["", " ", "n/a", "many", "?", "-", "+", "0x10", "1d", "2f", "٣", "99999999999"]
TIME_TEXTS = ["2024-01-02", " 2024-01-02 03:04:05 ", "2024", "2024-1-2", "+2024-01-02", "T10:00", "now"]
TIME_TEXTS += ["2024-13-01", "x2024-01-01", "", "2024-01-02T03:04:05Z", "epoch", "-0001-01-01"]


@pytest.mark.parametrize(
    "kind, texts",
    [(k, TEXTS) for k in ("int", "bigint", "double", "decimal(18,2)")]
    + [(k, TIME_TEXTS) for k in ("timestamp_ntz", "date")],
)
def test_guarded_read_equals_plain_try_cast(spark, kind, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    guarded = clean.read_as(df, "t", kind).cast("string").alias("guarded")
    plain = df.t.try_cast(kind).cast("string").alias("plain")
    for row in df.select("t", guarded, plain).collect():
        assert row.guarded == row.plain, row


def test_a_folder_of_deliveries_reads_like_the_list(spark, tmp_path):
    spark.range(3).write.parquet(f"{tmp_path}/in/one")
    spark.range(3).selectExpr("id", "id * 2 AS fee").write.parquet(f"{tmp_path}/in/two")
    folder = readers.read_months(spark, f"{tmp_path}/in/*")
    listed = readers.read_months(spark, [f"{tmp_path}/in/one", f"{tmp_path}/in/two"])
    assert folder.columns == listed.columns == ["id", "fee"]
    assert sorted(map(str, folder.collect())) == sorted(map(str, listed.collect()))


def test_types_that_differ_are_widened_or_given(spark, tmp_path):
    spark.range(3).selectExpr("CAST(id AS INT) AS id", "id AS n").write.parquet(f"{tmp_path}/one")
    spark.range(3).selectExpr("CAST(id AS DOUBLE) AS id", "'x' AS s").write.parquet(f"{tmp_path}/two")
    both = [f"{tmp_path}/one", f"{tmp_path}/two"]
    assert dict(readers.read_months(spark, both).dtypes) == {"id": "double", "n": "bigint", "s": "string"}
    given = readers.read_months(spark, both, {"id": "bigint"})
    assert dict(given.dtypes)["id"] == "bigint" and given.count() == 6


def test_csv_columns_go_by_name(spark, tmp_path):
    (tmp_path / "a.csv").write_text("fare,extra,more\n50.0,0.5,x\n")
    schema = "extra double, fare double, absent int"
    schema = spark.createDataFrame([], schema).schema
    row = readers.read_csv(spark, str(tmp_path / "a.csv"), schema, keep_corrupt=True).first()
    assert row.asDict() == {"extra": 0.5, "fare": 50.0, "more": "x", "_corrupt_record": None}


def test_csv_files_with_different_headers_are_refused(spark, tmp_path):
    (tmp_path / "a.csv").write_text("fare,extra\n50.0,0.5\n")
    (tmp_path / "b.csv").write_text("extra,fare\n0.5,50.0\n")
    schema = spark.createDataFrame([], "fare double, extra double").schema
    with pytest.raises(Exception, match="header"):
        readers.read_csv(spark, [str(tmp_path / "a.csv"), str(tmp_path / "b.csv")], schema).collect()


def test_unreadable_rows_do_not_depend_on_the_columns_read(spark, tmp_path):
    (tmp_path / "a.csv").write_text("a,b\n1,2\n3,x\n")
    schema = spark.createDataFrame([], "a int, b int").schema
    good, bad = readers.split_corrupt(readers.read_csv(spark, str(tmp_path / "a.csv"), schema, keep_corrupt=True))
    assert [r.a for r in good.select("a").collect()] == [1]
    assert [r.a for r in bad.select("a").collect()] == [3]
