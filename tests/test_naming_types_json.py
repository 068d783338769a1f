import datetime
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import jsonfmt, naming
from tidemark.functions.retry import PermanentError, RetryPolicy, retry
from tidemark.functions.types import Array, Decimal, Field, Record, UnsupportedType, clustering_keys, spark_type, warehouse_type
from tidemark.operators.assess import Assessor


def test_dataset_names():
    for given, want in (("2fas", "2fas"), ("ab?/c", "ab_c"), ("a2 fs", "a2_fs"), ("a2-fs", "a2_fs"), ("a" * 1026, "a" * 1024), ("", ""), (None, None)):
        assert naming.normalize_dataset_name(given) == want
    assert naming.resolve_dataset_name(None, "db") == naming.resolve_dataset_name("", "db") == "db"


def test_table_names():
    for given, want in (("ab?c", "ab_c"), ("a2 fs", "a2 fs"), ("a2-fs", "a2-fs"), ("a" * 1026, "a" * 1024)):
        assert naming.normalize_table_name(given) == want


def test_field_names():
    for given, want in (("2fas", "_2fas"), ("ab?/c", "ab_c"), ("a2 fs", "a2_fs"), ("1" + "a" * 299, "_1" + "a" * 298), ("field-with-dash", "field_with_dash"), ("1970-01-01", "_1970_01_01")):
        assert naming.normalize_field_name(given) == want


def test_flexible_field_names():
    for kept in ["a2-fs", "字段", *[f"a{c}b" for c in "&%=+:'<>#| "], "a  b"]:
        assert naming.normalize_field_name(kept, True) == kept
    for bad in ["😀", "\t", *"!\"$()*,./;?@[\\]^{}~`"]:
        assert naming.normalize_field_name(f"a{bad}b", True) == "a_b"
    assert naming.normalize_field_name("mixed%valid?invalid@", True) == "mixed%valid_invalid_"


def test_column_versions_agree(spark):
    names = ["2fas", "ab?/c", "a2 fs", "é-x", "字段&", "a\tb", "", "x" * 400]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    c = F.col("n")
    got = df.select(naming.dataset_name_col(c), naming.table_name_col(c), naming.field_name_col(c), naming.field_name_col(c, True)).collect()
    for n, r in zip(names, got, strict=True):
        assert tuple(r) == (naming.normalize_dataset_name(n), naming.normalize_table_name(n), naming.normalize_field_name(n), naming.normalize_field_name(n, True))


def test_name_collisions_and_keys():
    with pytest.raises(ValueError):
        naming.field_mapping(["a b", "a?b"])
    assert naming.staging_location_name("SomeBucket", "ns", "app", 1) == naming.staging_location_name(" gs://somebucket  ", "ns", "app", 1) == "somebucket"
    assert naming.staging_location_name(None, "ns", "app", 1) == naming.staging_location_name(" ", "ns", "app", 1) == "tidemark-ns-app-1"
    assert naming.retry_delay_seconds(300) == 90 and naming.retry_delay_seconds(10) == 9
    assert naming.job_id("a", "merge", "d", "t", 7, 0) == "a_merge_d_t_7_0"


def test_types():
    assert warehouse_type("INT") == "INT64" and warehouse_type(Decimal(38, 9)) == "NUMERIC" and warehouse_type(Decimal(38, 10)) == "BIGNUMERIC"
    assert spark_type(Decimal(76, 10)) == T.StringType() and spark_type(Array("DATE")) == T.ArrayType(T.LongType(), False)
    assert warehouse_type(Record((Field("x", "INT"),))) == "STRUCT"
    for bad in ("MAP", "UNION", "NULL", Array(Record(()))):
        with pytest.raises(UnsupportedType):
            warehouse_type(bad)
    wide = [Field(f"id{i}", "INT") for i in range(1, 6)]
    assert clustering_keys(wide, [f.name for f in wide]) == ["id1", "id2", "id3", "id4"]
    assert clustering_keys([Field("id1", "BYTES")], ["id1"]) == [] and clustering_keys(wide, ["id1"], 0) == []
    mixed = [Field(f"id{i}", "BYTES") for i in range(1, 5)] + [Field("id5", "INT")]
    assert clustering_keys(mixed, [f.name for f in mixed]) == ["id5"]


def test_datetime_trim(spark):
    cases = {
        "2022-04-01 14:31:12.123456789": "2022-04-01 14:31:12.123456", "2022-04-01T14:31:12.1234567": "2022-04-01T14:31:12.123456",
        "2022-04-01 14:31:12.123456": "2022-04-01 14:31:12.123456", "2022-04-01 14:31:12.123": "2022-04-01 14:31:12.123",
        "2022-4-1 4:1:2": "2022-4-1 4:1:2", "2022-4-1": "2022-4-1", "nonsense": "nonsense",
    }
    got = spark.createDataFrame([(k,) for k in cases], "s string").select(jsonfmt.datetime_json(F.col("s"))).collect()
    assert [r[0] for r in got] == list(cases.values())


def test_json_values(spark):
    df = spark.createDataFrame([(-1, -1500, D("1.50"), bytearray(b"ab"), datetime.date(1969, 12, 31), [1, 2])], "us long, ms long, d decimal(5,2), b binary, day date, a array<int>")
    row = df.select(jsonfmt.timestamp_json(F.col("us")), jsonfmt.timestamp_json(F.col("ms"), "millis"), jsonfmt.time_json(F.lit(1)), jsonfmt.date_json(F.lit(-1))).first()
    assert tuple(row) == ("1969-12-31 23:59:59.999999", "1969-12-31 23:59:58.500000", "00:00:00.000001", "1969-12-31")
    assert df.select(jsonfmt.record_json(df)).first()[0] == '{"us":-1,"ms":-1500,"d":"1.50","b":"YWI=","day":"1969-12-31","a":[1,2]}'
    bad = spark.createDataFrame([([1, None],)], "a array<int>")
    with pytest.raises(Exception, match="null"):
        bad.select(jsonfmt.record_json(bad)).collect()


def test_retry():
    tries = []

    def action():
        tries.append(1)
        if len(tries) < 3:
            raise OSError
        return "done"

    assert retry(action, RetryPolicy(5, 100, 1, 2, 0), sleep=lambda s: None) == "done"

    def hopeless():
        tries.append(1)
        raise PermanentError

    tries.clear()
    with pytest.raises(PermanentError):
        retry(hopeless, sleep=lambda s: None)
    assert len(tries) == 1


def test_assessment(spark):
    a = Assessor()
    fields = [Field("field1", "STRING"), Field("2f", "MAP")]
    columns, problems = a.assess("db", "s1", "t", fields, ["field1"])
    assert columns == [("field1", "field1", "STRING", True), ("2f", "_2f", "N/A", False)] and problems == []
    _, problems = a.assess("db", "s2", "t", fields, [])
    assert [p[0] for p in problems] == ["table name used twice", "no primary key"]
    _, problems = a.assess("d b", "s", "t?", fields, ["field1"])
    assert [p[0] for p in problems] == ["namespace renamed", "table renamed", "staging table renamed"]
    assert a.frames(spark, "x", "s", "u", fields, ["field1"])[0].count() == 2


def test_json_dates_of_far_years(spark):
    """As the registered SQL writes them, at event ids of larger tables: no sign before five-digit years, no nulls."""
    days = [2932896, 2932897, 6_000_000, -719163, -720000, 100_000_000, 0, None]
    got = [r[0] for r in spark.createDataFrame([(d,) for d in days], "d long").select(jsonfmt.date_json(F.col("d"))).collect()]
    assert got == ["9999-12-31", "10000-01-01", "18397-06-11", "0000-12-31", "-2-09-16", "275760-09-13", "1970-01-01", None]


def test_json_timestamps_of_far_years(spark):
    micros = [253402300799999999, 253402300800000000, 7_400_000_000_000_000_000, -62167219200000001, -1, 2**63 - 1, None]
    want = ["9999-12-31 23:59:59.999999", "10000-01-01 00:00:00.000000", "236466-08-31 03:33:20.000000", "-1-12-31 23:59:59.999999",
            "1969-12-31 23:59:59.999999", "294247-01-10 04:00:54.775807", None]
    df = spark.createDataFrame([(m,) for m in micros], "us long")
    assert [r[0] for r in df.select(jsonfmt.timestamp_json(F.col("us"))).collect()] == want
    got = df.where("us % 1000 = 0").select(jsonfmt.timestamp_json(F.expr("us div 1000"), "millis")).collect()
    assert [r[0] for r in got] == want[1:3]
    far = spark.sql("SELECT DATE'+10000-01-02' AS d, TIMESTAMP_NTZ'+10000-01-02 03:04:05' AS n, TIMESTAMP'+10000-01-02 03:04:05' AS t")
    assert far.select(jsonfmt.record_json(far)).first()[0] == '{"d":"10000-01-02","n":"10000-01-02T03:04:05.000000","t":"10000-01-02 03:04:05.000000"}'
