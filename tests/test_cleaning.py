import datetime as dt
import hashlib

import pytest
from pyspark.sql import functions as F

from conftest import rows
from logquarry.functions import columns as c
from logquarry.functions import names as n
from logquarry.operators.features import first_valid_timestamp
from logquarry.plans.silver import clean_logs, with_masked_ip, with_user_hash
from logquarry.sources.logs import scan_auto, scan_log_csv, sniff_delimiter


def apply(spark, values, expression, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r[1] for r in sorted(rows(df.select("i", expression(F.col("x")))))]


def test_csv_null_tokens_quotes_and_line_breaks(spark, tmp_path):
    path = tmp_path / "raw.csv"
    path.write_text('a,b,c\n"x\ny","say ""hi""",1\nNA,None,\nnull,N/A,NaN\n00012,-nan,true\n', encoding="utf-8")
    found = rows(scan_log_csv(spark, str(path)))
    assert found == [("x\ny", 'say "hi"', "1"), (None, None, None), (None, None, None), ("00012", None, "true")]


def test_files_with_and_without_quoted_line_breaks(spark, tmp_path):
    folder = tmp_path / "some logs"
    folder.mkdir()
    (folder / "a.csv").write_text('x,y\n1,"p ""q"""\n2,plain\n')
    (folder / "b c.csv").write_text('x,y\n3,"two\nlines, and ""more""\n"\n')
    expected = [("1", 'p "q"'), ("2", "plain"), ("3", 'two\nlines, and "more"\n')]
    assert sorted(rows(scan_log_csv(spark, str(folder)))) == expected
    assert sorted(rows(scan_log_csv(spark, str(folder), multi_line=True))) == expected


def test_a_large_file_without_line_breaks_is_split(spark, tmp_path):
    path = tmp_path / "big.csv"
    path.write_text("x,y\n" + "".join(f'{i},"cell {i}, quoted"\n' for i in range(30_000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    spark.conf.set("spark.sql.files.openCostInBytes", "1k")
    try:
        table = scan_log_csv(spark, str(path))
        assert table.rdd.getNumPartitions() > 4
        assert table.agg(F.count("*"), F.countDistinct("x"), F.max("y")).first()[:2] == (30_000, 30_000)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


@pytest.mark.parametrize("sep", [",", ";", "\t", "|"])
def test_sniffed_delimiter(spark, tmp_path, sep):
    path = tmp_path / "t.csv"
    path.write_text(f"a{sep}b{sep}c\n1{sep}2{sep}x\n")
    assert sniff_delimiter(spark, str(path)) == sep
    assert rows(scan_auto(spark, str(path), "a INT, b DOUBLE")) == [(1, 2.0, "x")]


def test_scan_auto_rejects_other_suffixes(spark):
    with pytest.raises(ValueError):
        scan_auto(spark, "/nowhere/table.xlsx")


def test_aliases_by_first_match_and_exact_target(spark):
    df = spark.createDataFrame([(1, 2, 3, 4, 5)], "Time int, USER int, eventName int, weekday int, resource int")
    assert n.resolve_aliases(df).columns == ["timestamp", "user_hash", "event", "day_of_week", "resource"]
    both = spark.createDataFrame([(1, 2)], "timestamp int, eventtime int")
    assert n.resolve_aliases(both).columns == ["timestamp", "eventtime"]


def test_names_are_stripped_and_lowered(spark):
    df = spark.createDataFrame([(1, 2)], "` EventTime ` int, `EventName` int")
    assert n.normalize_names(df).columns == ["eventtime", "eventname"]
    assert n.normalize_names(df, lower=False).columns == ["EventTime", "EventName"]


def test_parse_utc(spark):
    values = ["2024-03-01T10:00:00Z", "2024-03-01T10:00:00+02:00", "01/03/2024", "junk", None]
    assert apply(spark, values, c.parse_utc) == [
        dt.datetime(2024, 3, 1, 10), dt.datetime(2024, 3, 1, 8), None, None, None,
    ]
    strict = apply(spark, values, lambda x: c.parse_utc(x, "dd/MM/yyyy"))
    assert strict == [None, None, dt.datetime(2024, 3, 1), None, None]


def test_first_valid_timestamp(spark):
    df = spark.createDataFrame([("x", "2024-01-01 00:00:01")], "timestamp string, eventTime string")
    assert rows(first_valid_timestamp(df).select("timestamp")) == [(dt.datetime(2024, 1, 1, 0, 0, 1),)]
    with pytest.raises(ValueError):
        first_valid_timestamp(df.select("timestamp"))


def test_user_hash_column_choice(spark):
    df = spark.createDataFrame([("1", "ana"), (None, "bia")], "useridentityaccountid string, useridentityusername string")
    digest = hashlib.sha256
    assert [r[0] for r in rows(with_user_hash(df).select("user_hash"))] == [digest(b"1").hexdigest(), None]
    names = with_user_hash(df.drop("useridentityaccountid")).select("user_hash")
    assert [r[0] for r in rows(names)] == [digest(b"ana").hexdigest(), digest(b"bia").hexdigest()]
    assert {r[0] for r in rows(with_user_hash(df.select(F.lit(1).alias("z"))).select("user_hash"))} == {"unknown"}


def test_mask_ip(spark):
    values = ["10.1.2.3", "2001:db8::1", "console.aws.example.com", "a.b.c", "1.2.3.4.5", "", None]
    assert apply(spark, values, c.mask_ip) == ["10.1.***.***", "***", "console.aws.***.***", "***", "***", "***", None]
    df = spark.createDataFrame([(1,)], "x int")
    assert with_masked_ip(df).columns == ["x"]


def test_classify_service(spark):
    values = [
        "ListUsers", "GetUserPolicy", " DescribeX", "describeX", "", None, "GetObjectAcl", "AttachRole", "Run", "GetPolicyX",
        "TerminateInstances", " Stop",
    ]
    assert apply(spark, values, c.classify_service) == [
        "s3", "iam", "ec2", "other_services", "other_services", "other_services", "s3", "iam", "ec2", "iam", "ec2", "ec2",
    ]


def test_normalize_boolean(spark):
    values = ["TRUE", " 1 ", "yes", None, "False", "0", "1.0", "\ttrue\n"]
    assert apply(spark, values, c.normalize_boolean) == [1, 1, 0, 0, 0, 0, 0, 1]
    assert apply(spark, [1.0, 0.0], c.normalize_boolean, "double") == [0, 0]
    assert apply(spark, [True, False], c.normalize_boolean, "boolean") == [1, 0]


def test_divisions(spark):
    pairs = [(1.0, 2.0), (1.0, 0.0), (None, 2.0), (1.0, None), (float("inf"), 2.0), (float("nan"), 1.0)]
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "i int, a double, b double")
    safe = sorted(rows(df.select("i", c.safe_divide(F.col("a"), F.col("b")))))
    assert [r[1] for r in safe] == [0.5, 0.0, 0.0, 0.0, 0.0, 0.0]
    guarded = sorted(rows(df.limit(4).select("i", c.guarded_ratio(F.col("a"), F.col("b")))))
    assert [r[1] for r in guarded] == [0.5, 0.0, 0.0, 0.0]


def test_float_text_is_the_shortest_decimal(spark):
    values = [round(k * 0.000004, 8) for k in [1, 2, 3, 5, 25, 26, 100, 249, 250, 251, 2500, 25_000, 1_000_000, 123_457]]
    values += [0.0, 0.5, -0.00012, 0.00099999, 1234.5, 5e-05]
    assert apply(spark, values, c.float_text, "double") == [repr(v) for v in values]


def test_risk_level_is_strictly_above(spark):
    assert apply(spark, [2.5, 2.5001, 2.4999, None], c.risk_level, "double") == ["normal", "alto", "normal", "normal"]


def test_clean_logs_keeps_null_ids_and_drops_copies(spark):
    raw = spark.createDataFrame(
        [
            ("2024-01-06T23:59:59Z", "ListUsers", None, "1.2.3.4", "e"),
            ("2024-01-06T23:59:59Z", "ListUsers", None, "1.2.3.4", "e"),
            ("bad", "ListUsers", "7", "1.2.3.4", "e"),
            ("2024-01-06T23:59:59Z", None, "7", "1.2.3.4", "e"),
            (None, "ListUsers", "7", "1.2.3.4", "e"),
        ],
        "EventTime string, EventName string, userIdentityAccountId string, sourceIPAddress string, errorCode string",
    )
    found = clean_logs(raw)
    assert found.columns == [
        "timestamp", "user_hash", "event", "resource", "hour", "day_of_week", "is_weekend", "masked_ip", "errorcode",
    ]
    assert rows(found) == [
        (dt.datetime(2024, 1, 6, 23, 59, 59), None, "ListUsers", "unknown", 23, 5, 1, "1.2.***.***", "e")
    ]
