import pytest
from pyspark.sql import functions as F

from sluiceway.functions.durations import duration_ms
from sluiceway.functions.globs import glob_to_regex, matches_glob
from sluiceway.functions.notifications import CREATED_FILE, DISCARDED, UNPARSEABLE, created_files, discarded, notification_body, parse
from sluiceway.sources.client import parse_message
from sluiceway.sources.queue import Message, notification


@pytest.mark.parametrize(
    ("glob", "yes", "no"),
    [
        ("*1.csv", ["/path/test1.csv", "/path/test21.csv"], ["/path/test1", "/path/test2.csv", "/path/test1.json"]),
        ("*/partition=1*/*", ["/path/partition=1/test1", "/path/partition=11/test1.csv"], ["/path/partition=2/test1.csv"]),
        ("a?c", ["abc", "a/c"], ["ac", "abbc"]),
        ("{a,b{c,d}}x", ["ax", "bcx", "bdx"], ["bx", "cx"]),
        ("[a-c]1[!x]", ["a1y", "c1-"], ["d1y", "a1x"]),
        ("a\\*b", ["a*b"], ["axb"]),
        ("a.b+(c)|$", ["a.b+(c)|$"], ["axb+(c)|$"]),
        ("x,y", ["x,y"], ["x"]),
        ("*", ["", "a\nb"], []),
    ],
)
def test_globs(spark, glob, yes, no):
    df = spark.createDataFrame([(p, True) for p in yes] + [(p, False) for p in no], "path string, want boolean")
    assert df.filter(matches_glob(F.col("path"), glob) != F.col("want")).collect() == []


@pytest.mark.parametrize("glob", ["a\\", "{a", "[a"])
def test_bad_globs(glob):
    with pytest.raises(ValueError):
        glob_to_regex(glob)


def test_durations():
    assert [duration_ms(x) for x in ("15d", "10s", "500ms", "2h", "3min", "3m", "7")] == [1_296_000_000, 10_000, 500, 7_200_000, 180_000, 180_000, 7]
    with pytest.raises(ValueError):
        duration_ms("soon")


CREATED = notification("testbucket", "valPartition%3Dpart1678486410_0/part-00000-created.csv", "2023-02-14T22:53:31.748Z")
REMOVED = CREATED.replace("ObjectCreated:Put", "ObjectRemoved:Delete")
PATH = "s3://testbucket/valPartition=part1678486410_0/part-00000-created.csv"


def outcomes(spark, body, **options):
    df = spark.createDataFrame([(body,)], "body string")
    return [(r.outcome, r.path, r.event_ms) for r in parse(df, **options).collect()]


def test_notifications(spark):
    assert outcomes(spark, CREATED) == [(CREATED_FILE, PATH, 1676415211748)]
    assert outcomes(spark, REMOVED) == [(DISCARDED, None, None)]
    for bad in ('{"Records":"bad message"}', "not json", '{"Records":[]}', "", None, CREATED.replace("2023-02-14T", "x")):
        assert outcomes(spark, bad) == [(UNPARSEABLE, None, None)], bad


def test_many_records_and_envelopes(spark):
    import json

    both = json.dumps({"Records": json.loads(CREATED)["Records"] + json.loads(notification("b", "a+b%2Bc", "2023-02-14T22:53:31.000Z"))["Records"]})
    assert [o[1] for o in outcomes(spark, both)] == [PATH, "s3://b/a b+c"]
    assert [o[1] for o in outcomes(spark, both, first_record_only=True)] == [PATH]
    assert outcomes(spark, json.dumps({"Type": "Notification", "Message": CREATED}))[0][1] == PATH


def test_times_do_not_depend_on_the_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        assert outcomes(spark, CREATED)[0][2] == 1676415211748
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_split_and_round_trip(spark):
    df = spark.createDataFrame([(CREATED,), (REMOVED,), ("x",)], "body string")
    assert created_files(df).count() == 1 and discarded(df).count() == 2
    made = spark.range(1).select(notification_body(F.lit("b"), F.lit("k=1/ü .csv"), F.lit("ObjectCreated:Put"), F.lit("2023-02-14T22:53:31.748Z")).alias("body"))
    assert created_files(made).first().path == "s3://b/k=1/ü .csv"


@pytest.mark.parametrize("at", ["2024-01-03T00:00:00.123Z", "2024-01-03T00:00:00Z", "2024-01-03T00:00:00.1Z", "2024-01-03T23:59:59.123456Z", "2024-02-29T00:00:00.123456789Z", "1969-12-31T23:59:59.999Z", "2023-02-29T00:00:00Z", "2024-01-03", "2024-01-03T00:00:00.Z", "2024-01-03T00:00:00", "2024-01-03T00:00:00.123+01:00", "2024-13-03T00:00:00Z", "yesterday", "", "2024-01-03T00:00:00Z\n"])
@pytest.mark.parametrize("key", ["a.csv", "p%3D1/x+y%20z.csv", "bad%zz", "cut%2", "%C3%A9", "100%"])
def test_both_parsers_agree(spark, at, key):
    body = notification("b", key, at)
    files, others, bad = parse_message(Message(body, "r", "m"))
    rows = parse(spark.createDataFrame([(body,)], "body string")).collect()
    assert [(f.path, f.event_ms) for f in files] == [(r.path, r.event_ms) for r in rows if r.outcome == CREATED_FILE]
    assert bad == sum(r.outcome == UNPARSEABLE for r in rows) and others == 0
