"""Queries over the whole table."""

from pyspark.sql import functions as F
from pyspark.sql.classic.dataframe import DataFrame

from sluiceway.operators.validate import FILE_EXPIRED, IN_CACHE_PENDING, IN_LOG, OK, is_new_file, with_verdicts
from sluiceway.plans import catalog
from sluiceway.sources.filelog import Entry, FileLog


def test_newness_by_trigger(spark):
    files = spark.createDataFrame([(0, "a"), (1, "a"), (1, "b"), (2, "b"), (2, "c")], "trigger_id long, path string")
    log = spark.createDataFrame([(0, "a", 5), (1, "b", 1)], "trigger_id long, path string, event_ms long")
    assert sorted(map(tuple, is_new_file(files, log, by="trigger_id").collect())) == [(0, "a"), (1, "b"), (2, "c")]
    assert sorted(map(tuple, is_new_file(files, log, 3, by="trigger_id").collect())) == [(0, "a"), (1, "b"), (2, "b"), (2, "c")]


def test_newness_judges_files_of_all_triggers(spark, sf_dir):
    new = catalog.queries()["is_new_file"](spark, sf_dir)
    assert new.count() == catalog.first_files(spark, sf_dir).count()  # each path is new once
    assert new.agg(F.countDistinct("trigger_id")).first()[0] > 1


def test_filling_a_log(spark, tmp_path):
    with FileLog(spark, f"file://{tmp_path}/log") as log:
        files = spark.createDataFrame([(0, "a", 1), (2, "b", 2), (3, "c", 3)], "batch_id long, path string, event_ms long")
        assert log.fill(files, 2) and not log.fill(files, 2) and log.latest_batch_id() == 2
        assert log.get(1).collect() == [] and log.add(3, [Entry("d", 4)]) and not log.add(2, [])
        assert sorted((r.batch_id, r.path) for r in log.range().collect()) == [(0, "a"), (2, "b"), (3, "d")]


def test_the_whole_log_is_written(spark):
    sf_dir = "/root/testdata/sf0.01"  # 29 batches
    log, files = catalog._written(spark, sf_dir, 7), catalog.logged(spark, sf_dir)
    last = files.agg(F.max("batch_id")).first()[0]
    assert last > 7 and log.latest()[0] == log.latest_batch_id() == last and log.batch_ids() == [last - 2, last - 1, last]
    assert log.range().count() == files.count()


def test_acknowledgement_groups_of_all_batches(spark, sf_dir):
    got = catalog.queries()["delete_subbatches"](spark, sf_dir).toPandas()
    assert len(got) == catalog.logged(spark, sf_dir).count() and got.batch_id.nunique() > 1
    assert (got.groupby(["batch_id", "group"]).size() <= 10).all() and (got.groupby("batch_id").group.min() == 0).all()


def test_verdicts_by_trigger(spark):
    files = spark.createDataFrame([(0, "a", 5, 0), (1, "a", 6, 3), (2, "a", 7, 6), (1, "b", 6, 3), (2, "b", 8, 6), (2, "c", 5, 6)], "trigger_id long, path string, event_ms long, floor_ms long")
    log = spark.createDataFrame([(0, "a", 5), (1, "b", 6)], "trigger_id long, path string, event_ms long")
    pending = spark.createDataFrame([(1, "b", False)], "trigger_id long, path string, processed boolean")
    got = with_verdicts(files, pending, log, F.col("floor_ms"), by="trigger_id").collect()
    assert {(r.trigger_id, r.path): r.verdict for r in got} == {(0, "a"): OK, (1, "a"): IN_LOG, (2, "a"): OK, (1, "b"): IN_CACHE_PENDING, (2, "b"): IN_LOG, (2, "c"): FILE_EXPIRED}


def test_every_file_gets_a_verdict(spark):
    sf_dir = "/root/testdata/sf0.1"
    counts = {r.verdict: r.n for r in catalog.queries()["verdict_counts"](spark, sf_dir).collect()}
    assert sum(counts.values()) == catalog.created(spark, sf_dir).count() and counts[IN_LOG] > 0


def test_all_partitions_are_read_back(spark, sf_dir):
    got = catalog.queries()["partition_columns"](spark, sf_dir)
    assert got.count() == catalog.table(spark, sf_dir, "events").count()
    assert sorted(r.bucket_no for r in got.select("bucket_no").distinct().collect()) == list(range(7))


def test_a_race_holds_no_table_in_the_driver(spark, monkeypatch):
    most, collect = [], DataFrame.collect
    monkeypatch.setattr(DataFrame, "collect", lambda self: (got := collect(self), most.append(len(got)))[0])
    raced = catalog.queries()["log_race"](spark, "/root/testdata/sf0.01")  # 29 batches
    assert max(most, default=0) <= 1
    assert raced.count() == 29 and raced.agg(F.max("writers")).first()[0] == 1
