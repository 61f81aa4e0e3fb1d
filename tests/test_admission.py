import pytest
from pyspark.sql import functions as F

from sluiceway.operators import admission
from sluiceway.operators.pending import Pending, PendingFiles
from sluiceway.operators.validate import ADMIT, DROP, KEEP, RETRY, action, is_new_file, with_verdicts

FILES = "path string, event_ms long"


def test_verdicts(spark):
    files = spark.createDataFrame([(f"/path/test{i}", 1000) for i in range(4)] + [("/path/test1", 10), ("/other", 1000)], FILES)
    pending = spark.createDataFrame([("/path/test1", False), ("/path/test2", True)], "path string, processed boolean")
    log = spark.createDataFrame([("/path/test3", 1000), ("/path/test0", 50)], FILES)
    out = {(r.path, r.event_ms): (r.verdict, r.keep, r.drop) for r in with_verdicts(files, pending, log, 100, "/path/*").withColumns({"keep": action(F.col("verdict"), True), "drop": action(F.col("verdict"))}).collect()}
    assert out == {
        ("/path/test0", 1000): ("Ok", ADMIT, ADMIT),
        ("/path/test1", 1000): ("ExistInCacheNotProcessed", RETRY, RETRY),
        ("/path/test2", 1000): ("ExistInCacheProcessed", KEEP, DROP),
        ("/path/test3", 1000): ("PersistedInMetadataLog", KEEP, DROP),
        ("/path/test1", 10): ("FileExpired", KEEP, DROP),
        ("/other", 1000): ("PatternNotMatch", KEEP, DROP),
    }


def test_is_new_file(spark):
    files = spark.createDataFrame([("a", 1), ("b", 1), ("c", 1)], FILES)
    log = spark.createDataFrame([("a", 1000), ("b", 3000)], FILES)
    assert sorted(r.path for r in is_new_file(files, log).collect()) == ["c"]
    assert sorted(r.path for r in is_new_file(files, log, 3000).collect()) == ["a", "c"]


def test_batches_and_groups(spark):
    files = spark.createDataFrame([(f"p{i:02}", (i * 7919) % 23 * 40_000_000) for i in range(23)], FILES)
    out = admission.into_batches(files, 5, "event_ms", "path").collect()
    order = sorted(((r.event_ms, r.path), r.batch_id) for r in out)
    assert [b for _, b in order] == [i // 5 for i in range(23)]
    groups = admission.acknowledgement_groups(files.withColumn("batch_id", F.lit(1)), "batch_id").collect()
    assert sorted(r.group for r in groups) == [i // 10 for i in range(23)]
    assert [r.path for r in admission.oldest_first(files, 2).collect()] == [p for (_, p), _ in order[:2]]


def test_first_by_path(spark):
    files = spark.createDataFrame([("a", 3, "x"), ("a", 1, "y"), ("b", 2, "z")], "path string, event_ms long, note string")
    assert sorted(map(tuple, admission.first_by_path(files, "event_ms").collect())) == [("a", 1, "y"), ("b", 2, "z")]


CACHE = {"path1": 1000, "path2": 0, "path3": 200}


@pytest.fixture
def cache():
    c = PendingFiles(5000)
    for p, ms in CACHE.items():
        c.add(p, Pending(ms))
    return c


def names(found):
    return [p for p, _ in found]


def test_cache_order_and_limits(cache):
    assert set(names(cache.unprocessed(oldest_first=False))) == set(CACHE)
    assert names(cache.unprocessed()) == ["path2", "path3", "path1"]
    assert names(cache.unprocessed(2)) == ["path2", "path3"]
    cache.mark_processed("path2")
    assert set(names(cache.unprocessed(oldest_first=False))) == {"path1", "path3"}
    assert cache.newness("path2") == "ExistInCacheProcessed" and cache.newness("path1") == "ExistInCacheNotProcessed" and cache.newness("x") == "Ok"


def test_cache_ageing():
    c = PendingFiles(5000)
    for p, ms in {"path1": 0, "path2": 1000, "path3": 6000}.items():
        c.add(p, Pending(ms))
    assert c.purge() == 1 and c.floor_ms == 1000
    c.add("path4", Pending(100))
    c.add("path5", Pending(200))
    assert set(names(c.unprocessed())) == {"path2", "path3"}
    assert c.purge() == 2 and len(c) == 2


def test_first_writer_wins_and_clocks_never_go_back(cache, spark):
    assert cache.add_if_absent("path1", Pending(9000)).event_ms == 1000
    assert cache.latest_ms == 9000
    cache.add("late", Pending(5))
    assert cache.latest_ms == 9000
    cache.purge()
    floor = cache.floor_ms
    cache.purge()
    assert cache.floor_ms == floor == 4000
    assert cache.to_df(spark).count() == len(cache)
    with pytest.raises(ValueError):
        PendingFiles(-1)


def test_floors_by_trigger(spark):
    files = spark.createDataFrame([(0, 100), (1, 50), (2, 500), (3, 10)], "trigger_id long, event_ms long")
    assert {r.trigger_id: r.floor_ms for r in admission.floors_by_trigger(files, 60).collect()} == {0: None, 1: 40, 2: 40, 3: 440}
