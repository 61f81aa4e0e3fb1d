import time
from concurrent.futures import ThreadPoolExecutor

import pytest

from sluiceway.sources import files as files_module
from sluiceway.sources.filelog import Entry, FileLog


@pytest.fixture
def log(spark, tmp_path):
    with FileLog(spark, f"file://{tmp_path}/log") as log:
        yield log


def entries(*times):
    return [Entry(f"/p{t}_{i}", t) for i, t in enumerate(times)]


def files(df):
    return sorted((r.batch_id, r.path, r.event_ms) for r in df.collect())


def test_add_and_get(log):
    assert log.latest_batch_id() == -1 and log.latest() is None and log.get(0) is None
    assert log.add(0, entries(1, 2), commit_ms=5)
    assert not log.add(0, entries(9))
    assert files(log.get(0)) == [(0, "/p1_0", 1), (0, "/p2_1", 2)]
    assert log.latest()[0] == 0
    with pytest.raises(ValueError):
        log.add(-1, [])
    with pytest.raises(ValueError):
        log.add(1, None)
    with pytest.raises(NotImplementedError):
        log.purge(1)


def test_empty_batches_count(log):
    log.add(0, [], floor_ms=7)
    log.add(1, entries(3))
    assert log.floor() == 7 and files(log.range()) == [(1, "/p3_0", 3)] and log.get(0).collect() == []


def test_ranges(log):
    for i in (0, 1, 2):
        log.add(i, entries(i))
    assert [b for b, _, _ in files(log.range(0, 2))] == [b for b, _, _ in files(log.range())] == [0, 1, 2]
    log.add(4, entries(4))
    with pytest.raises(ValueError, match="batch 3 not found"):
        log.range(0, 4)


def test_newness(log):
    log.add(0, [Entry("a", 1000), Entry("b", 3000)])
    assert not log.is_new_file("a", -4000) and log.is_new_file("a", 3000) and not log.is_new_file("b", 3000)
    assert log.is_new_file("c", 0) and log.get_file("a") == 1000 and log.get_file("c") is None


def test_cleaning(log):
    for batch, times, commit in ((1, (100, 100), 300), (2, (200, 200), 300), (6, (300, 600), 600), (15, (1500, 1500), 5000)):
        log.add(batch, entries(*times), commit_ms=commit)
    assert log.clean(1500 - 1000) == [1, 2] and log.batch_ids() == [6, 15]
    log.add(35, entries(3500, 3500), commit_ms=5000)
    log.add(50, entries(8000, 8000), commit_ms=9000, clean_floor_ms=7000)
    assert log.batch_ids() == [50]


def test_at_most_so_many_are_cleaned(log):
    for i in range(5):
        log.add(i, entries(i), commit_ms=1)
    assert log.clean(100, limit=2) == [0, 1]


def test_compaction_keeps_what_readers_see(log):
    for i in range(5):
        log.add(i, entries(i, i + 1), commit_ms=1, floor_ms=i)
    before = files(log.to_df())
    log.compact(2)
    assert files(log.to_df()) == before and log.batch_ids() == [3, 4] and log.latest_batch_id() == 4
    log.compact()
    assert files(log.to_df()) == before and log.batch_ids() == [] and log.latest_batch_id() == 4
    assert files(log.get(1)) == [x for x in before if x[0] == 1] and not log.add(3, [])
    assert log.clean(3) == [0, 1] and files(log.to_df()) == [x for x in before if x[0] > 1]
    assert log.floor() == 4 and log.add(5, entries(9))
    assert log.show_all().count() == 3 * 3 + 2


def test_one_of_several_writers_succeeds(spark, tmp_path):
    logs = [FileLog(spark, f"file://{tmp_path}/log") for _ in range(6)]
    with ThreadPoolExecutor(6) as pool:
        for batch in range(8):
            done = list(pool.map(lambda w: logs[w].add(batch, [Entry(f"{w}", 1)] * 3), range(6)))  # noqa: B023
            assert sum(done) == 1
            assert {r.path for r in logs[0].get(batch).collect()} == {str(done.index(True))}


def test_a_dead_writers_claim_is_taken_over(log, spark):
    claim = ".batches-batch_id=0.claim"
    assert log.folder.create_new(claim) and not log.folder.create_new(claim)
    assert not log.add(0, entries(1))
    time.sleep(0.05)
    log.folder.make("aside/x")
    assert log.folder.move_new("aside/x", "batches/batch_id=0", stale_ms=10) and not log.folder.exists(claim)


def test_open_tables_survive_a_compaction(log):
    for i in range(4):
        log.add(i, entries(i))
    before = log.to_df()
    log.compact(2)
    assert before.count() == 4
    half = log.to_df()
    log.compact(3)
    assert half.count() == log.to_df().count() == 4


def test_lookups_are_pushed_down(log, spark):
    log.add(0, entries(*range(50)))
    log.compact()
    found = log.to_df().filter("path = '/p7_7'")
    assert "EqualTo(path,/p7_7)" in found._jdf.queryExecution().toString() and found.count() == 1
    paths = spark.createDataFrame([("/p7_7",), ("/p9_9",), ("none",)], "path string")
    assert sorted(r.event_ms for r in log.times_of(paths).collect()) == [7, 9] and [r.event_ms for r in log.times_of(paths, 8).collect()] == [9]


def test_losing_writers_write_nothing(spark, tmp_path, monkeypatch):
    written, write = [], files_module.Folder.write
    monkeypatch.setattr(files_module.Folder, "write", lambda self, name, data: (written.append(name), time.sleep(0.02), write(self, name, data)))
    logs = [FileLog(spark, f"file://{tmp_path}/log") for _ in range(4)]
    with ThreadPoolExecutor(4) as pool:
        for batch in range(8):
            assert sum(pool.map(lambda w: logs[w].add(batch, [Entry(f"{w}", 1)]), range(4))) == 1  # noqa: B023
    assert len(written) == 8 and logs[0].folder.names("aside") == []


def test_adding_to_a_local_log_asks_nothing_of_the_jvm(log, spark, monkeypatch):
    asked, client = [], type(spark._jvm._gateway_client)
    send = client.send_command
    monkeypatch.setattr(client, "send_command", lambda self, command, *a, **k: (asked.append(command) if not command.startswith("m\n") else None, send(self, command, *a, **k))[1])
    assert log.add(0, entries(1)) and log.add(1, entries(2)) and not log.add(1, entries(3)) and log.batch_ids() == [0, 1]
    assert asked == []
    assert files(log.range()) == [(0, "/p1_0", 1), (1, "/p2_0", 2)] and asked


def test_a_failed_writer_leaves_the_batch_to_others(log, monkeypatch):
    def fail(name, data):
        raise OSError("no room")

    with monkeypatch.context() as m:
        m.setattr(log.folder, "write", fail)
        with pytest.raises(OSError, match="no room"):
            log.add(0, entries(1))
    assert log.latest_batch_id() == -1 and log.folder.names("aside") == [] and log.add(0, entries(2))


def test_a_log_on_any_file_system(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(files_module, "_LOCAL", ())
    with FileLog(spark, f"file://{tmp_path}/log, and more") as log:
        assert log.folder.names("none") == [] and log.folder.age_ms("none") == 0
        for i in range(3):
            assert log.add(i, entries(i)) and not log.add(i, entries(9))
        assert log.batch_ids() == [0, 1, 2] and 0 <= log.folder.age_ms("batches/batch_id=0") < 60_000
        assert log.folder.create_new("x") and not log.folder.create_new("x") and log.folder.delete("x") and not log.folder.exists("x")
        log.compact(1)
        assert log.batch_ids() == [2] and [b for b, _, _ in files(log.range())] == [0, 1, 2]


def test_many_batches_are_read(log, spark):
    for i in range(70):  # more than are listed by the driver
        log.add(i, entries(i))
    before = spark.conf.get("spark.sql.sources.parallelPartitionDiscovery.parallelism")
    assert len(files(log.range())) == 70 and spark.conf.get("spark.sql.sources.parallelPartitionDiscovery.parallelism") == before
