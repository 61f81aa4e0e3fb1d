import collections
import hashlib
import re

import pytest

import corpus_pipeline
from sluiceway.llm import catalog, common
from sluiceway.llm.common import materialize, row_hash
from sluiceway.llm.exact_dedup import drop_copies
from sluiceway.llm.jaccard_join import keep_one_of_each
from sluiceway.llm.mixing import draw, mix
from tests.llm import brute


@pytest.fixture(scope="module")
def stages(spark, documents, sf_dir):
    """Each stage's input and output, as the pipeline makes them."""
    docs, out = documents, {}
    for name, f in corpus_pipeline.STAGES:
        done = materialize(f(spark, docs, sf_dir))
        out[name] = (docs, done)
        docs = done
    return out


def rows(df):
    return [(r.doc_id, r.text) for r in df.collect()]


def test_columns_are_kept(stages, documents):
    for name, (_, after) in stages.items():
        if name != "packing":
            assert after.columns == documents.columns


def test_languages_keep_clean_documents(stages):
    before, after = stages["language_id"]
    assert after.count() >= 0.97 * before.filter("text rlike '\\\\p{L}'").count()


def test_copies_go(stages):
    before, after = stages["exact_dedup"]
    bare = lambda t: hashlib.sha256(re.sub(r"[\x20\x09-\x0D]", "", t or "").encode()).digest()
    best = {}
    for i, t in rows(before):
        best[bare(t)] = min(best.get(bare(t), (0, 1 << 60)), (-len(t), i))
    assert {i for i, _ in rows(after)} == {i for _, i in best.values()} and after.count() == len(best)


def test_near_copies_go(stages):
    before, after = stages["near_duplicates"]
    found = brute.jaccard_components(rows(before), 5, 80, 100)
    assert sorted(i for i, _ in rows(after)) == sorted({c for _, c in found})


def test_sources_are_mixed(stages):
    before, after = stages["mixing"]
    size = {i: len(brute.words(t)) for i, t in rows(before)}
    targets = {r.doc_id: r.target for r in mix(before).collect()}
    source, taken, most = {r.doc_id: r.source for r in before.collect()}, collections.Counter(), collections.Counter()
    for i, _ in rows(after):
        taken[source[i]] += size[i]
        most[source[i]] = max(most[source[i]], size[i])
    for i, s in source.items():
        assert abs(taken[s] - targets[i]) <= max(size[j] for j in source if source[j] == s)
    assert max(collections.Counter(i for i, _ in rows(after)).values()) <= 3


def test_all_are_packed(stages):
    before, after = stages["packing"]
    assert collections.Counter(i for i, _ in rows(before)) == collections.Counter(r.doc_id for r in after.filter("piece = 0").collect())
    assert all(r.offset + r.length <= 4096 for r in after.collect())


def test_run_gives_the_same(spark, sf_dir, stages):
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert sorted(corpus_pipeline.run(spark, sf_dir).select(names).collect()) == sorted(stages["packing"][1].select(names).collect())


def test_odd_rows_pass_all_stages(spark, odd, empty):
    for docs in (odd, empty):
        for name, f in corpus_pipeline.STAGES:
            docs = materialize(f(spark, docs, ""))
            if name != "packing":
                assert docs.columns == odd.columns
        docs.collect()


def test_rows_that_differ_in_another_column_only_are_not_mixed_up(spark):
    text = "one text of more than five words that two sources have"
    docs = spark.createDataFrame([(1, text, "a"), (1, text, "b"), (2, "something else of that source a", "a"), (3, "and this is from the source b", "b"), (None, "x y z", "a"), (None, "x y z", "b"), (None, "x y z", "b")], "doc_id long, text string, source string")
    taken = collections.Counter((r.doc_id, r.source) for r in draw(docs, weights=(1, 1)).collect())
    assert taken[1, "a"] and taken[1, "b"] and taken[None, "a"] and taken[None, "b"]
    for keep in (drop_copies, keep_one_of_each):
        kept = collections.Counter(r.doc_id for r in keep(docs).collect())
        assert (kept[1], kept[2], kept[3], kept[None]) == (1, 1, 1, 1)


def test_names_of_rows(spark):
    docs = spark.createDataFrame([(None, "a", {"k": 1}), ("a", None, {"k": 1}), ("a", None, {"k": 2}), ("a", None, None), ("a", None, None)], "x string, `y.z` string, m map<string, int>")
    assert docs.select(row_hash(docs)).distinct().count() == 4


def test_joins_by_key_with_frequent_keys(spark, monkeypatch):
    monkeypatch.setattr(common, "HOT_KEYS", 2)
    left = spark.createDataFrame([(k, i) for k in range(5) for i in range(10 * k + 1)], "k long, i long")
    right = spark.createDataFrame([(k, 10 * k + 1, c) for k in (0, 1, 3, 4, 7) for c in ("x", "y")], "k long, held long, c string")
    want = sorted(map(tuple, left.join(right, "k").select("k", "i", "c").collect()))
    assert sorted(map(tuple, common.join_by_key(left, right, "k", "held").select("k", "i", "c").collect())) == want


def test_every_operator_is_registered():
    assert [n.partition("_")[0] for n in catalog.queries()] == [f"op{i}" for i in range(1, 11)]
    assert set(catalog.oracle_sql()) <= set(catalog.queries())


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_query_equals_its_sql(spark, sf_dir, name):
    import duckdb
    import pandas as pd

    con = duckdb.connect()
    for t in ("documents", "pages"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    frames = [catalog.queries()[name](spark, sf_dir).toPandas(), con.sql(catalog.oracle_sql()[name]).df()]
    frames = [f[sorted(f.columns)].sort_values(sorted(f.columns)).reset_index(drop=True) for f in frames]
    pd.testing.assert_frame_equal(*frames, check_dtype=False)


@pytest.mark.parametrize("name", sorted(set(catalog.queries()) - set(catalog.oracle_sql())))
def test_query_covers_its_table(spark, sf_dir, documents, name):
    df = catalog.queries()[name](spark, sf_dir)
    assert df.select("doc_id").distinct().count() == documents.count()
