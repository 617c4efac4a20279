"""Intermediate tables go once a step's result stands, and no sooner."""

import os

import pytest
from pyspark.sql import functions as F

from lastmile.llm import langid, minmax_dedup, mixing, store, toxicity


def _tables(spark):
    folder = store.shared_path(spark, "x").rsplit("/", 1)[0].removeprefix("file:")
    return {f.rsplit("-", 1)[0] + "/" + f for f in os.listdir(folder)}


def _new(spark, before):
    return sorted(t.split("/")[0] for t in _tables(spark) - before)


def test_scratch_deletes_its_own_tables_only(spark):
    before = _tables(spark)
    outside = store.written(spark.range(3), "outside")
    with store.scratch():
        a = store.written(spark.range(5), "inner")
        with store.scratch():
            kept = store.written(a.filter("id > 1"), "kept", keep=True)
            store.written(kept, "innermost")
        assert _new(spark, before) == ["inner", "kept", "outside"]
        last = store.written(kept.filter("id > 2"), "last", keep=True)
    assert _new(spark, before) == ["last", "outside"]
    assert sorted(r.id for r in last.collect()) == [3, 4] and outside.count() == 3


def test_scratch_deletes_after_an_error(spark):
    before = _tables(spark)
    with pytest.raises(ZeroDivisionError), store.scratch():
        store.written(spark.range(5), "inner")
        1 / 0
    assert _new(spark, before) == [] and store._OPEN.get() == ()


def test_operators_of_the_pipeline_leave_only_what_their_results_read(spark, odd_docs, labels):
    before = _tables(spark)
    kept = minmax_dedup.one_of_each(odd_docs)
    assert _new(spark, before) == ["minmax-found", "minmax-rows"]
    assert sorted(r.doc_id for r in kept.filter("doc_id in (1, 2, 3, 8, 9)").collect()) == [1, 8]
    before = _tables(spark)
    n = odd_docs.count()
    fold = F.coalesce(F.col("doc_id") % 2 == 1, F.lit(False))
    assert toxicity.score(odd_docs, labels, train=fold, calibrate=~fold).count() == n
    assert langid.identify(odd_docs, fold).count() == n
    assert _new(spark, before) == []
    assert mixing.rates(odd_docs, labels).count() == n
    assert _new(spark, before) == ["mixing-posteriors"]


def test_a_whole_pipeline_keeps_its_stages_only(spark, odd_docs, tmp_dir, monkeypatch):
    import corpus_pipeline as C

    odd_docs.write.parquet(f"{tmp_dir}/documents.parquet")
    before = _tables(spark)
    monkeypatch.setattr(C, "STAGES", C.STAGES[2:3])
    packed = C.run(spark, tmp_dir)
    assert _new(spark, before) == ["pipeline-near_dedup"] and packed.filter("doc_id = 1").count() == 1
