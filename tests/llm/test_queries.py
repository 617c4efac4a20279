"""Registered queries against their oracle SQL, and the pipeline's stages."""

import os
import sys

import duckdb
import pytest

from conftest import ROOT, SF_SMALL

sys.path.insert(0, os.path.join(ROOT, "scripts"))

from check_oracle import compare, register_tables  # noqa: E402
from lastmile.llm import oracle, queries  # noqa: E402
from lastmile.llm.packing import Encoder, tokenizer_path  # noqa: E402


@pytest.mark.parametrize("name", sorted(oracle.oracle_sql()))
def test_query_matches_oracle(spark, name):
    con = duckdb.connect()
    register_tables(con, SF_SMALL)
    result = compare(queries.queries()[name](spark, SF_SMALL), con, oracle.oracle_sql()[name])
    assert result["status"] == "ok", result["issues"]


def test_all_operators():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.queries()) == list(range(1, 14))


def test_pipeline_stages(spark, odd_docs):
    import corpus_pipeline as C
    from lastmile.llm.store import written

    docs, seen = odd_docs, []
    for name, stage in C.STAGES[:4]:
        docs = written(stage(spark, docs, SF_SMALL), f"test-{name}")
        assert docs.columns == odd_docs.columns
        seen.append(sorted((r.doc_id or 0) for r in docs.select("doc_id").collect()))
    # The last stage packs exactly what mixing kept, each row as often as it is there.
    encoder = Encoder(tokenizer_path())
    tokens = sum(len(encoder.encode(r.text)) for r in docs.collect())
    packed = C.packing_stage(spark, docs, SF_SMALL).collect()
    assert sum(p.length for p in packed) == tokens and set(seen[3]) <= set(seen[2])
    assert {p.doc_id or 0 for p in packed} == set(seen[3])
    assert not {4, 5, 6, 7} & set(seen[0])
    assert {1, 8, 10} <= set(seen[2]) and 2 not in seen[2] and 3 not in seen[2] and seen[2].count(1) == 1


def test_mixing_stage_does_not_repeat_toxic(spark, tmp_dir):
    """Toxic documents that stage 2 missed get no share of the mix."""
    import corpus_pipeline as C

    kind = ["toxic" if i % 50 == 0 else "low" if i % 10 == 1 else "good" for i in range(400)]
    marked = {"toxic": " grub snark", "low": " zig zag zog", "good": ""}
    words = [" ".join(f"v{(i * 7 + j * 13) % 50}" + "abcdefghij"[(i + j) % 10] for j in range(40)) for i in range(400)]
    docs = spark.createDataFrame([(i, words[i] + marked[kind[i]]) for i in range(400)], "doc_id bigint, text string")
    rows = [(i, int(kind[i] == "good"), int(kind[i] == "toxic")) for i in range(400)]
    spark.createDataFrame(rows, "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_dir}/labels.parquet")
    out = [r.doc_id for r in C.mixing_stage(spark, docs, tmp_dir).collect()]
    toxic = [i for i in out if kind[i] == "toxic"]
    assert len(toxic) == len(set(toxic)) and len(toxic) <= 2
    assert len({i for i in out if kind[i] == "good"}) > 200


def test_pipeline_of_no_documents(spark, no_docs, tmp_dir):
    """Empty documents and empty labels go through all stages."""
    import corpus_pipeline as C

    no_docs.write.parquet(f"{tmp_dir}/documents.parquet")
    spark.createDataFrame([], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_dir}/labels.parquet")
    assert C.run(spark, tmp_dir).count() == 0
