"""Ids near 2**63 beside nulls: pandas would round them, no operator may."""

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from lakeproof.llm import queries as q

TOP = (1 << 63) - 1
BOTTOM = -(1 << 63)


@pytest.fixture(scope="module")
def huge(tables, tmp_path_factory):
    """The awkward tables with doc_ids of both ends of a long; every ninth is null."""
    folder = tmp_path_factory.mktemp("huge")
    docs = pq.read_table(f"{tables}/documents.parquet")
    ids = [None if i % 9 == 4 else BOTTOM + i if i % 2 else TOP - i for i in range(docs.num_rows)]
    docs = docs.set_column(0, "doc_id", pa.array(ids, pa.int64()))
    pq.write_table(docs, folder / "documents.parquet")
    kept = [i for i in ids if i is not None]
    pq.write_table(pa.table({"doc_id": pa.array(kept, pa.int64()),
                             "quality": pa.array([int(i % 3 > 0) for i in range(len(kept))], pa.int32()),
                             "toxic": pa.array([int(i % 5 == 0) for i in range(len(kept))], pa.int32())}),
                   folder / "labels.parquet")
    pq.write_table(pq.read_table(f"{tables}/benchmark.parquet"), folder / "benchmark.parquet")
    return str(folder), list(zip(ids, docs["text"].to_pylist()))


def _key(i):
    return (i is not None, i or 0)


@pytest.mark.parametrize("name", ["op1_suffix_dedup", "op2_co_training_quality", "op4_feistel_sharding",
                                  "op7_token_files", "op8_separator_scan", "op10_minhash_near_dedup",
                                  "op12_merkle_manifest", "op13_doubling_substring_dedup"])
def test_ids_come_back_as_they_were(spark, huge, name):
    folder, rows = huge
    got = [r["doc_id"] for r in q.QUERIES[name](spark, folder).select("doc_id").collect()]
    assert sorted(got, key=_key) == sorted((i for i, _ in rows), key=_key)


def test_near_copies_are_linked_by_exact_ids(spark, huge):
    folder, rows = huge
    texts = {}
    for i, t in rows:
        if i is not None and t and len(t.split()) >= 5:
            texts.setdefault(t, set()).add(i)
    of = {r["doc_id"]: r for r in q.QUERIES["op10_minhash_near_dedup"](spark, folder).collect()}
    known = {i for i, _ in rows}
    for i, r in of.items():
        assert i is None or (r["component_id"] in known and r["kept"] == (r["component_id"] == i))
    for ids in texts.values():
        assert len({of[i]["component_id"] for i in ids}) == 1


def test_pieces_and_token_files_name_exact_ids(spark, huge):
    folder, rows = huge
    pieces = q.QUERIES["op5_best_fit_packing"](spark, folder).where("piece = 0").collect()
    assert sorted((r["doc_id"] for r in pieces), key=_key) == sorted((i for i, _ in rows), key=_key)
    files = q.QUERIES["op7_token_files"](spark, folder).collect()
    order = sorted(files, key=lambda r: r["start"])
    assert [r["doc_id"] for r in order] == sorted((i for i, _ in rows), key=_key)
    assert [r["start"] for r in order[1:]] == [r["start"] + r["n_tokens"] for r in order[:-1]]


def test_pipeline_stages_keep_ids(spark, huge):
    import corpus_pipeline as cp
    folder, rows = huge
    docs, known = spark.read.parquet(f"{folder}/documents.parquet"), {i for i, _ in rows}
    for _, stage in cp.STAGES[:-1]:
        docs = stage(spark, docs, folder)
        assert {r["doc_id"] for r in docs.select("doc_id").collect()} <= known
    assert {r["doc_id"] for r in cp.packing(spark, docs, folder).collect()} <= known
