"""Memory of Python workers: what a task holds at once is bounded by small slices, not by its input."""

from types import SimpleNamespace

import numpy as np
import pyarrow as pa

from siftwell.llm import common, packing, sadedup


def test_packing_with_ids_takes_small_slices_and_gives_memory_back(monkeypatch):
    seen, given_back = [], []

    class Bpe:
        final = [0] * 256

        def encode_column(self, texts, arrays):
            seen.append(sum(map(len, texts)))
            return np.ones(len(texts), np.uint32), np.ones(len(texts), np.int64)

    monkeypatch.setattr(packing, "load", lambda path: Bpe())
    monkeypatch.setattr(packing, "_source", lambda *a: None)
    monkeypatch.setattr(packing, "in_arrow", lambda df, run, *a, **b: run)
    monkeypatch.setattr(packing, "TaskContext", SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: 0)))
    monkeypatch.setattr(common, "released", lambda: given_back.append(1))
    kind = SimpleNamespace(dataType=SimpleNamespace(simpleString=lambda: "bigint"))
    run = packing.pack_documents(SimpleNamespace(schema={"doc_id": kind}), "")
    batch = pa.RecordBatch.from_arrays([pa.array(range(600)), pa.array(["x" * 10_000] * 600)], names=["doc_id", "text"])
    out = pa.Table.from_batches(run(iter([batch])))
    assert sorted(set(out["doc_id"].to_pylist())) == list(range(600))
    assert sum(seen) == 6_000_000 and max(seen) <= 1 << 20
    assert len(given_back) == len(seen)


def test_suffix_arrays_of_a_task_are_of_small_chunks_of_whole_groups(monkeypatch):
    solved = []

    def later(segments, documents, places):
        solved.append(sum(map(len, segments)))
        return [np.zeros(len(s) - sadedup.WIDTH + 1, bool) for s in segments]

    monkeypatch.setattr(sadedup, "later_windows", later)
    n = 20_000
    columns = [pa.array([i // 10 for i in range(n)]), pa.array([0] * n), pa.array(range(n)), pa.array([0] * n), pa.array([b"x" * 150] * n, pa.binary())]
    batch = pa.RecordBatch.from_arrays(columns, names=["key", "part", "d", "place", "segment"])
    assert not list(sadedup._chunk_rows(iter([batch])))
    assert sum(solved) == 150 * n and max(solved) < (1 << 19) + 1500
    assert all(s % 1500 == 0 for s in solved)


def test_tables_of_the_rolling_hash_go_when_other_operators_run():
    sadedup.anchors(np.zeros(200, np.uint8))
    common.let_go("sadedup")
    assert sadedup._powers
    common.let_go("bpe")
    assert not sadedup._powers
