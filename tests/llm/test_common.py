import pyarrow as pa

from parcelflow.llm import common


def test_pool_is_emptied_after_the_last_batch(monkeypatch):
    calls = []

    class Pool:
        def release_unused(self):
            calls.append("released")

    monkeypatch.setattr(common.pa, "default_memory_pool", Pool)
    batches = [pa.RecordBatch.from_pydict({"x": [i]}) for i in range(3)]
    seen = []
    for batch in common.released(iter(batches)):
        assert not calls
        seen.append(batch)
    assert seen == batches and calls == ["released"]
