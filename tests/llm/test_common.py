from __future__ import annotations

import pyarrow as pa

from brambling.llm import common


def test_freed_arrow_memory_goes_back_when_a_task_ends(monkeypatch):
    released = []

    class Pool:
        def release_unused(self):
            released.append(True)

    monkeypatch.setattr(common.pa, "default_memory_pool", Pool)
    batches = [pa.RecordBatch.from_pydict({"text": ["ab", None, "c"]}), pa.RecordBatch.from_pydict({"text": ["d"]})]
    runs = common.slices(iter(batches), "text", 2)
    assert next(runs)[1] == [b"ab", b""] and not released
    assert [texts for _, texts in runs] == [[b"c"], [b"d"]] and released == [True]
