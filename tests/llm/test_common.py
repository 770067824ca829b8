import re
from pathlib import Path

import numpy as np
import pyarrow as pa

from colophon.llm.common import lean


def held():
    """MB of this process without mapped files."""
    return sum(map(int, re.findall(r"\n(?:Pss_Anon):\s+(\d+)", Path("/proc/self/smaps_rollup").read_text()))) / 1024


def test_a_worker_gives_back_what_it_has_freed():
    kept, took = [], []

    def run(batches):
        for b in batches:
            arrays = [np.ones(60_000, np.uint8) for _ in range(4000)]  # small enough for the heap
            kept.append(arrays[-1])  # the heap can't shrink from its end
            took.append(held())
            del arrays
            yield b

    batch = pa.RecordBatch.from_arrays([pa.array([1])], ["x"])
    before, after = held(), []
    for b in lean(run)(iter([batch, batch])):
        assert b.equals(batch)
        after.append(held())
    assert max(took) > before + 200 and len(after) == 2
    assert held() < before + 60


def test_a_worker_gives_back_when_its_rows_are_not_all_read():
    closed = []

    def run(batches):
        try:
            yield from batches
        finally:
            closed.append(True)

    rows = lean(run)(iter([pa.RecordBatch.from_arrays([pa.array([i])], ["x"]) for i in range(3)]))
    assert next(rows).column(0)[0].as_py() == 0
    rows.close()
    assert closed == [True]
