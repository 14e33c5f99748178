import re
from pathlib import Path

import numpy as np
import pyarrow as pa

from valuescope.llm.common import tidied


def _held_mb() -> float:
    return sum(map(int, re.findall(r"\nPss_Anon:\s+(\d+)", Path("/proc/self/smaps_rollup").read_text()))) / 1024


def test_memory_of_a_finished_task_goes_back():
    kept = []

    def run(batches):
        for batch in batches:
            parts = [np.ones(4000) for _ in range(6000)]   # 190 MB in parts of 32 kB
            kept.append(parts[-1])                         # keeps the heap from shrinking by itself
            del parts
            yield batch

    batch = pa.RecordBatch.from_pydict({"a": [1]})
    before = _held_mb()
    out, held = tidied(run)(iter([batch])), []
    held.append(next(out))
    held += list(out)
    assert held == [batch]
    assert _held_mb() < before + 20
