"""What Python workers hold while they work and keep between tasks."""

import ctypes
import os

import numpy as np
import pyarrow as pa
import pytest

from tabprep.llm import toxicity
from tabprep.llm.common import lean


def resident() -> int:
    with open("/proc/self/statm") as at:
        return int(at.read().split()[1]) * os.sysconf("SC_PAGE_SIZE")


@pytest.mark.skipif(not hasattr(ctypes.CDLL(None), "malloc_trim"), reason="needs glibc")
def test_a_task_that_ended_holds_no_memory():
    def run(batches):
        held = []
        for batch in batches:
            held += [np.zeros(1000) for _ in range(20_000)]  # 160 MB in blocks that stay with the process
            kept.append(np.zeros(1000))  # above them, so the heap cannot just shrink
            yield batch

    kept = []
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2])], names=["x"])
    before = resident()
    assert [b.num_rows for b in lean(run)(iter([batch]))] == [2]
    assert resident() - before < 40 << 20


def test_steps_of_a_fit_are_compact():
    rng = np.random.default_rng(1)
    words = ["".join(chr(97 + c) for c in rng.integers(0, 26, 8)) for _ in range(3000)]
    texts = [" ".join(words[k] for k in rng.integers(0, 3000, 300)) for _ in range(200)]
    steps = list(toxicity.batches(texts, np.arange(200) % 2))
    held = sum(a.nbytes for s in steps for a in vars(s).values())
    assert held < 15 * sum(len(s.bucket) for s in steps)  # bytes an n-gram of a step; 19.8 with 64-bit indexes


def test_types_of_indexes_hold_every_index():
    for size in (0, 1, 255, 256, 65_535, 65_536, 1 << 31, 1 << 32):
        assert np.iinfo(toxicity.index_type(size)).max >= size - 1
