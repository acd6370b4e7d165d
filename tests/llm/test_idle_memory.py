"""What a Python worker keeps when its tasks are over."""

import ctypes
import os
import subprocess
import sys
from pathlib import Path

import pytest

#: Runs the steps of several stages in one process, as a worker does, and prints the MB it holds before and after all that is free is given back.
WORKER = """
import ctypes, random
import numpy as np
import pyarrow as pa
import public_tokenizers
from tidelog.llm import bpe, jaccard, ordinal, suffixes

def held():
    with open("/proc/self/statm") as file:
        size, resident, shared, *_ = map(int, file.read().split())
    return (resident - shared) * 4096 / 2**20

r = random.Random(1)
some = ["".join(r.choices("abcdefghij", k=r.randrange(2, 9))) for _ in range(50_000)]
texts = pa.array([" ".join(r.choices(some, k=500)) for _ in range(3000)])
ids = pa.array(range(3000))
batch = pa.RecordBatch.from_arrays([ids, ids, ids, texts], ["k1", "k2", "doc_id", "text"])
path = public_tokenizers.path("byte_bpe_50k.json")
model = ordinal.Model(np.zeros(ordinal.WIDTH, np.float32), np.array([-1.0, 1.0]))
for step in (ordinal._scores(model, 2, 0.8, "text"), jaccard._sets, suffixes._anchor_counts, suffixes._anchor_rows, bpe._split(path, 8), bpe._pack(path, 8, ["doc_id"])):
    for _ in step(iter([batch])):
        del _
kept = held()
pa.default_memory_pool().release_unused()
ctypes.CDLL(None).malloc_trim(0)
print(kept, held())
"""


@pytest.mark.skipif(not hasattr(ctypes.CDLL(None), "malloc_trim") or not os.path.exists("/proc/self/statm"), reason="measured with the GNU library on Linux")
def test_an_idle_worker_keeps_no_free_memory():
    root = Path(__file__).parents[2]
    done = subprocess.run([sys.executable, "-c", WORKER], cwd=root, env=os.environ | {"PYTHONPATH": f"{root}:{os.environ.get('PYTHONPATH', '')}"}, capture_output=True, text=True, timeout=300, check=True)
    kept, used = map(float, done.stdout.split())
    assert kept < used + 16, (kept, used)
