"""What a Python worker keeps after a task."""

import os
import subprocess
import sys

import pytest

from duolog.session import ROOT

WORKER = r"""
import re
import numpy as np, pyarrow as pa
from duolog.llm import ngram_join
from duolog.llm._arrow import slices

def held():
    return sum(map(int, re.findall(r"\nPss_Anon:\s+(\d+)", open("/proc/self/smaps_rollup").read()))) / 1024

def sent(rows, salt):  # as a worker gets them: read from a stream
    text = [" ".join(f"w{(salt + i * 31 + k * 7919) % 999983}" for k in range(300)) for i in range(rows)]
    out = pa.BufferOutputStream()
    with pa.ipc.new_stream(out, pa.schema([("text", pa.string())])) as w:
        w.write_batch(pa.record_batch([pa.array(text)], ["text"]))
    return out.getvalue().to_pybytes()

def batches(n):
    for k in range(n):
        yield from pa.ipc.open_stream(pa.BufferReader(sent(8000, 100_003 * k)).readall())

def task(n):
    shingles, kept = 0, []
    for part in slices(batches(n)):
        for s in ngram_join._shingle_sets(part.column("text"), 5):
            kept.append(s)
            shingles += len(np.unique(s))
    ngram_join._often(kept)
    return shingles

sum(1 for _ in slices(batches(0)))
ngram_join._shingle_sets(pa.array(["a b c d e f"]), 5).__next__()
before = held()
found = task(3)
sum(1 for _ in slices(iter([pa.record_batch([pa.array(["x"])], ["text"])])))  # the next task
print(found, held() - before)
"""


@pytest.mark.skipif(not os.path.exists("/proc/self/smaps_rollup"), reason="memory is read from /proc")
def test_a_worker_gives_back_what_a_task_took():
    run = subprocess.run([sys.executable, "-c", WORKER], cwd=ROOT, capture_output=True, text=True, timeout=120, env=os.environ | {"PYTHONPATH": ROOT})
    assert run.returncode == 0, run.stderr
    found, kept = run.stdout.split()[-2:]
    assert int(found) == 3 * 8000 * 296
    assert float(kept) < 24, f"{kept} MB"
