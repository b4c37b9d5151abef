"""Memory of the Python workers beside the executor's."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def test_pieces_memory_follows_the_chunk():
    """A worker's tables and arrays stay small beside the executor's, whatever the batch's size."""
    code = """
import tracemalloc, numpy as np, pyarrow as pa
from clicklens.llm import pieces, textbytes as tb
model = pieces.Pieces.load(pieces.default_model())
column = pa.array([" ".join(map(str, np.random.default_rng(k).integers(0, 500, 2000))) for k in range(512)])
tracemalloc.start()
for _, buf, offsets in tb.text_chunks(column):
    model.encode(buf, offsets)
print(tracemalloc.get_traced_memory()[1])
"""
    run = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True, cwd=ROOT, env={**os.environ, "PYTHONPATH": ROOT})
    assert int(run.stdout) < 64 << 20
