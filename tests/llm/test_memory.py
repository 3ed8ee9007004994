"""What a Python worker takes while it runs a task, and what it keeps afterwards."""

import subprocess
import sys

import pytest

SCRIPT = """
import re, threading, time
import pyarrow.parquet as pq
import public_tokenizers
from caselake.llm import minhash_dedup, piece_nbest

operator = {"minhash": minhash_dedup._sign_batches, "pieces": piece_nbest._rows(public_tokenizers.path("piece_bpe_32k.model"), 4, True)}[NAME]
held = lambda: sum(map(int, re.findall(r"\\nPss_(?:Anon|Shmem):\\s+(\\d+)", open("/proc/self/smaps_rollup").read()))) / 1024
batches = lambda: pq.ParquetFile("/root/testdata/sf0.1/documents.parquet").iter_batches(1000, columns=["doc_id", "text"])
before, peak = held(), 0
rows = operator(batch for batch, _ in zip(batches(), range(4)))
for _ in rows:
    peak = max(peak, held())
print(peak - before, held() - before)
"""


@pytest.mark.parametrize("name, most, left", [("minhash", 100, 15), ("pieces", 240, 100)])
def test_workers_stay_small(name, most, left):
    done = subprocess.run([sys.executable, "-c", SCRIPT.replace("NAME", repr(name))], capture_output=True, text=True, check=True)
    peak, after = map(float, done.stdout.split())
    assert peak < most and after < left
