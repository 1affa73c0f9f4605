"""What Python workers hold in memory, and that results do not depend on it."""

import re
import subprocess
import sys
from pathlib import Path

import numpy as np
import pytest

from swathbook.llm import near_documents

TOP = Path(__file__).resolve().parents[2]
#: MB of memory before the tables of variates are made, at most while they are, and after they are dropped.
TABLES = """
import re, resource
from swathbook.llm import near_documents
mb = lambda: int(re.search(r"Pss_Anon:\\s+(\\d+)", open("/proc/self/smaps_rollup").read())[1]) // 1024
peak = lambda: resource.getrusage(resource.RUSAGE_SELF).ru_maxrss // 1024
before, at_most = mb(), peak()
for weight in (1.0, 2.0):
    near_documents._plain_scores(100, weight)
print(before, peak() - at_most, end=" ")
near_documents.drop_variates()
print(mb())
"""


@pytest.mark.skipif(not Path("/proc/self/smaps_rollup").exists(), reason="needs Linux")
def test_tables_of_variates_take_little_more_than_themselves_and_can_be_dropped():
    out = subprocess.run([sys.executable, "-c", TABLES], cwd=TOP, capture_output=True, text=True, check=True).stdout
    before, most, after = map(int, re.findall(r"\d+", out))
    assert most < 5 * near_documents.VARIATES * 100 * 4 / 2**20 + 40
    assert after < before + 30


def test_long_documents_have_the_bands_of_all_their_shingles_at_once(monkeypatch):
    draw = np.random.default_rng(5)
    values, counts = np.unique(draw.integers(0, 1 << 62, 3 * near_documents.SCORED).astype(np.uint64)), draw.integers(1, 4, 3 * near_documents.SCORED)
    model = values[::7], np.linspace(1.0, 2.0, len(values[::7])), 3.0
    parts = near_documents.sample_bands(values, counts[: len(values)], model)
    monkeypatch.setattr(near_documents, "SCORED", 1 << 20)
    assert (near_documents.sample_bands(values, counts[: len(values)], model) == parts).all()
