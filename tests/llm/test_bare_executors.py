"""Functions of the operators run in a process that doesn't have this library."""

import base64
import subprocess
import sys
import zlib

import pyarrow as pa
import pytest
from pyspark import cloudpickle

from plateflow.llm.byte_bpe import ByteBpe
from plateflow.llm.chat_format import flatten, format_turn, read_turn
from plateflow.llm.collocations import CountTransducer
from plateflow.llm.conversation_repair import RepairPlan
from plateflow.llm.license_scan import _scan_batches
from plateflow.llm.simhash_dedup import simhash

cloudpickle.register_pickle_by_value(sys.modules[__name__])

RUN = """
import base64, pickle, sys, zlib
try:
    import plateflow
except ModuleNotFoundError:
    pass
else:
    raise SystemExit("the library is there")
work = pickle.loads(zlib.decompress(base64.b64decode(sys.stdin.read())))
print(repr(work()))
"""


def elsewhere(work, folder):
    sent = base64.b64encode(zlib.compress(cloudpickle.dumps(work))).decode()
    done = subprocess.run([sys.executable, "-c", RUN], input=sent, capture_output=True, text=True, cwd=folder, env={"PATH": ""})
    assert done.returncode == 0, done.stderr
    return done.stdout.strip()


TEXT = "This text is under the MIT license and the GNU General Public License version 3."
DOCS = pa.RecordBatch.from_pydict({"doc_id": [1], "text": [TEXT], "lang": ["en"]})


def lines_of(batches):
    return [tuple(map(str, row.values())) for batch in batches for row in batch.to_pylist()]


def bpe():
    ranks = {bytes([k]): k for k in range(256)} | {b"Th": 256, b"Thi": 257}
    return ByteBpe(ranks, r"[a-z]+|.").encode("This")


def repaired():
    plan = RepairPlan()
    plan.read("a", 0)
    return plan.result()


WORK = {
    "license_scan": lambda: lines_of(_scan_batches(iter([DOCS]))),
    "chat_format": lambda: read_turn(format_turn("user", flatten([{"text": TEXT}]))[0]),
    "byte_bpe": bpe,
    "collocations": lambda: list(CountTransducer.from_sorted([((b"a", b"b"), 3)]).entries()),
    "conversation_repair": repaired,
    "simhash_dedup": lambda: simhash(TEXT),
}


@pytest.mark.parametrize("name", WORK)
@pytest.mark.parametrize("used_before", [False, True])
def test_results_are_the_same(name, used_before, tmp_path):
    here = repr(WORK[name]()) if used_before else None
    there = elsewhere(WORK[name], tmp_path)
    assert there == (here or repr(WORK[name]()))
