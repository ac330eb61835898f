"""The driver contract holds with and without the training-data package."""

import subprocess
import sys

from .conftest import ROOT

SCRIPT = f"""
import sys
sys.path.insert(0, {ROOT!r})
if {{absent}}:
    sys.modules["codetrail.llm"] = sys.modules["corpus_pipeline"] = None  # as if deleted
import __spark_entry__ as E
q, o = E.queries(), E.oracle_sql()
extra = sorted(n for n in q if n == "pipeline" or n[:2] == "op" and n[2].isdigit())
assert set(o) <= set(q), set(o) - set(q)
assert set(q) - set(o) <= set(extra), set(q) - set(o)
print("EXTRA", len(extra), "daily_metrics" in q, len(q) - len(extra))
"""


def _run(absent: bool) -> list[str]:
    out = subprocess.run([sys.executable, "-c", SCRIPT.replace("{absent}", str(absent))], capture_output=True, text=True, timeout=120)
    assert out.returncode == 0, out.stderr[-2000:]
    return out.stdout.split()


def test_queries_without_the_package():
    assert _run(True)[1:3] == ["0", "True"]


def test_reference_queries_do_not_depend_on_it():
    assert _run(True)[3] == _run(False)[3]
