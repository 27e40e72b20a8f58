"""The entry with and without what it may lack."""

from __future__ import annotations

import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
CODE = """
import sys, warnings
sys.path.insert(0, {root!r})
class Absent:
    def find_spec(self, name, path=None, target=None):
        if name in {names!r}:
            raise ModuleNotFoundError(f"No module named {{name!r}}", name=name)
sys.meta_path.insert(0, Absent())
with warnings.catch_warnings(record=True) as said:
    warnings.simplefilter("always")
    import __spark_entry__ as e
names = set(e.queries())
assert set(e.oracle_sql()) <= names and "binned_map" in names
print(sum(n.startswith("op") and n[2].isdigit() for n in names), "pipeline" in names, sum("is left out" in str(w.message) for w in said))
"""


@pytest.mark.parametrize("names, said", [([], "True 0"), (["xxhash"], "0 False 1"), (["gridlark.llm", "gridlark.llm.queries"], "0 False 0"), (["corpus_pipeline"], "False 0")])
def test_what_may_be_absent(names, said):
    if not (ROOT / "gridlark" / "llm").exists() and not said.startswith("0"):
        pytest.skip("the subpackage is absent")
    done = subprocess.run([sys.executable, "-c", CODE.format(root=str(ROOT), names=names)], capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
    assert done.stdout.strip().endswith(said)
