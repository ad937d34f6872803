"""The entry without the subpackage for training data, and without the pipeline."""

import os
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
_HIDDEN = """
import importlib.util, sys
find = importlib.util.find_spec
importlib.util.find_spec = lambda name, *a: None if name in {hidden!r} else find(name, *a)
class Gone:
    def find_spec(self, name, *a):
        if any(name == x or name.startswith(x + ".") for x in {hidden!r}):
            raise ModuleNotFoundError(name)
sys.meta_path.insert(0, Gone())
import __spark_entry__ as entry
from strandframe.plans import fields, queries, repeats  # noqa: F401
assert entry.queries() == queries.QUERIES and entry.oracle_sql() == queries.SQL and len(queries.QUERIES) >= 77
assert not any(x.startswith("strandframe.llm") for x in sys.modules)
"""


@pytest.mark.parametrize("hidden", [["strandframe.llm"], ["strandframe.llm", "corpus_pipeline"]])
def test_entry_without_the_subpackage(hidden):
    subprocess.run([sys.executable, "-c", _HIDDEN.format(hidden=hidden)], cwd=ROOT, check=True, timeout=120)
