"""The entry stands without the corpus part."""

import subprocess
import sys

import pytest
from conftest import ROOT

CODE = """
import sys
sys.path.insert(0, {root!r})

class Blocked:
    def find_spec(self, name, path=None, target=None):
        if name == {blocked!r}:
            raise ModuleNotFoundError(name, name=name)

sys.meta_path.insert(0, Blocked())
import __spark_entry__ as e
names = e.queries()
print(len(names), "pipeline" in names, any(n.startswith("op") for n in names), "a_windows" in names, set(e.oracle_sql()) <= set(names))
"""


@pytest.mark.parametrize("blocked", ["tillsight.llm", "zstandard", "corpus_pipeline"])
def test_entry_without(blocked):
    run = subprocess.run([sys.executable, "-c", CODE.format(root=ROOT, blocked=blocked)], capture_output=True, text=True)
    n, pipeline, corpus, retail, oracles = run.stdout.split()
    assert int(n) > 200 and pipeline == "False" and retail == oracles == "True"
    assert corpus == "False" or blocked == "corpus_pipeline"
