"""The driver's functions with and without the corpus subpackage."""

import subprocess
import sys
from pathlib import Path

BLOCKED = """
import sys

class Gone:
    def find_spec(self, name, path=None, target=None):
        if name.split(".")[:2] == ["sentloom", "llm"] or name == "corpus_pipeline":
            raise ModuleNotFoundError(f"No module named {name!r}", name=name)

sys.meta_path.insert(0, Gone())
import __spark_entry__ as entry
from registry import oracles, queries
assert set(entry.queries()) == set(queries.QUERIES) and set(entry.oracle_sql()) == set(oracles.SQL)
"""


def test_the_corpus_subpackage_may_be_missing():
    root = Path(__file__).resolve().parent.parent
    done = subprocess.run([sys.executable, "-c", BLOCKED], cwd=root, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
