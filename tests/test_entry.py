"""The entry module imports in a process without a session, with and without the corpus part."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
COUNT = "import __spark_entry__ as e; q, o = e.queries(), e.oracle_sql(); assert set(o) <= set(q); print(len(q), len(o))"


def run(code: str) -> list[int]:
    done = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
    return [int(x) for x in done.stdout.split()]


def test_import_without_session():
    queries, oracles = run(COUNT)
    assert queries >= 109 and oracles >= 98


def test_import_without_corpus_part():
    queries, _ = run("import importlib.abc, sys\nclass Hide(importlib.abc.MetaPathFinder):\n    def find_spec(self, name, path=None, target=None):\n        if name == 'stridelake.llm':\n            raise ModuleNotFoundError(name, name=name)\nsys.meta_path.insert(0, Hide())\n" + COUNT)
    assert queries >= 109
