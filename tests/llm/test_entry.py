"""The entry without the corpus part, or without a module that only it needs."""

import subprocess
import sys

from flowtables.suite import QUERIES
from tests.conftest import ROOT

CODE = """
import sys
sys.modules[{name!r}] = None
import __spark_entry__ as entry
print(len(entry.queries()), len(entry.oracle_sql()))
"""


def test_missing_modules_leave_the_other_queries():
    for name in ("zstandard", "regex", "flowtables.llm", "corpus_pipeline"):
        done = subprocess.run(
            [sys.executable, "-c", CODE.format(name=name)], cwd=ROOT, capture_output=True, text=True, timeout=120
        )
        assert done.stdout.split() == [str(len(QUERIES))] * 2, done.stderr
        assert "left out" in done.stderr
