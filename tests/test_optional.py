"""The training-data operators are optional: without them or what they need, the rest still works."""

import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]


@pytest.mark.parametrize("missing", ["zstandard", "salesloom.llm", "corpus_pipeline"])
def test_queries_without(missing):
    code = (f"import sys; sys.modules[{missing!r}] = None\n"
            "import __spark_entry__ as e\n"
            "assert set(e.queries()) == set(e.QUERIES) == set(e.oracle_sql()), set(e.queries()) ^ set(e.QUERIES)")
    done = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr[-2000:]
    assert "without the training-data operators" in done.stderr
