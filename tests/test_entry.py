"""The driver entry without the training-text operators or with one of their libraries missing."""

import subprocess
import sys

import pytest

from tests.conftest import ROOT


@pytest.mark.parametrize("missing", ["vigil.llm", "corpus_pipeline", "zstandard"])
def test_other_queries_remain(missing):
    code = (f"import sys; sys.modules[{missing!r}] = None; import __spark_entry__ as e; q, o = e.queries(), e.oracle_sql();"
            "assert len(q) >= 80 and not any(n.startswith('op') or n == 'pipeline' for n in [*q, *o]), sorted(q)")
    assert subprocess.run([sys.executable, "-c", code], cwd=ROOT, timeout=120).returncode == 0
