"""The registry without the optional part."""

import os
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.mark.parametrize("missing", ["zstandard", "corpus_pipeline"])
def test_the_rest_loads_when_a_package_is_missing(missing):
    code = f"import sys; sys.modules['{missing}'] = None; import __spark_entry__ as e; print(len(e.queries()), sum(k.startswith('op') for k in e.queries()), len(e.oracle_sql()))"
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, cwd=ROOT, check=True).stdout.split()
    assert int(out[0]) >= 109 and out[1] == "0" and int(out[2]) >= 109
