"""The entry works without the training-data operators, or without a package they need."""

import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
SCRIPT = """
import sys
for name in sys.argv[1:]:
    sys.modules[name] = None
import __spark_entry__ as e
names = set(e.queries())
print(len(names), len(set(e.oracle_sql()) - names), sum(n.startswith("op") or n == "pipeline" for n in names))
"""


def entry_without(*modules):
    out = subprocess.run([sys.executable, "-c", SCRIPT, *modules], cwd=ROOT, capture_output=True, text=True, check=True)
    return [int(x) for x in out.stdout.split()]


@pytest.mark.parametrize("missing", ["cascadia.llm", "public_tokenizers", "tokenizers.missing"])
def test_entry_without(missing):
    whole, extra, numbered = entry_without(missing)
    assert extra == 0 and whole - numbered >= 74
    if missing != "tokenizers.missing":
        assert numbered == 0
