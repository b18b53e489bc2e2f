"""The driver contract works with and without the optional subpackage."""

import os
import subprocess
import sys

import pytest

from tests.conftest import ROOT

WITHOUT = """
import sys
for name in ("corpus_pipeline", "strata.llm"):
    sys.modules[name] = None
import __spark_entry__ as e
assert set(e.queries()) == set(e.catalog.REGISTRY), set(e.queries()) ^ set(e.catalog.REGISTRY)
assert set(e.oracle_sql()) == set(e.catalog.REGISTRY)
"""


BROKEN = """
import warnings
with warnings.catch_warnings(record=True) as said:
    warnings.simplefilter("always")
    import __spark_entry__ as e
assert any("left out" in str(w.message) and "xxhash" in str(w.message) for w in said)
"""


def test_entry_without_the_optional_part():
    subprocess.run([sys.executable, "-c", WITHOUT], cwd=ROOT, check=True, timeout=120)


def test_a_missing_package_of_the_optional_part_leaves_the_rest():
    """The warehouse's queries stay, and a warning tells why the others are gone."""
    if not os.path.isdir(os.path.join(ROOT, "strata", "llm")):
        pytest.skip("the optional part is not there")
    broken = WITHOUT.replace('("corpus_pipeline", "strata.llm")', '("xxhash",)').replace("import __spark_entry__ as e", BROKEN)
    subprocess.run([sys.executable, "-c", broken], cwd=ROOT, check=True, timeout=120)
