"""The driver's entry loads with and without the optional part."""

import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
BLOCK = """
import sys
class Missing:
    def find_spec(self, name, path=None, target=None):
        if name.split(".")[:{depth}] == {parts}:
            raise ModuleNotFoundError(name)
sys.meta_path.insert(0, Missing())
"""


def names(missing: str | None) -> tuple[list[str], list[str]]:
    parts = missing.split(".") if missing else []
    code = (BLOCK.format(depth=len(parts), parts=parts) if missing else "") + "import __spark_entry__ as e; print(*sorted(e.queries())); print(*sorted(e.oracle_sql()))"
    out = subprocess.run([sys.executable, "-W", "ignore", "-c", code], cwd=ROOT, capture_output=True, text=True, timeout=300, check=True).stdout.splitlines()
    return out[0].split(), out[1].split()


@pytest.mark.parametrize("missing", [None, "xxhash", "agorascope.llm", "corpus_pipeline", "public_tokenizers"])
def test_entry_without_a_library_keeps_the_other_queries(missing):
    from agorascope.plans import catalog

    found, oracles = names(missing)
    assert set(catalog.QUERIES) <= set(found) and set(catalog.ORACLES) <= set(oracles) <= set(found)
    if missing and missing != "corpus_pipeline":
        assert set(found) == set(catalog.QUERIES)
