import subprocess
import sys
from pathlib import Path

import pytest

from sluiceway.plans import harness

REPO = Path(__file__).parent.parent


def test_both_consumers_read_all_rows(spark, tmp_path):
    out = harness.compare_with_file_source(spark, str(tmp_path), files=6, rows_per_file=10, files_per_trigger=4)
    assert out["rows"] == 60 and out["intake"]["query_s"] > 0 and out["file_source"]["query_s"] > 0
    with pytest.raises(ValueError):
        harness.validate_count(1, 2)


def test_scale_rows(spark):
    rows = harness.scale_rows(spark, 20, 4).collect()
    assert {r.valPartition for r in rows} == {f"part_{i}" for i in range(4)} and {len(r.valString) for r in rows} == {10}


def test_nothing_else_needs_the_corpus_operators():
    """The registry imports, and has its other queries, where the optional parts are missing."""
    code = """
import sys
class Missing:
    def find_spec(self, name, path=None, target=None):
        if name in ("corpus_pipeline", "sluiceway.llm"):
            raise ModuleNotFoundError(f"No module named {name!r}", name=name)
sys.meta_path.insert(0, Missing())
import __spark_entry__ as e
assert "intake" in e.queries() and not any(n.startswith("op") or n == "pipeline" for n in e.queries() if n not in ("orc_roundtrip", "oldest_first_topk")), list(e.queries())
assert set(e.oracle_sql()) <= set(e.queries())
"""
    subprocess.run([sys.executable, "-c", code], cwd=REPO, check=True, timeout=120)
    used = [p for p in (REPO / "sluiceway").rglob("*.py") if "llm" not in p.parts and "sluiceway.llm" in p.read_text()]
    assert used == []
