from __future__ import annotations

import os
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
SMALL = "/root/testdata/sf0.001"


def test_names_agree():
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert len(entry.queries()) > 100


@pytest.mark.skipif(not os.path.isdir(SMALL), reason="no test data")
def test_flagship(spark):
    import __spark_entry__ as entry

    out = entry.entry(spark)
    assert out.columns == ["source", "n_docs", "n_tokens", "docs_pct", "tokens_pct"] and out.count() > 0


def test_core_stands_alone(tmp_path):
    """Without the subpackage of training-data operators everything else imports."""
    code = f"""
import sys; sys.path.insert(0, {str(ROOT)!r})
class Block:
    def find_spec(self, name, path=None, target=None):
        if name.startswith("acequia.llm"): raise ImportError(name)
sys.meta_path.insert(0, Block())
import __spark_entry__ as e
assert not [q for q in e.queries() if q.startswith("p1_")]
print(len(e.queries()))
"""
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
    assert not [p for p in (ROOT / "acequia").rglob("*.py") if "llm" not in p.parts and "acequia.llm" in p.read_text()]


def test_every_query_has_its_columns(spark):
    """A sample of every part runs on the smallest tables and agrees with its SQL in names."""
    duckdb = pytest.importorskip("duckdb")
    if not os.path.isdir(SMALL):
        pytest.skip("no test data")
    import __spark_entry__ as entry

    con = duckdb.connect()
    for f in Path(SMALL).glob("*.parquet"):
        con.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    for name in ("clean_text_chain", "quality_web", "sample_tokens_stratified", "topic_quota_sample", "exact_dedup_keep_first", "stats_grouping_sets", "preference_dedup", "majority_vote", "ir_metrics", "elected_text"):
        sql = entry.oracle_sql()[name]
        got = entry.queries()[name](spark, SMALL)
        columns = sorted(got.columns)
        want = sorted(map(str, con.execute(f"SELECT {', '.join(columns)} FROM ({sql})").fetchall()))
        assert sorted(str(tuple(r)) for r in got.select(*columns).collect()) == want, name
