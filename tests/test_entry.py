import importlib
import importlib.util
import sys

import pytest

import __spark_entry__ as e


def test_every_oracle_has_a_query():
    assert set(e.oracle_sql()) <= set(e.queries()) and len(e.queries()) >= 40


def test_without_the_llm_subpackage(monkeypatch):
    for name in [m for m in sys.modules if m.startswith("lorebank.llm") or m == "corpus_pipeline"]:
        monkeypatch.delitem(sys.modules, name)

    class Gone:
        def find_spec(self, name, path=None, target=None):
            if name == "lorebank.llm" or name == "corpus_pipeline":
                raise ModuleNotFoundError(f"No module named {name!r}", name=name)

    monkeypatch.setattr(sys, "meta_path", [Gone(), *sys.meta_path])
    own = importlib.reload(e)
    assert not [n for n in own.queries() if n.startswith("op") or n == "pipeline"] and "hybrid_rrf" in own.queries()
    monkeypatch.undo()
    importlib.reload(e)


@pytest.mark.skipif(importlib.util.find_spec("duckdb") is None, reason="no duckdb")
@pytest.mark.parametrize("name", ["kb_shape", "hybrid_rrf", "chunk_sections", "audit", "eval_by_type", "sessions"])
def test_queries_against_sql(spark, name):
    import os

    import duckdb

    folder = "/root/testdata/sf0.001"
    if not os.path.isdir(folder):
        pytest.skip("no tables here")
    con = duckdb.connect()
    for t in os.listdir(folder):
        con.execute(f"create view {t.removesuffix('.parquet')} as from read_parquet('{folder}/{t}')")
    want = con.execute(e.oracle_sql()[name])
    cols = sorted(d[0] for d in want.description)
    at = [[d[0] for d in want.description].index(c) for c in cols]
    plain = lambda r: tuple(round(v, 5) if isinstance(v, float) else v for v in r)
    got = e.queries()[name](spark, folder)
    assert sorted(got.columns) == cols
    assert sorted((plain(r) for r in got.select(*cols).collect()), key=str) == sorted((plain([r[i] for i in at]) for r in want.fetchall()), key=str)
