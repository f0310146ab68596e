"""Documents with a null doc_id, some of them equal rows, through the queries of operators that number or fit by doc_id."""

import pytest

from lorebank.llm import language_model, secrets, sharding, toxicity
from tests.llm.helpers import frame, rows


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("null-ids"))
    docs = [(r[0], *r[1:]) for r in rows(n=30) if r[1] is None or len(r[1]) < 10_000]
    docs += [(None, "password = abcdefgh12345", "en", "s", 0)] * 3 + [(None, None, None, None, None), (None, "some words", "en", "s", 0)]
    frame(spark, docs).write.parquet(f"{path}/documents.parquet")
    frame(spark, [(i, i % 2, int(i % 3 == 0)) for i in range(20)] + [(None, 1, 1)], "doc_id bigint, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path, len(docs)


@pytest.mark.parametrize("query", [sharding.op3_sharding, secrets.op6_secrets, toxicity.op7_toxicity, language_model.op9_language_model])
def test_each_row_of_a_null_id_has_its_own_result(spark, folder, query):
    path, n = folder
    out = query(spark, path).collect()
    assert len(out) == n and sum(r.doc_id is None for r in out) == 5
    if query is secrets.op6_secrets:
        assert sorted(r.n_assign for r in out if r.doc_id is None) == [0, 0, 1, 1, 1]
    if query is sharding.op3_sharding:
        for shard in {r.shard for r in out}:
            assert sorted(r.slot for r in out if r.shard == shard) == list(range(sum(r.shard == shard for r in out)))
    if "held_out" in out[0]:
        assert not any(r.held_out for r in out if r.doc_id is None)
