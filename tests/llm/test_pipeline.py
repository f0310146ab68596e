import random

import corpus_pipeline
from tests.llm.helpers import clashing, frame, prose, words


def test_stages_end_to_end(spark, tmp_path):
    rng = random.Random(31)
    docs = [(i, prose(rng, rng.randint(40, 120)), "en", "s", 0) for i in range(60)]
    junk = [(100 + i, " ".join(w + "***" for w in prose(rng, 60).split()), "en", "s", 0) for i in range(15)]
    item = prose(rng, 20)
    dirty = [(200, prose(rng, 30) + " " + item + " " + prose(rng, 30), "en", "s", 0)]
    base = prose(rng, 300)
    near = [(300, base, "en", "s", 0), (301, base.replace(words(base)[10], "changed", 1), "en", "s", 0)]
    copies = [(400, docs[0][1].upper(), "en", "s", 0), (401, docs[1][1], "en", "s", 0)]
    every = docs + junk + dirty + near + copies
    df = clashing(frame(spark, every))
    df.write.parquet(f"{tmp_path}/documents.parquet")
    frame(spark, [(d, int(not 100 <= d < 200), 0) for d, *_ in every if d % 2 == 0], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    frame(spark, [(1, item)], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    upper_differs = docs[0][1].upper().lower() != docs[0][1].lower() or any(ord(c) > 127 for c in docs[0][1])
    kept = {d for d, *_ in docs} - {1} | {300, 400, 401}
    kept -= set() if upper_differs else {0}
    assert sorted(r.doc_id for r in out) == sorted(kept)
    stage = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for _, f in corpus_pipeline.STAGES[:-1]:
        assert f(spark, stage, str(tmp_path)).columns == df.columns


def test_stages_on_an_empty_table(spark, tmp_path):
    empty = clashing(frame(spark, [], parts=1))
    frame(spark, [], "doc_id bigint, quality int, toxic int", 1).write.parquet(f"{tmp_path}/labels.parquet")
    frame(spark, [], "item_id bigint, text string", 1).write.parquet(f"{tmp_path}/benchmark.parquet")
    for _, f in corpus_pipeline.STAGES:
        assert f(spark, empty, str(tmp_path)).count() == 0
