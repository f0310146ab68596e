import pytest

from lorebank.llm.licenses import BASE, TEMPLATES, Template, op12_licenses, rare_words, scan_licenses
from tests.llm.helpers import SCHEMA, clashing, frame, rows, words

PHRASES = {"mit": "mit license", "apache": "apache license", "gpl": "general public license"}


def plain(text, templates=BASE + TEMPLATES):
    """All matches by trying each template at each word."""
    w, out = words(text), []
    for t in templates:
        own = t.words
        for s in range(-len(own), len(w)):
            if s < 0:
                continue
            at = lambda j: w[s + j] if s + j < len(w) else None  # noqa: B023, E731
            if all(at(p + i) == k for p, key in t.key_places() for i, k in enumerate(key)):
                out.append((t.label, t.base, s, len(own), sum(at(j) == x for j, x in enumerate(own)) / len(own)))
    return out


LINES = [
    "Released under the MIT License.", "mit-LICENSE mit license", "Licensed under the Apache License, Version 2.0.", "Licensed under CC BY-NC 4.0.",
    "This work is licensed under the GNU General Public License, version 3.", "GNU general\npublic__license", "general public", "MIT license", "mit licenses", "Mit Lıcense",
    TEMPLATES[12].text, TEMPLATES[13].text, TEMPLATES[14].text, TEMPLATES[15].text, "İ MIT\x00License K mit\x7flicense",
]


def corpus():
    docs = rows(n=40)
    docs += [(500 + i, f"{docs[i][1]} {line} {docs[i + 1][1]}", "en", "s", 0) for i, line in enumerate(LINES)]
    docs += [(600 + i, line, "en", "s", 0) for i, line in enumerate(LINES)]
    return docs + [(700, " ".join(LINES) * 40, "en", "s", 0), (None, "MIT License", None, None, None), (701, "mit " * 3000 + "license", "en", "s", 0)]


def test_base_places_and_whole_templates(spark):
    docs = corpus()
    out = scan_licenses(clashing(frame(spark, docs)).selectExpr("*", "'x' as hits", "'y' as words")).collect()
    assert len(out) == len(docs)
    want = sorted(((d, len(words(t)), sorted(plain(t))) for d, t, *_ in docs), key=str)
    assert sorted(((r.doc_id, r.n_words, sorted(tuple(m) for m in r.license_matches)) for r in out), key=str) == want


def test_the_query(spark, tmp_path):
    docs = corpus()
    frame(spark, docs).write.parquet(f"{tmp_path}/documents.parquet")
    out = op12_licenses(spark, str(tmp_path))
    assert dict(out.dtypes) == {
        "doc_id": "bigint", "n_words": "bigint", "n_base": "bigint", "first_word": "bigint", "last_word": "bigint", "base_labels": "string", "labels": "string", "score": "double",
    }
    plan = out._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
    want = []
    for d, t, *_ in docs:
        w = words(t)
        places = [(label, i) for label, p in PHRASES.items() for i in range(len(w)) if w[i : i + len(p.split())] == p.split()]
        at = [i for _, i in places]
        want.append((d, len(w), len(at), min(at, default=None), max(at, default=None), ",".join(sorted({x for x, _ in places}))))
    got = out.collect()
    assert sorted((tuple(r)[:6] for r in got), key=str) == sorted(want, key=str)
    for r in got:
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1 and (r.score > 0) == bool(r.labels)
    labels = {r.doc_id: r.labels for r in got}
    assert labels[603] == "cc-by-nc-4.0" and labels[602] == "apache,apache-2.0" and labels[604] == "gpl,gpl-3.0" and labels[610] == "mit" and labels[612] == "bsd"


def test_other_words_within_a_license(spark):
    text = TEMPLATES[12].text.replace("documentation files", "documentation sheets").replace("associated", "attached")
    missing = TEMPLATES[12].text.replace("free of charge", "free of charges")
    out = {r.doc_id: r.license_matches for r in scan_licenses(frame(spark, [(1, "so: " + text, "en", "s", 0), (2, missing, "en", "s", 0)]), rare=2).collect()}
    assert [m.label for m in out[1]] == ["mit"] and 0.8 < out[1][0].share < 1 and out[1][0].start == 1
    assert out[2] == []


def test_frequencies_choose_the_words_looked_up(spark):
    t = Template("x", "of the rare license")
    assert rare_words(t, {"of": 9, "the": 9, "license": 3, "rare": 0}, 2) == [("rare", 2), ("license", 3)]
    docs = frame(spark, [(i, "the license of " * 3, "en", "s", 0) for i in range(20)] + [(99, "of the rare license", "en", "s", 0)])
    for rare in (1, 2, 4):
        out = [(r.doc_id, len(r.license_matches)) for r in scan_licenses(docs, (t,), rare).collect() if r.license_matches]
        assert out == [(99, 1)]


def test_templates_are_bounded(spark):
    with pytest.raises(ValueError):
        scan_licenses(frame(spark, [], SCHEMA, 1), (Template("x", "a " * 6000),))
    with pytest.raises(ValueError):
        scan_licenses(frame(spark, [], SCHEMA, 1), (Template("x", "..."),))
    assert scan_licenses(frame(spark, [], SCHEMA, 1)).count() == 0
