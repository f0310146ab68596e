import hashlib
import random
import zlib

import numpy as np
import pytest

from lorebank.llm.periodic_runs import best_run, digests, find_runs, kept_words, periodic_runs, planted_words
from tests.llm.helpers import SCHEMA, clashing, frame, rows

SPACE = "\x20\x09\x0a\x0b\x0c\x0d"


def split(text):
    for c in SPACE:
        text = text.replace(c, " ")
    return [w for w in text.split(" ") if w]


def plain_runs(w):
    """All runs by trying each period and each start."""
    found = {}
    for q in range(1, len(w) // 2 + 1):
        i = 0
        while i + q < len(w):
            if w[i] != w[i + q]:
                i += 1
                continue
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j + q - i >= max(6, 4 * q) and (i, j + q) not in found:
                found[i, j + q] = q
            i = j
    return sorted(((s, e - s, q) for (s, e), q in found.items()), key=lambda r: (r[0], r[2]))


def coded(texts):
    ids = {}
    flat = np.array([ids.setdefault(w, len(ids)) for t in texts for w in t], np.int64)
    return flat, np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)


@pytest.mark.parametrize("seed", range(12))
def test_runs_of_random_words(seed):
    rng = random.Random(seed)
    texts = []
    for _ in range(150):
        kind, n = rng.randrange(5), rng.randrange(0, 70)
        letters = "ab" if kind < 2 else "abcd"
        t = [rng.choice(letters) for _ in range(n)]
        if kind == 1 and n:  # powers beside one another
            t = [x for _ in range(4) for x in t[: rng.randint(1, 5)] * rng.randint(1, 7)]
        if kind == 3 and n:  # a long repeat with runs inside
            t = t + t[: n // 2] * 2 + list("zaaaaaaaz") + t
        if kind == 4 and n:
            t = (t[:3] * 5 + ["x"]) * rng.randint(2, 6) + t[:10]
        texts.append(t)
    assert find_runs(*coded(texts)) == [plain_runs(t) for t in texts]


def test_runs_of_words_of_known_structure():
    fib = ["a", "ab"]
    while len(fib[-1]) < 400:
        fib.append(fib[-1] + fib[-2])
    texts = [list(fib[-1]), ["a"] * 500, [], ["a"], list("abc" * 200), list("ab" * 6 + "b" * 9 + "ab" * 6)]
    assert find_runs(*coded(texts)) == [plain_runs(t) for t in texts]
    assert find_runs(np.zeros(0, np.int64), np.zeros(1, np.int64)) == []


def test_ties_of_the_best_run():
    assert best_run([]) is None
    assert best_run([(0, 8, 2), (3, 12, 3), (9, 6, 1), (20, 6, 1)]) == (9, 6, 1)
    assert best_run([(0, 9, 2), (30, 18, 4)]) == (0, 9, 2)


def expected(doc_id, text):
    w = split(text or "")
    h = zlib.crc32(str(doc_id).encode())
    if h % 10 == 0 and w:
        g, n = h // 10, len(w)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(w)
    dropped = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=(None, None, None))
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (doc_id, len(runs), *best, best[0] if best[0] is None else 1000 * best[1] // best[2], sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(" ".join(x for i, x in enumerate(w) if i not in dropped)))


def test_digests_against_a_plain_search(spark):
    docs = [r for r in rows(n=150) if r[1] is None or len(r[1]) < 20_000]
    docs += [(1000 + i, "no no\tno no no  no no no\n" * (i % 7) + "end" + "\x1f x" * i, "en", "s", 0) for i in range(60)]
    docs += [(2000, "spam ham " * 900, "en", "s", 0), (2001, "a b c d e", "en", "s", 0)]
    got = digests(clashing(frame(spark, docs)))
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert sorted(map(tuple, got.collect()), key=str) == sorted((expected(d, t) for d, t, *_ in docs), key=str)


def test_texts_are_collapsed(spark):
    docs = [(1, "so " + "la la " * 5 + "da\n\nda", "en", "s", 0), (None, "x " * 9, None, None, None), (2, None, None, None, None), (3, "", "en", "s", 0)]
    out = {r.doc_id: r for r in periodic_runs(clashing(frame(spark, docs)).selectExpr("*", "'old' as collapsed_text")).collect()}
    assert out[1].collapsed_text == "so la da da" and [tuple(r) for r in out[1].runs] == [(1, 10, 1)] and out[1].n_words == 13
    assert out[None].collapsed_text == "x" and [tuple(r) for r in out[None].runs] == [(0, 9, 1)]
    assert out[2].n_words == out[3].n_words == 0 and out[2].collapsed_text == "" and out[2].runs == []


def test_null_ids_and_empty_tables(spark):
    (r,) = digests(frame(spark, [(None, "x " * 9, None, None, None)])).collect()
    assert r.doc_id is None and (r.n_runs, r.start, r.length, r.period, r.exponent_milli) == (1, 0, 9, 1, 9000)
    assert digests(frame(spark, [], SCHEMA, 1)).count() == 0 and periodic_runs(frame(spark, [], SCHEMA, 1)).count() == 0


def test_kept_and_planted_words():
    assert kept_words(8, [(1, 6, 1)]).tolist() == [True, True, False, False, False, False, False, True]
    assert planted_words(None, 5) is None and planted_words(3, 0) is None


def test_a_long_text():
    rng = np.random.default_rng(5)
    part = rng.integers(0, 5000, 40_000)
    ids = np.concatenate([part, np.tile(part[:300], 6), part, np.zeros(50, np.int64)])
    runs = find_runs(ids, np.array([0, len(ids)]))[0]
    assert any(p == 300 and n >= 1800 for _, n, p in runs) and runs[-1][2] == 1
