import random
import re
from collections import Counter
from math import log10

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lorebank.llm import language_model as m
from tests.llm.helpers import LOW, SCHEMA, clashing, frame, rows


def tokens(text):
    return re.findall("[^\x20\x09-\x0d]+", (text or "").translate(LOW)) + ["\0end"]


@pytest.fixture(scope="module")
def docs():
    return rows(n=120)


def test_base_scores_and_counts(spark, docs):
    train = [r for r in docs if r[0] % 4]
    out = m.scored(clashing(frame(spark, docs)), frame(spark, train)).collect()
    c = Counter(t for _, text, *_ in train for t in tokens(text))
    n, v = sum(c.values()), len(c)
    text = {d: t for d, t, *_ in docs}
    assert len(out) == len(docs)
    for r in out:
        own = tokens(text[r.doc_id])
        want = sum(log10((c[t] + 0.1) / (n + 0.1 * (v + 1))) for t in own)
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(own), sum(c[t] > 0 for t in own), n)
        assert r.base_score == pytest.approx(want, rel=1e-9)


def test_model_is_better_on_held_out_text_and_the_same_again(spark, docs):
    train = frame(spark, [r for r in docs if r[0] % 4])
    runs = [{r.doc_id: (r.score, r.base_score) for r in m.scored(frame(spark, docs, parts=p), train).collect()} for p in (2, 6)]
    assert all(a[0] == pytest.approx(runs[1][d][0], rel=1e-6) for d, a in runs[0].items())
    held = [v for d, v in runs[0].items() if d % 4 == 0]
    assert sum(s for s, _ in held) > sum(b for _, b in held)


def test_probabilities_of_a_context_add_up_to_one(spark, docs):
    model, heads, _, draws = m.fit(frame(spark, docs).select("text"), 8)
    rows_ = [(bytes(r.keys), bytes(r.p), bytes(r.tokens), bytes(r.p_parent), bytes(r.counts)) for r in model.filter("bucket >= 0").collect()]
    back = np.mean([t.back for t, _ in draws], axis=0)
    unknown = float(np.mean([t.p_unknown for t, _ in draws]))
    top = m._lookup([tuple(map(bytes, r)) for r in model.filter("bucket = -1").drop("bucket").collect()], back, unknown)
    look = m._lookup([*rows_, top.of(heads)], back, unknown)
    for context in (0, 1, 5, len(heads)):
        p, c = look(look.tokens | np.uint64(context))
        assert p.sum() + back[context] * unknown == pytest.approx(1, abs=0.02)


def plain_gibbs(pairs, heads, sweeps=400, burn=100):
    """Chinese-restaurant seating of one customer after the other, with the fixed discounts of the model."""
    rng = random.Random(3)
    c = Counter((u if u in heads else None, w) for u, w in pairs)
    types = sorted({w for _, w in c})
    counts, of = list(c.values()), Counter(w for _, w in c)
    n1, n2, p1, p2 = counts.count(1), counts.count(2), list(of.values()).count(1), list(of.values()).count(2)
    clip = lambda x: min(0.95, max(0.05, x))
    d, e = (clip(x / (x + 2 * y)) if x else 0.5 for x, y in ((n1, n2), (p1, p2)))
    customers = Counter()
    for (u, _), n in c.items():
        customers[u] += n
    tables = {k: [n] for k, n in c.items()}  # sizes of the tables
    above = {w: [of[w]] for w in types}
    sums = Counter()
    for sweep in range(sweeps):
        low = Counter()
        for (u, _), t in tables.items():
            low[u] += len(t)
        high, sent = sum(map(len, above.values())), sum(low.values())
        parent = lambda w: (sum(above[w]) - e * len(above[w])) / (1 + sent) + (1 + e * high) / (1 + sent) / len(types)
        if sweep >= burn:
            for u, w in c:
                sums[u, w] += (c[u, w] - d * len(tables[u, w])) / (1 + customers[u]) + (1 + d * low[u]) / (1 + customers[u]) * parent(w)
        for u, w in c:
            own = tables[u, w]
            for _ in range(c[u, w]):
                i = rng.choices(range(len(own)), own)[0]  # one customer leaves and is seated again
                own[i] -= 1
                if not own[i]:
                    own.pop(i)
                    low[u] -= 1
                    sent -= 1
                    i = rng.choices(range(len(above[w])), above[w])[0]
                    above[w][i] -= 1
                    if not above[w][i]:
                        above[w].pop(i)
                        high -= 1
                i = rng.choices(range(len(own) + 1), [x - d for x in own] + [(1 + d * low[u]) * parent(w)])[0]
                if i < len(own):
                    own[i] += 1
                    continue
                own.append(1)
                low[u] += 1
                sent += 1
                j = rng.choices(range(len(above[w]) + 1), [x - e for x in above[w]] + [(1 + e * high) / len(types)])[0]
                if j < len(above[w]):
                    above[w][j] += 1
                else:
                    above[w].append(1)
                    high += 1
    return {k: v / (sweeps - burn) for k, v in sums.items()}


def test_predictions_agree_with_a_plain_sampler(spark, monkeypatch):
    rng = random.Random(8)
    vocabulary = [f"w{i}" for i in range(40)]
    texts = [" ".join(rng.choices(vocabulary, [1 / (i + 1) for i in range(40)], k=rng.randint(5, 30))) for _ in range(60)]
    monkeypatch.setattr(m, "SAMPLES", 40)
    model, heads, _, draws = m.fit(frame(spark, [(i, t, "en", "s", 0) for i, t in enumerate(texts)]).select("text"), 4)
    back = np.mean([t.back for t, _ in draws], axis=0)
    unknown = float(np.mean([t.p_unknown for t, _ in draws]))
    top = m._lookup([tuple(map(bytes, r)) for r in model.filter("bucket = -1").drop("bucket").collect()], back, unknown)
    pairs, keys = [], {}
    for t in texts:
        own = tokens(t)
        k = m.token_keys(*m.buffers(pa.array([t])), heads)[0]
        for u, w, key in zip(["\0end", *own], own, k):
            pairs.append((u, w))
            keys[u, w] = key
    want = plain_gibbs(pairs, {u for u, _ in pairs})
    got, counts = top(np.array([keys[k] for k in want]))
    assert (counts > 0).all()
    share = np.log10(got) - np.log10(list(want.values()))
    assert abs(share.mean()) < 0.02 and np.abs(share).max() < 0.25


def test_tables_follow_their_exact_distribution():
    d, n, rate = 0.6, 7, 0.8
    keys = np.arange(200_000, dtype=np.uint64)
    drawn = m.seated(keys, np.full(len(keys), n), np.full(len(keys), rate), d, 3)
    ways = m._stirling(d)[n, 1 : n + 1] + np.arange(1, n + 1) * np.log(rate)
    want = np.exp(ways - ways.max())
    assert np.abs(np.bincount(drawn, minlength=n + 1)[1:] / len(keys) - want / want.sum()).max() < 0.005
    assert (m.seated(keys[:50], np.full(50, 100_000), np.full(50, 2.0), d, 3) <= 100_000).all()


@pytest.mark.parametrize("d,rel", [(0.1, 0.11), (0.3, 0.05), (0.6, 0.03), (0.8, 0.03), (0.95, 0.05)])
@pytest.mark.parametrize("n", [130, 1000])
def test_tables_beyond_the_exact_numbers(d, rel, n):
    ways = np.full(n + 2, -np.inf)
    ways[1] = 0
    for k in range(1, n):  # generalised Stirling numbers up to n customers
        t = np.arange(1, k + 2)
        stay = ways[t] + np.log(np.maximum(k - d * t, 1e-300))
        ways[t] = np.logaddexp(np.concatenate([[-np.inf], ways[1 : k + 1]]), stay)
    t = np.arange(1, n + 1)
    for rate in (0.01, 1.0, 5.0, 20.0, 100.0, 1000.0):
        w = ways[1 : n + 1] + t * np.log(rate)
        w = np.exp(w - w.max())
        drawn = m.seated(np.arange(20_000, dtype=np.uint64), np.full(20_000, n), np.full(20_000, rate), d, 3)
        assert drawn.mean() == pytest.approx((w * t).sum() / w.sum(), rel=rel)


def test_empty_and_untrained(spark):
    assert m.scored(frame(spark, [], SCHEMA, 1)).count() == 0
    out = m.scored(frame(spark, [(1, "a b", "en", "s", 0)]), frame(spark, [], SCHEMA, 1)).collect()
    assert [(r.n_tokens, r.n_known, r.train_tokens) for r in out] == [(3, 0, 0)]
    assert np.isfinite(out[0].score)


def test_each_context_has_its_own_restaurant(spark, monkeypatch):
    """With one head only: what follows a rare token is known of that token, and no other."""
    plain = m.head_tokens
    monkeypatch.setattr(m, "head_tokens", lambda *args: plain(*args, most=2))
    train = frame(spark, [(i, f"a{i % 30} b{i % 30}", "en", "s", 0) for i in range(90)])
    asked = frame(spark, [(i, f"a{i % 30} b{(i + i // 30) % 30}", "en", "s", 0) for i in range(60)])
    score = {r.doc_id: r.score for r in m.scored(asked, train).collect()}
    assert all(score[i] > score[i + 30] + 1 for i in range(30))
    marked = {r.doc_id: r.score for r in m.scored(train.withColumn("trained", F.lit(True)), train).collect()}
    assert all(marked[i] == pytest.approx(score[i], rel=1e-5) for i in range(30))


def test_rows_between_buckets_grow_less_than_the_square_of_the_buckets(spark, monkeypatch):
    """Pairs of two rare tokens in all of 64 buckets: no step sends a row from every bucket to every other."""
    plain, written = m.head_tokens, m.checkpointed
    sent = []

    def counted(df):
        out = written(df)
        if "kind" in out.columns:
            sent.append(out.filter("kind in (2, 3, 4, 6)").groupBy("kind").count().agg(F.max("count")).head()[0] or 0)
        return out

    monkeypatch.setattr(m, "head_tokens", lambda *args: plain(*args, most=2))
    monkeypatch.setattr(m, "checkpointed", counted)
    text = " ".join(f"a{i % 3000} b{i * 7 % 3001}" for i in range(9000))
    m.fit(frame(spark, [(i, text, "en", "s", 0) for i in range(2)]).select("text"), 64)
    assert 64 < max(sent) <= 64 * 8
