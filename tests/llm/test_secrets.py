import hashlib
import math
import random
import re
from collections import Counter

import pytest

from lorebank.llm import secrets as s
from tests.llm.helpers import SCHEMA, clashing, frame, prose, rows


def plain_base(text):
    """The three kinds as they are defined, in the plainest way."""
    out = []
    for m in re.finditer(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text, re.I | re.A):
        if len(m[2]) >= 8:
            out.append((m.start(), 0, m.end()))
    for kind, pattern, least in ((1, "AKIA[A-Z0-9]+", 16), (2, "[0-9a-f]+", 32)):
        out += [(m.start(), kind, m.end()) for m in re.finditer(pattern, text) if len(m[0]) >= least]
    return sorted(out)


@pytest.fixture(scope="module")
def docs():
    rng = random.Random(4)
    out, hexes = rows(n=40), "0123456789abcdef"
    for i in range(60):
        key = "".join(rng.choice(hexes) for _ in range(40))
        lead = rng.choice(['Token = "', "é PASSWORD: ", "api_key=", "apikey '= ", "", "x", "AKIA"])
        out.append((3000 + i, f"é {prose(rng, 5)} {lead}{key} {prose(rng, 5)}", "en", "s", 0))
    for i in range(80):  # ordinary runs with digits
        numbers = ["4" + "".join(rng.choice("0123456789") for _ in range(15)), f"2024-{rng.randint(10, 12)}-{rng.randint(10, 28)}", "".join(rng.choice("0123456789") for _ in range(9)), f"{rng.randint(100, 999)}-555-{rng.randint(1000, 9999)}"]
        out.append((5000 + i, f"{prose(rng, 5)} {rng.choice(numbers)} {prose(rng, 5)}", "en", "s", 0))
    out.append((4000, "secret=abc token: short1 AKIA0123456789AB AKIA0123 passwd=hunter2hunter2 " + "f" * 31, "en", "s", 0))
    out.append((4001, "deadbeef" * 4 + "DEADBEEF" + "a" * 32 + "\n" + "é" * 9 + "SECRET:'A/b+c=d-e.f_9", "en", "s", 0))
    out.append((4002, "key " + "".join(rng.choice(hexes) for _ in range(30)) + " card 4532015112830366", "en", "s", 0))
    return out


def test_base_matches_are_all_found(spark, docs):
    out = s.secrets(clashing(frame(spark, docs))).collect()
    text = {d: t or "" for d, t, *_ in docs}
    assert len(out) == len(docs)
    for r in out:
        want = plain_base(text[r.doc_id])
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(k == kind for _, k, _ in want) for kind in range(3)]
        assert r.base_spans == ",".join(f"{s.KINDS[k]}:{a}:{b}" for a, k, b in want)
        assert set(r.base_spans.split(",")) - {""} <= set(r.spans.split(","))


def test_method_adds_formats_like_credentials(spark, docs):
    out = {r.doc_id: r for r in s.secrets(frame(spark, docs)).collect()}
    assert out[4002].n_format == 1 and "format:4:34" in out[4002].spans  # 30 hexadecimal digits; the card number is none
    assert sum(r.n_format for d, r in out.items() if d < 3000 or d >= 5000) == 0


def test_automata_prefer_their_own():
    rng = random.Random(1)
    strings = ["AKIA" + "".join(rng.choice("ABCDEFGH0123456789") for _ in range(16)) for _ in range(300)]
    a = s.Automaton(sorted(map(s.format_of, strings)))
    assert a.score(s.format_of(strings[0])) > a.score(s.format_of("thisisjustaword0nly"))
    counts, whole, _ = a.states[0]
    assert sum((counts[c] + 0.5) / math.exp(whole) for c in [*"0Aaz+/_.=-", None]) == pytest.approx(1)


def plain_score(strings, value):
    """The likelihood under a prefix tree without merges: what an automaton gives where no two states are compatible."""
    total = Counter()
    for s_ in strings:
        total.update([*s_, None])
    rate = lambda counts, c: math.log((counts[c] + 0.5) / (sum(counts.values()) + 0.5 * s._SYMBOLS))
    out, known = 0.0, True
    for i, c in enumerate([*value, None]):
        after = Counter(x[i] if i < len(x) else None for x in strings if x[:i] == value[:i]) if known else Counter()
        known = bool(after)
        out += rate(after if known else total, c)
    return out


def test_scores_match_a_plain_prefix_tree(monkeypatch):
    monkeypatch.setattr(s.Automaton, "_compatible", lambda *_: False)  # the tree itself
    rng = random.Random(2)
    strings = ["".join(rng.choice("0Aaz") for _ in range(rng.randint(1, 6))) for _ in range(200)]
    a = s.Automaton(sorted(strings))
    for v in [*strings[:50], "zz", "000000000", ""]:
        assert a.score(v) == pytest.approx(plain_score(strings, v), abs=1e-9)


def test_equal_states_merge():
    a = s.Automaton(sorted("A" * i + "0" * j for i in range(1, 12) for j in range(1, 12)) * 50)
    assert len(a.states) == 1 + 11 + 11  # by how many letters came, and then by how many digits; the tree has over a hundred
    assert a.score("AAAA0000") > a.score("A0A0A0A0")


def test_sample_is_bounded_and_counted(spark):
    words = sorted({prose(random.Random(i), 1) + "longenough" for i in range(300)})
    words = [w for w in words if w.isascii() and w.isalnum()]
    g = s.infer(frame(spark, [(i, f"{w} {w} token=abcd1234{i:04d}" if i % 2 else w, "en", "s", 0) for i, w in enumerate(words)]), limit=5, ordinary=7)
    n = len(words) // 2
    assert g.least == pytest.approx(math.log((n + len(words) - n) / n) + math.log(99))


def test_no_credentials_and_empty_table(spark):
    assert all(r.spans == "" for r in s.secrets(frame(spark, rows(n=20))).collect())
    assert s.secrets(frame(spark, [], SCHEMA, 1)).count() == 0


def test_query_hash(spark, docs, tmp_path):
    frame(spark, docs).write.parquet(f"{tmp_path}/documents.parquet")
    out = {r.doc_id: r for r in s.op6_secrets(spark, str(tmp_path)).collect()}
    assert out[41].base_sha256 == hashlib.sha256(b"").hexdigest()
