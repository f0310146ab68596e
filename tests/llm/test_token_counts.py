import json
import random

import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from lorebank.llm import token_counts as token_counts_module
from lorebank.llm.common import buffers
from lorebank.llm.token_counts import Counter, piece_starts, token_counts
from tests.llm.helpers import SCHEMA, clashing, frame, rows

PATH = public_tokenizers.path("byte_bpe_50k.json")
BITS = ["a", "b", " ", "  ", "\n", "'s", "'", "é", "1", "23", "!", "the", "ing", "x'll", "漢", "\t", " " * 20, "z" * 15, "<|endoftext|>", "don't", "'re", "'v", " ", "½"]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def test_counts_are_the_librarys(tokenizer):
    rng = random.Random(3)
    texts = ["".join(rng.choice(BITS) for _ in range(rng.randrange(60))) for _ in range(1500)]
    want = [len(x.ids) for x in tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert Counter(PATH).count_texts(*buffers(pa.array(texts))).tolist() == want


@pytest.mark.parametrize("span, warm", [(1, 0), (2, 1), (3, 2), (7, 3), (256, 64)])
def test_spans_of_long_pieces(tokenizer, monkeypatch, span, warm):
    monkeypatch.setattr(token_counts_module, "SPAN", span)
    monkeypatch.setattr(token_counts_module, "WARM", warm)
    monkeypatch.setattr(token_counts_module, "MAX_PAIRS", 50)  # starts anew between texts
    rng = random.Random(5)
    texts = ["", "z" * 1000, "é" * 700, " " * 1001, "!?" * 400, "abcab" * 300, "漢字" * 200]
    texts += ["".join(rng.choice("abcdeinorst") for _ in range(rng.randrange(900))) for _ in range(30)]
    want = [len(x.ids) for x in tokenizer.encode_batch(texts, add_special_tokens=False)]
    own = Counter(PATH)
    assert own.count_texts(*buffers(pa.array(texts))).tolist() == want
    assert [own.count_texts(*buffers(pa.array([x])))[0] for x in texts[::-1]] == want[::-1]


def test_added_tokens_that_take_blanks_are_refused(tmp_path):
    spec = json.load(open(PATH, encoding="utf-8"))
    spec["added_tokens"][0]["lstrip"] = True
    (tmp_path / "t.json").write_text(json.dumps(spec))
    with pytest.raises(ValueError, match="added tokens"):
        Counter(str(tmp_path / "t.json"))


def test_starts_do_not_depend_on_chunks():
    import numpy as np
    import regex

    pattern = regex.compile(public_tokenizers.PATTERN)
    rng = random.Random(4)
    for _ in range(50):
        text = "".join(rng.choice(BITS) for _ in range(80))
        chars = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        want = [m.start() for m in pattern.finditer(text)]
        for chunk in (1, 3, 64):
            assert np.flatnonzero(piece_starts(chars, np.array([0]), chunk)).tolist() == want


def test_documents(spark, tokenizer):
    docs = rows()
    out = token_counts(clashing(frame(spark, docs))).collect()
    text = {d: t or "" for d, t, *_ in docs}
    assert len(out) == len(docs)
    for r in out:
        n = len(tokenizer.encode(text[r.doc_id], add_special_tokens=False).ids)
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(text[r.doc_id].encode()), n, n > 512)
    assert token_counts(frame(spark, [], SCHEMA, 1)).count() == 0


def test_null_ids_and_repeated_rows(spark):
    got = token_counts(frame(spark, [(None, "one two", "en", "s", 0), (None, "one two", "en", "s", 0), (None, None, None, None, None)])).collect()
    assert len(got) == 3 and sorted(r.n_tokens for r in got)[0] == 0 and all(r.doc_id is None for r in got)
