import base64
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import regex
import tiktoken

from lorebank.llm import bpe_codec as b
from tests.llm.helpers import SCHEMA, clashing, frame, rows

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
BITS = ["a", "b", " ", "  ", "\n", "'s", "'", "é", "1", "23", "!", "the", "ing", "x'll", "漢", "\t", " " * 40, "z" * 50, "<|endoftext|>"]


@pytest.fixture(scope="module")
def library():
    with open(PATH, "rb") as f:
        ranks = {base64.b64decode(x): int(y) for x, y in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.mark.parametrize("chunk,overlap", [(7, 9), (16, 8), (20, 12), (64, 30)])
def test_stitched_boundaries(chunk, overlap):
    pattern = regex.compile(public_tokenizers.PATTERN)
    rng = random.Random(chunk)
    for _ in range(400):
        text = "".join(rng.choice(BITS) for _ in range(rng.randrange(120)))
        assert b.boundaries(text, pattern, chunk, overlap) == [m.end() for m in pattern.finditer(text)]


def test_long_pieces_merge_alike():
    ranks = b.codec(PATH, public_tokenizers.PATTERN).ranks
    rng = random.Random(9)
    for _ in range(200):
        piece = bytes(rng.choice(b"abethingrz ") for _ in range(rng.randrange(1, 90)))
        if piece not in ranks:
            assert b.long_merged(piece, ranks) == b.merged(piece, ranks)


def test_documents(spark, library):
    docs = [*rows(), (5000, "z" * 40_000, "en", "s", 0), (5001, "a<|endoftext|>b" * 3000, "en", "s", 0)]
    out = b.coded(clashing(frame(spark, docs))).collect()
    text = {d: t or "" for d, t, *_ in docs}
    assert len(out) == len(docs)
    for r in out:
        ids = library.encode_ordinary(text[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(text[r.doc_id].encode()).hexdigest()
    assert b.coded(frame(spark, [], SCHEMA, 1)).count() == 0


def test_round_trip_through_columns(spark):
    args = (PATH, public_tokenizers.PATTERN)
    docs = rows()
    back = frame(spark, docs).select("doc_id", "text", b.decode_udf(*args)(b.encode_udf(*args)("text")).alias("bytes")).collect()
    assert all(bytes(r.bytes).decode() == (r.text or "") for r in back)


def test_null_ids_and_repeated_rows(spark):
    got = b.coded(frame(spark, [(None, "one two", "en", "s", 0), (None, "one two", "en", "s", 0), (None, None, None, None, None)])).collect()
    assert len(got) == 3 and len({(r.n_tokens, r.ids_sha256) for r in got}) == 2 and all(r.doc_id is None for r in got)
