"""Byte-level BPE encoding and decoding with overlapping chunks.

A long text is cut into chunks that overlap. Every chunk is pre-tokenised on its own, which is right from
any true boundary on, as the pattern never looks back. Two chunks are stitched at the first position in
their overlap where both have a boundary; from there on they agree. Matches that come near the right end of
a chunk may be cut short and are not trusted. Where an overlap holds no common boundary (a very long run),
the left chunk is matched on from its last trusted boundary. Then each piece is encoded by merging, lowest
rank first, and pieces' ids are joined. Decoding looks up the bytes of each id and joins them.

Null counts as empty: no ids, and the hash of no bytes. Every row is encoded whole, on its own, whatever its
doc_id (null too) and however often it stands there; there is no shuffle. Special strings inside a text are ordinary text.
"""

from __future__ import annotations

import base64
import hashlib
from bisect import bisect_right
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lorebank.llm.common import table, text_of

#: Characters of a chunk, of the overlap of two chunks, and before a chunk's end that are not trusted.
CHUNK, OVERLAP, MARGIN = 16384, 512, 8
#: Distinct pieces whose ids a worker remembers.
MAX_PIECES = 400_000

CODES = "struct<n_tokens:bigint,ids_sha256:string,decoded_sha256:string>"


@lru_cache(maxsize=4)
def _ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def boundaries(text: str, pattern, chunk: int = CHUNK, overlap: int = OVERLAP) -> list[int]:
    """Where each piece of the text ends, found chunk by chunk and stitched."""
    n = len(text)
    if n <= chunk + overlap:
        return [m.end() for m in pattern.finditer(text)]
    parts = []
    for begin in range(0, n, chunk):
        end = min(n, begin + chunk + overlap)
        ends = [m.end() for m in pattern.finditer(text, begin, end)]
        if end < n:  # what ends near the cut may be longer, or be matched otherwise, in the whole text
            while ends and ends[-1] > end - MARGIN:
                ends.pop()
        parts.append((begin, ends))
    out: list[int] = []
    at, k = 0, 0  # the last true boundary, and the chunk whose boundaries run through it
    while at < n:
        later = {parts[k + 1][0], *parts[k + 1][1]} if k + 1 < len(parts) else ()
        ends = parts[k][1]
        for e in ends[bisect_right(ends, at) :]:
            out.append(e)
            at = e
            if e in later:  # the next chunk has this boundary too
                break
        while at < n and at not in later:  # nothing in common: match on until it has
            if k + 1 < len(parts) and at >= parts[k + 1][0] + chunk:
                break
            at = pattern.match(text, at).end()
            out.append(at)
        k += 1
        if at < n and k < len(parts) and at != parts[k][0] and at not in later:
            parts[k] = (at, [])  # that chunk is passed over
    return out


def merged(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one piece: the adjoining pair whose union has the lowest rank is merged, leftmost first."""
    whole = ranks.get(piece)
    if whole is not None:
        return [whole]
    parts = [piece[i : i + 1] for i in range(len(piece))]
    pairs = [ranks.get(a + b, 1 << 60) for a, b in zip(parts, parts[1:])]
    while pairs and (low := min(pairs)) < 1 << 60:
        i = pairs.index(low)
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
        del pairs[i]
        if i < len(pairs):
            pairs[i] = ranks.get(parts[i] + parts[i + 1], 1 << 60)
        if i:
            pairs[i - 1] = ranks.get(parts[i - 1] + parts[i], 1 << 60)
    return [ranks[p] for p in parts]


def long_merged(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same for a piece of many bytes, with a heap over a linked list."""
    import heapq

    n = len(piece)
    end, nxt, prev = list(range(1, n + 1)), list(range(1, n + 1)), list(range(-1, n - 1))
    alive = [True] * n
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(piece[i : i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, e = heapq.heappop(heap)
        j = nxt[i] if alive[i] else n
        if j >= n or end[j] != e or not alive[j]:
            continue
        alive[j], end[i], nxt[i] = False, e, nxt[j]
        if nxt[i] < n:
            prev[nxt[i]] = i
            if (r := ranks.get(piece[i : end[nxt[i]]])) is not None:
                heapq.heappush(heap, (r, i, end[nxt[i]]))
        if prev[i] >= 0 and (r := ranks.get(piece[prev[i] : e])) is not None:
            heapq.heappush(heap, (r, prev[i], e))
    return [ranks[piece[i : end[i]]] for i in range(n) if alive[i]]


class Codec:
    def __init__(self, path: str, pattern: str):
        import regex

        self.ranks, self.pattern = _ranks(path), regex.compile(pattern)
        self.bytes = {i: b for b, i in self.ranks.items()}
        self.known: dict[str, bytes] = {}

    def __missing(self, piece: str) -> bytes:
        raw = piece.encode()
        if len(self.known) >= MAX_PIECES:
            self.known.clear()
        out = np.array((merged if len(raw) < 64 else long_merged)(raw, self.ranks), "<u4").tobytes()
        if len(raw) < 64:
            self.known[piece] = out
        return out

    def encode(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit integers."""
        if len(text) <= CHUNK + OVERLAP:
            pieces = self.pattern.findall(text)
        else:
            ends = boundaries(text, self.pattern)
            pieces = [text[a:b] for a, b in zip([0, *ends], ends)]
        get = self.known.get
        return b"".join([get(p) or self.__missing(p) for p in pieces])

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.bytes.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@lru_cache(maxsize=2)
def codec(path: str, pattern: str) -> Codec:
    """One a Python worker: it loads the ranks once."""
    return Codec(path, pattern)


def encode_udf(path: str, pattern: str):
    """Text to its ids, little-endian."""

    @F.arrow_udf("binary")
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = codec(path, pattern)
        for texts in batches:
            yield pa.array([own.encode(t.as_py() or "") for t in texts], pa.binary())

    return encode


def decode_udf(path: str, pattern: str):
    """Ids, little-endian, to the bytes of the text."""

    @F.arrow_udf("binary")
    def decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = codec(path, pattern)
        for ids in batches:
            yield pa.array([own.decode(t.as_py() or b"") for t in ids], pa.binary())

    return decode


def digest_udf(path: str, pattern: str):
    """Encode and decode one text after the other; only the digests leave the worker."""

    @F.arrow_udf(CODES)
    def digest(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = codec(path, pattern)
        for texts in batches:
            n, a, b = [], [], []
            for text in texts:
                ids = own.encode(text.as_py() or "")
                n.append(len(ids) // 4)
                a.append(hashlib.sha256(ids).hexdigest())
                b.append(hashlib.sha256(own.decode(ids)).hexdigest())
            yield pa.StructArray.from_arrays([pa.array(n, pa.int64()), pa.array(a, pa.string()), pa.array(b, pa.string())], ["n_tokens", "ids_sha256", "decoded_sha256"])

    return digest


def coded(docs: DataFrame, path: str | None = None, pattern: str | None = None) -> DataFrame:
    """One row per document: doc_id, n_tokens, ids_sha256, decoded_sha256."""
    import public_tokenizers

    digest = digest_udf(path or public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), pattern or public_tokenizers.PATTERN)
    return docs.select("doc_id", digest(text_of("text")).alias("c")).select("doc_id", "c.*")


def op10_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coded(table(spark, sf_dir, "documents"))
