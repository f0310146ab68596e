"""Token counts by compiled finite-state transducers.

Two deterministic transducers are compiled from a byte-level BPE tokenizer file:

* The splitter has eight states and cuts text into pieces. Its look-ahead (a contraction after an
  apostrophe, the last blank before a word) is folded into its input symbols. Texts are cut into chunks of
  equal length; of each chunk the map from every entry state to its exit state is built; the maps compose by
  a parallel prefix scan, which gives every chunk its true entry state and so all cuts.
* The counter reads the bytes of a piece. Of every prefix exactly one token can be the last one, and which
  one depends on what may still become part of a longer token: the longest suffix that begins some token,
  the last tokens and the relative counts at its positions. These make a state; each transition carries the
  number of tokens that it adds (or takes back). States are compiled when first met and kept by the worker.

Null counts as empty (0 tokens). A special string in a text is one token, as the library has it by default.
No truncation; texts of any length; repeated rows and rows of null doc_id are counted one by one. No shuffle.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lorebank.llm.common import blocks, buffers, span_hash, table, text_of

LIMIT = 512
#: Characters of a chunk, of which a state map is built.
CHUNK = 64
#: Bytes of a span of a long piece, and bytes before it that lead to the state it starts from.
SPAN, WARM = 256, 64
#: Compiled counter states after which a worker starts anew.
MAX_STATES = 100_000
#: Pairs of tokens that a worker knows to follow one another or not, before it starts afresh.
MAX_PAIRS = 2_000_000
#: Pieces with known counts after which a worker starts anew.
MAX_PIECES = 4_000_000

_OTHER, _LETTER, _NUMBER, _BLANK, _SPACE, _MARK = range(6)
_WHITE = [*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]

# Symbols: letter, number, other, contraction of 1 or 2 letters, space before a solid character, other blank
# before one, blank before a blank or the end. The same plus 8: at the first character of a text.
_L, _N, _P, _A1, _A2, _SN, _WN, _WW = range(8)
# States: nothing open; letters, numbers, others, blanks open; a space that the next run takes; 1 or 2
# characters of a contraction to come.
_START, _IN_L, _IN_N, _IN_P, _IN_W, _TAKEN, _LEFT1, _LEFT2 = range(8)


def _splitter() -> tuple[np.ndarray, np.ndarray]:
    """Next state and whether a piece begins, by state and symbol."""
    to, begins = np.zeros((8, 16), np.uint8), np.zeros((8, 16), bool)
    runs = {_L: _IN_L, _N: _IN_N, _P: _IN_P}
    for s in range(8):
        for x in range(8):
            if s in (_LEFT1, _LEFT2):
                t, b = (_START, False) if s == _LEFT1 else (_LEFT1, False)
            elif x in runs:
                t, b = runs[x], not (s == runs[x] or s == _TAKEN)
            elif x in (_A1, _A2):
                t, b = (_IN_P, False) if s in (_IN_P, _TAKEN) else (_LEFT1 if x == _A1 else _LEFT2, True)
            elif x == _SN:
                t, b = _TAKEN, True
            elif x == _WN:
                t, b = _START, True
            else:
                t, b = _IN_W, s != _IN_W
            to[s, x], begins[s, x] = t, b
    to[:, 8:], begins[:, 8:] = to[_START, :8], True
    return to, begins


_TO, _BEGINS = _splitter()


@lru_cache(maxsize=1)
def _classes() -> np.ndarray:
    kind = {"L": _LETTER, "N": _NUMBER}
    out = np.array([kind.get(unicodedata.category(chr(c))[0], _OTHER) for c in range(0x110000)], np.uint8)
    out[_WHITE] = _BLANK
    out[32], out[39] = _SPACE, _MARK
    return out


def _symbols(chars: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """firsts: where texts begin."""
    kind = _classes()[chars]
    n = len(chars)
    fresh = np.zeros(n + 2, bool)
    fresh[firsts[firsts < n]] = True
    fresh[n:] = True
    ahead = np.zeros(n + 2, np.uint32)
    ahead[:n] = chars
    next_kind = np.full(n, _BLANK, np.uint8)
    next_kind[:-1] = kind[1:]
    solid_next = (next_kind != _BLANK) & (next_kind != _SPACE) & ~fresh[1 : n + 1]
    out = np.array([_P, _L, _N, _WN, _SN, _P], np.uint8)[kind]
    blank = (kind == _BLANK) | (kind == _SPACE)
    out[blank & ~solid_next] = _WW
    marks = np.flatnonzero(kind == _MARK)
    if len(marks):
        a = np.where(fresh[marks + 1], 0, ahead[marks + 1])
        b = np.where(fresh[marks + 1] | fresh[np.minimum(marks + 2, n)], 0, ahead[np.minimum(marks + 2, n + 1)])
        out[marks[np.isin(a, [ord(c) for c in "sdmt"])]] = _A1
        two = np.zeros(len(marks), bool)
        for x, y in ("ll", "ve", "re"):
            two |= (a == ord(x)) & (b == ord(y))
        out[marks[two]] = _A2
    out[fresh[:n]] += 8
    return out


def piece_starts(chars: np.ndarray, firsts: np.ndarray, chunk: int = CHUNK) -> np.ndarray:
    """Marks the characters at which pieces begin."""
    n = len(chars)
    if not n:
        return np.zeros(0, bool)
    symbols = np.zeros(-(-n // chunk) * chunk, np.uint8)
    symbols[:n] = _symbols(chars, firsts)
    rows = np.ascontiguousarray(symbols.reshape(-1, chunk).T).astype(np.intp)  # one column a chunk
    flat_to = np.ascontiguousarray(_TO.T).ravel().astype(np.intp)  # by symbol, then state
    maps = np.tile(np.arange(8, dtype=np.intp)[:, None], (1, rows.shape[1]))  # entry state by chunk → state now
    for step in rows:
        maps = flat_to[step * 8 + maps]
    width = 1  # prefix scan: after it, column i maps the state before chunk 0 to that after chunk i
    while width < maps.shape[1]:
        later = np.take_along_axis(maps[:, width:], maps[:, :-width], axis=0)
        maps = np.concatenate([maps[:, :width], later], axis=1)
        width *= 2
    state = np.concatenate([[_START], maps[_START, :-1]])
    flat_begins = np.ascontiguousarray(_BEGINS.T).ravel()
    out = np.empty(rows.shape, bool)
    for i, step in enumerate(rows):
        at = step * 8 + state
        out[i] = flat_begins[at]
        state = flat_to[at]
    return out.T.ravel()[:n]


class Counter:
    """Tokens of pieces, by the compiled transducer."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        if spec["model"]["type"] != "BPE" or spec.get("normalizer") or (spec.get("pre_tokenizer") or {}).get("type") != "ByteLevel":
            raise ValueError(f"{path} is not a byte-level BPE tokenizer without normalizer")
        if odd := [t["content"] for t in spec["added_tokens"] if t.get("single_word") or t.get("lstrip") or t.get("rstrip")]:
            raise ValueError(f"added tokens that take blanks or whole words only are not counted: {odd}")
        self.special = [t["content"].encode() for t in spec["added_tokens"]]
        chars = self._byte_chars()
        raw = lambda s: bytes(chars[c] for c in s)
        merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        self.rank = {(raw(a), raw(b)): i for i, (a, b) in enumerate(merges)}
        self.tokens = {bytes([i]) for i in range(256)} | {a + b for a, b in self.rank}
        self.begun = {t[:i] for t in self.tokens for i in range(1, len(t))}
        self.halves = {a + b: (a, b) for a, b in self.rank}
        self.made = {a + b: i for (a, b), i in self.rank.items()}
        self.known: list[tuple[np.ndarray, np.ndarray]] = []  # of pieces met before: sorted hashes, counts
        self._reset()

    @staticmethod
    def _byte_chars() -> dict[str, int]:
        """Printable Latin-1 bytes stand for themselves, the others, in order, for what follows U+00FF."""
        plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
        rest = [b for b in range(256) if b not in set(plain)]
        return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}

    def _reset(self) -> None:
        self._fits: dict[tuple[bytes, bytes], bool] = {}
        root = (b"", (b"",), (0,))
        self.ids, self.states = {root: 0}, [root]
        self.to, self.adds = np.full((1024, 256), -1, np.int32), np.zeros((1024, 256), np.int8)

    def _follows(self, a: bytes, b: bytes) -> bool:
        """Whether b can stand right after a.

        It cannot if a merge across the border came before the merges that made a and b. Those are undone
        one by one, the latest first; ``limit`` is the one undone last.
        """
        key = (a, b)
        out = self._fits.get(key)
        if out is None:
            limit, out, made = 1 << 60, True, self.made
            while True:
                if self.rank.get((a, b), limit) < limit:
                    out = False
                    break
                x, y = made.get(a, -1), made.get(b, -1)
                if x < 0 and y < 0:
                    break
                if x > y:
                    limit, a = x, self.halves[a][1]
                else:  # of equal merges the left one comes first
                    limit, b = y + (x == y or y > x), self.halves[b][0]
            self._fits[key] = out
        return out

    def _compile(self, state: int, byte: int) -> None:
        seen, lasts, counts = self.states[state]
        text = seen + bytes([byte])
        last, count, tokens = None, 0, self.tokens
        for i, before in enumerate(lasts):  # a token from position i of the window on
            if before is not None and (t := text[i:]) in tokens and (before == b"" or self._follows(before, t)):
                last, count = t, counts[i] + 1
                break
        # Only positions matter from which what was read may still become a longer token.
        live = [text[i:] in self.begun for i in range(len(text))]
        cut = live.index(True) if True in live else len(text)
        new = (
            text[cut:],
            (*(x if y else None for x, y in zip(lasts[cut:], live[cut:])), last),
            (*(c - count if y else 0 for c, y in zip(counts[cut:], live[cut:])), 0),
        )
        k = self.ids.get(new)
        if k is None:
            k = self.ids[new] = len(self.states)
            self.states.append(new)
            if k >= len(self.to):
                self.to = np.concatenate([self.to, np.full_like(self.to, -1)])
                self.adds = np.concatenate([self.adds, np.zeros_like(self.adds)])
        self.to[state, byte], self.adds[state, byte] = k, count

    def count(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Tokens of data[starts[i]:ends[i]]. Pieces met before are looked up by a 64-bit hash."""
        hashes, at, back = np.unique(span_hash(data, starts, ends), return_index=True, return_inverse=True)
        out = np.full(len(hashes), -1, np.int64)
        for seen, counts in self.known:
            spot = np.minimum(np.searchsorted(seen, hashes), len(seen) - 1)
            out = np.where(seen[spot] == hashes, counts[spot], out)
        new = np.flatnonzero(out < 0)
        if len(new):
            out[new] = self._run(data, starts[at[new]], ends[at[new]])
            own = (hashes[new], out[new].astype(np.int32))
            while self.known and len(self.known[-1][0]) < 2 * len(own[0]):  # tables of about doubling size
                h, c = (np.concatenate(x) for x in zip(self.known.pop(), own))
                order = np.argsort(h, kind="stable")
                own = (h[order], c[order])
            self.known.append(own)
            if sum(len(h) for h, _ in self.known) > MAX_PIECES:
                self.known = []
        return out[back]

    def _steps(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, entry: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """States after data[starts[i]:ends[i]] from state entry[i], and what the transitions add up to.

        All take one step of the transducer at a time together."""
        sizes = ends - starts
        order = np.argsort(-sizes, kind="stable")
        begin, sizes = starts[order], sizes[order]
        state, total = entry[order], np.zeros(len(order), np.int64)
        alive = np.searchsorted(-sizes, -np.arange(int(sizes[0]) if len(sizes) else 0), side="left")  # longer than j
        for j, k in enumerate(alive.tolist()):
            byte = data[begin[:k] + j].astype(np.int64)
            at = state[:k] * 256 + byte
            to = self.to.ravel()[at]
            if (new := to < 0).any():
                for x in np.unique(at[new]).tolist():
                    self._compile(x >> 8, x & 255)
                to = self.to.ravel()[at]
            total[:k] += self.adds.ravel()[at]
            state[:k] = to
        out = np.empty((2, len(order)), np.int64)
        out[0, order], out[1, order] = state, total
        return out[0], out[1]

    def _run(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Tokens of pieces. Long ones are cut into spans that run side by side, each from the state that the bytes
        before it lead to; where that is not the state in which the span before ended, the span runs again."""
        if len(self.states) > MAX_STATES or len(self._fits) > MAX_PAIRS:
            self._reset()
        cuts = np.maximum(1, -(-(ends - starts) // SPAN))
        piece = np.repeat(np.arange(len(starts)), cuts)
        begun = starts[piece] + SPAN * (np.arange(len(piece)) - np.repeat(np.cumsum(cuts) - cuts, cuts))
        ended = np.minimum(begun + SPAN, ends[piece])
        entry, _ = self._steps(data, np.maximum(begun - WARM, starts[piece]), begun, np.zeros(len(piece), np.int64))
        left, added = self._steps(data, begun, ended, entry)
        while True:
            off = np.flatnonzero((entry[1:] != left[:-1]) & (piece[1:] == piece[:-1])) + 1
            if not len(off):
                break
            first = off[np.unique(piece[off], return_index=True)[1]]  # what precedes it is right
            entry[first] = left[first - 1]
            left[first], added[first] = self._steps(data, begun[first], ended[first], entry[first])
        return np.bincount(piece, added, len(starts)).astype(np.int64)

    def count_texts(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Tokens of each text."""
        raw, n = data.tobytes(), len(offsets) - 1
        out = np.zeros(n, np.int64)
        first, last, owner = offsets[:-1], offsets[1:], np.arange(n)
        if any(s in raw for s in self.special):  # such a string is one token, and cuts its text
            parts = []
            for i in range(n):
                text, at = raw[offsets[i] : offsets[i + 1]], 0
                while True:
                    found = [(p, -len(s)) for s in self.special if (p := text.find(s, at)) >= 0]
                    p, size = min(found) if found else (len(text), 0)
                    parts.append((offsets[i] + at, offsets[i] + p, i))
                    if not found:
                        break
                    out[i] += 1
                    at = p - size
            first, last, owner = (np.array(x) for x in zip(*parts))
        keep = last > first
        first, last, owner = first[keep], last[keep], owner[keep]
        if not len(first):
            return out
        body = b"".join([raw[a:b] for a, b in zip(first.tolist(), last.tolist())]) if len(first) != n or len(first) and int((last - first).sum()) != len(raw) else raw
        at = np.concatenate([[0], np.cumsum(last - first)])
        codes = np.frombuffer(body, np.uint8)
        lead = np.flatnonzero((codes & 0xC0) != 0x80)  # the byte at which each character begins
        chars = np.frombuffer(body.decode().encode("utf-32-le"), np.uint32)
        starts = lead[piece_starts(chars, np.searchsorted(lead, at[:-1]))]
        ends = np.concatenate([starts[1:], [len(codes)]])
        np.add.at(out, owner[np.searchsorted(at, starts, side="right") - 1], self.count(codes, starts, ends))
        return out


@lru_cache(maxsize=2)
def counter(path: str) -> Counter:
    """One a Python worker: it keeps what it has compiled."""
    return Counter(path)


def count_udf(path: str):
    @F.arrow_udf("bigint")
    def count(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = counter(path)
        for texts in batches:
            data, offsets = buffers(texts)
            out = np.zeros(len(texts), np.int64)
            for a, b in blocks(offsets, 1 << 20):
                out[a:b] = own.count_texts(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
            yield pa.array(out)

    return count


def token_counts(docs: DataFrame, path: str | None = None, limit: int = LIMIT) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_tokens, over_limit."""
    import public_tokenizers

    text = text_of("text")
    out = docs.select("doc_id", F.octet_length(text).cast("bigint").alias("n_bytes"), count_udf(path or public_tokenizers.path("byte_bpe_50k.json"))(text).alias("n_tokens"))
    return out.withColumn("over_limit", F.col("n_tokens") > limit)


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"))
