"""Secret scans with inferred grammars.

Base matches of three fixed kinds (assignments of credentials, access keys, long hexadecimal runs) are the
labelled credentials. For each kind a prefix tree of their formats is built, whose states are merged where
their counts are statistically compatible (Hoeffding bounds), in the red-blue order; the result is a
deterministic probabilistic automaton. A format is the string of character classes of a credential: digit,
upper case, a-f, g-z, and each of the marks. A fourth automaton is inferred in the same way from ordinary
runs: maximal runs of credential characters in texts without a base match. Rates of all states are smoothed
(half a count for each symbol), and a format that leaves an automaton goes on with the rates of all its states.

Every maximal run of at least ``LEAST_CHARS`` credential characters, other than those that overlap a base
match, is scored by the likelihood of its format under the automata of credentials against that of ordinary
runs. With the share of credentials among all runs as the prior, it is added as kind ``format`` where it is a
credential with a probability of at least ``LEAST_POSTERIOR``.

Grammars are inferred from a bounded sample, by one scan: at most ``MAX_CREDENTIALS`` distinct values of each
kind and ``MAX_ORDINARY`` ordinary runs, those with the smallest hashes. All base matches and all runs of every
whole text are counted, found and scored. Null and empty texts have none; rows of a null or repeated doc_id are each scanned and kept. Without base matches there is no
grammar and nothing is added. Repeated rows are scanned one by one.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from math import log, sqrt
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lorebank.llm.common import blocks, buffers, table, text_of
from lorebank.llm.scratch import checkpointed

KINDS = ("assign", "access", "hex", "format")
MAX_CREDENTIALS, MAX_ORDINARY = 2000, 4000
#: Significance of the merge test.
ALPHA = 0.05
#: Shortest run that is scored (as of base credentials), and how probable a credential must be.
LEAST_CHARS, LEAST_POSTERIOR = 8, 0.99
#: Formats whose scores a worker remembers.
MAX_FORMATS = 1_000_000

_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{32,}")
_HINTS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")

_CHARS = np.zeros(256, bool)
_CHARS[list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-")] = True
_HEX_CHARS = np.zeros(256, bool)
_HEX_CHARS[list(b"0123456789abcdef")] = True
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_CLASSES = {"0": "0123456789", "A": "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "a": "abcdef", "z": "ghijklmnopqrstuvwxyz"}
_FORMAT = bytes(next((ord(k) for k, members in _CLASSES.items() if chr(b) in members), b) for b in range(256))
#: Symbols of formats: classes, marks and the end.
_SYMBOLS = len(_CLASSES) + len("+/_.=-") + 1


def format_of(value: str) -> str:
    return value.encode().translate(_FORMAT).decode()


class Automaton:
    """A deterministic probabilistic automaton: by state, counts of symbols and ends, and the next states."""

    def __init__(self, strings: list[str], alpha: float = ALPHA):
        self.count: list[Counter] = [Counter()]
        self.to: list[dict[str, int]] = [{}]
        for s in strings:  # the prefix tree; None is the end
            q = 0
            for c in s:
                self.count[q][c] += 1
                if c not in self.to[q]:
                    self.to[q][c] = len(self.to)
                    self.to.append({})
                    self.count.append(Counter())
                q = self.to[q][c]
            self.count[q][None] += 1
        self._merge(alpha)

    def _compatible(self, a: int, b: int, bound: float) -> bool:
        todo = [(a, b)]
        while todo:
            a, b = todo.pop()
            x, y = self.count[a], self.count[b]
            n, m = sum(x.values()), sum(y.values())
            if not n or not m:
                continue
            width = bound * (1 / sqrt(n) + 1 / sqrt(m))
            if any(abs(x[c] / n - y[c] / m) > width for c in x.keys() | y.keys()):
                return False
            todo += [(self.to[a][c], self.to[b][c]) for c in self.to[a].keys() & self.to[b].keys()]
        return True

    def _fold(self, a: int, b: int) -> None:
        """Adds the subtree of b to a."""
        todo = [(a, b)]
        while todo:
            a, b = todo.pop()
            self.count[a].update(self.count[b])
            for c, q in self.to[b].items():
                if c in self.to[a]:
                    todo.append((self.to[a][c], q))
                else:
                    self.to[a][c] = q

    def _merge(self, alpha: float) -> None:
        bound = sqrt(0.5 * log(2 / alpha))
        red, done = [0], {0}
        while True:
            blue = [(q, c, p) for q in red for c, p in sorted(self.to[q].items()) if p not in done]
            if not blue:
                break
            q, c, p = blue[0]
            for r in red:
                if self._compatible(r, p, bound):
                    self.to[q][c] = r
                    self._fold(r, p)
                    break
            else:
                red.append(p)
                done.add(p)
        smooth = lambda counts: (Counter(counts), log(sum(counts.values()) + 0.5 * _SYMBOLS))
        total: Counter = Counter()
        self.states = {}
        for q in red:
            total.update(self.count[q])
            self.states[q] = (*smooth(self.count[q]), dict(self.to[q]))
        self.other = (*smooth(total), {})
        del self.count, self.to

    def score(self, s: str) -> float:
        """Logarithm of the likelihood of a format."""
        (counts, whole, to), out = self.states.get(0, self.other), 0.0
        for c in s:
            out += log(counts[c] + 0.5) - whole
            counts, whole, to = self.states[to[c]] if c in to else self.other
        return out + log(counts[None] + 0.5) - whole


class Grammar:
    """Automata of the kinds and of ordinary runs; credentials and runs: how many there are."""

    def __init__(self, samples: dict[str, list[str]], ordinary: list[str], credentials: int, runs: int):
        self.automata = [Automaton(sorted(format_of(v) for v in values)) for values in samples.values() if values]
        self.ordinary = Automaton(sorted(format_of(v) for v in ordinary))
        self.least = log(max(1, runs) / max(1, credentials)) + log(LEAST_POSTERIOR / (1 - LEAST_POSTERIOR))
        self.known: dict[bytes, bool] = {}

    def gain(self, value: str) -> float:
        """Logarithm of how many times likelier a value's format is as a credential."""
        f = format_of(value)
        return max((a.score(f) for a in self.automata), default=-float("inf")) - self.ordinary.score(f)

    def is_credential(self, form: bytes) -> bool:
        """Whether a run of that format is one."""
        known = self.known.get(form)
        if known is None:
            if len(self.known) >= MAX_FORMATS:
                self.known.clear()
            known = self.known[form] = self.gain(form.decode()) >= self.least
        return known


def base_matches(text: str) -> list[tuple[int, int, int, str]]:
    """start, kind, end, credential of the three fixed kinds."""
    out = [(m.start(), 0, m.end(), m[2]) for m in _ASSIGN.finditer(text) if len(m[2]) >= 8]
    out += [(m.start(), 1, m.end(), m[0]) for m in _ACCESS.finditer(text) if len(m[0]) >= 16]
    return sorted(out + [(m.start(), 2, m.end(), m[0]) for m in _HEX.finditer(text)])


def _runs(mask: np.ndarray, offsets: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Runs of marked bytes, within texts, of at least so many bytes."""
    before, after = np.zeros(len(mask), bool), np.zeros(len(mask), bool)
    before[1:], after[:-1] = mask[:-1], mask[1:]
    before[offsets[:-1][offsets[:-1] < len(mask)]] = False
    after[offsets[1:][offsets[1:] > 0] - 1] = False
    a, b = np.flatnonzero(mask & ~before), np.flatnonzero(mask & ~after) + 1
    long = b - a >= least
    return a[long], b[long]


def _suspects(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Marks texts that may hold a base match."""
    base = np.zeros(len(offsets) - 1, bool)
    owner = lambda at: np.searchsorted(offsets, at, side="right") - 1
    a, _ = _runs(_HEX_CHARS[data], offsets, 32)
    base[owner(a)] = True
    raw = data.tobytes()
    low = raw.translate(_LOWER)
    for hint, where in (*((h, low) for h in _HINTS), (b"AKIA", raw)):
        at = where.find(hint)
        while at >= 0:
            base[owner(np.array([at]))] = True
            at = where.find(hint, at + 1)
    return base


class Block:
    """A block of texts: base matches of each, and all its runs of credential characters by their bytes."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.raw, self.offsets = data.tobytes(), offsets
        self.base: dict[int, list[tuple[int, int, int, str]]] = {}
        for i in np.flatnonzero(_suspects(data, offsets)).tolist():
            if found := base_matches(self.raw[offsets[i] : offsets[i + 1]].decode()):
                self.base[i] = found
        start, end = _runs(_CHARS[data], offsets, LEAST_CHARS)
        owner = np.searchsorted(offsets, start, side="right") - 1
        self.runs = list(zip(owner.tolist(), start.tolist(), end.tolist()))

    def spans(self, grammar: Grammar) -> dict[int, list[tuple[int, int, int, str]]]:
        """All spans of the texts that have any: base ones, and added ones that overlap none of them."""
        out = {i: list(found) for i, found in self.base.items()}
        if not grammar.automata:
            return out
        forms = self.raw.translate(_FORMAT)
        for i, a, b in self.runs:
            if grammar.is_credential(forms[a:b]):
                s = len(self.raw[self.offsets[i] : a].decode())
                e = s + b - a
                if not any(x < e and s < y for x, _, y, _ in self.base.get(i, ())):
                    out.setdefault(i, []).append((s, 3, e, self.raw[a:b].decode()))
        return {i: sorted(found) for i, found in out.items()}


def _read(texts: pa.Array) -> Iterator[tuple[int, Block]]:
    """Blocks of texts, each with its number of texts."""
    data, offsets = buffers(texts)
    for a, b in blocks(offsets):
        yield b - a, Block(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])


_SPANS = T.StructType().add("n_assign", T.LongType()).add("n_access", T.LongType()).add("n_hex", T.LongType()).add("n_format", T.LongType()).add("base_spans", T.StringType()).add("spans", T.StringType())


class _Sample:
    """The distinct values with the smallest hashes, and how many values came."""

    def __init__(self, limit: int):
        self.limit, self.bar, self.n, self.held = limit, 1 << 32, 0, {}

    def add(self, value: bytes) -> None:
        self.n += 1
        h = crc32(value)
        if h < self.bar:
            self.held[value] = h
            if len(self.held) > 2 * self.limit:
                self.held = dict(sorted(self.held.items(), key=lambda x: (x[1], x[0]))[: self.limit])
                self.bar = max(self.held.values()) + 1


def _sample_task(limits: list[int]):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        samples = [_Sample(n) for n in limits]
        for batch in batches:
            for _, block in _read(batch["text"]):
                for found in block.base.values():
                    for _, kind, _, value in found:
                        samples[kind].add(value.encode())
                for i, a, b in block.runs:
                    if i not in block.base:
                        samples[3].add(block.raw[a:b])
        for kind, sample in enumerate(samples):
            values, hashes = list(sample.held), list(sample.held.values())
            yield pa.RecordBatch.from_arrays(
                [pa.array([kind] * (len(values) + 1), pa.int32()), pa.array([*(v.decode() for v in values), None], pa.string()), pa.array([*hashes, None], pa.int64()), pa.array([0] * len(values) + [sample.n], pa.int64())],
                ["kind", "value", "hash", "n"],
            )

    return task


def spans_udf(grammar: Grammar, spark: SparkSession):
    shared = spark.sparkContext.broadcast(grammar)

    @F.arrow_udf(_SPANS)
    def spans(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        grammar = shared.value
        said = lambda found: ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e, _ in found)
        for texts in batches:
            rows: list[list[tuple[int, int, int, str]]] = []
            for n, block in _read(texts):
                found = block.spans(grammar)
                rows += [found.get(i, []) for i in range(n)]
            counts = [pa.array([sum(k == kind for _, k, _, _ in r) for r in rows], pa.int64()) for kind in range(4)]
            base = pa.array([said([x for x in r if x[1] < 3]) for r in rows], pa.string())
            yield pa.StructArray.from_arrays([*counts, base, pa.array([said(r) for r in rows], pa.string())], ["n_assign", "n_access", "n_hex", "n_format", "base_spans", "spans"])

    return spans


def infer(docs: DataFrame, limit: int = MAX_CREDENTIALS, ordinary: int = MAX_ORDINARY) -> Grammar:
    """Grammars from at most ``limit`` distinct credentials of each kind and so many ordinary runs. Each task sends a bounded sample."""
    limits = [limit] * 3 + [ordinary]
    found = checkpointed(docs.select(text_of("text").alias("text")).mapInArrow(_sample_task(limits), "kind int, value string, hash bigint, n bigint"))
    n = {r.kind: r.n for r in found.groupBy("kind").agg(F.sum("n").alias("n")).collect()}
    values = []
    for kind, most in enumerate(limits):
        rows = found.filter((F.col("kind") == kind) & F.col("value").isNotNull()).select("hash", "value").distinct().orderBy("hash", "value").limit(most).collect()
        values.append([r.value for r in rows])
    credentials = sum(n.get(kind, 0) for kind in range(3))
    return Grammar(dict(zip(KINDS, values[:3])), values[3], credentials, credentials + n.get(3, 0))


def secrets(docs: DataFrame, grammar: Grammar | None = None) -> DataFrame:
    """One row per document: doc_id, counts by kind, base_spans and spans as kind:start:end."""
    grammar = grammar or infer(docs)
    return docs.select("doc_id", spans_udf(grammar, docs.sparkSession)(text_of("text")).alias("s")).select("doc_id", "s.*")


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2("base_spans", 256).alias("base_sha256"), "spans", "n_format")
