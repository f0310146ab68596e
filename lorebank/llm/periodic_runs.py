"""Runs of repeated words (maximal repetitions), by longest previous factors.

Of each text: suffix array by prefix doubling and the longest previous factor of each word give the
Lempel-Ziv blocks; Main's extensions to both sides of each block border find every run that touches a border;
all others lie inside a block and are copied from its source, by their starts. The names of the doubling (equal
for equal stretches of 2^k words) answer all common extensions, exactly and for whole arrays at once.

A run is a stretch of consecutive words with smallest period q (words q apart are identical), of at least
``max(LEAST_WORDS, LEAST_POWER * q)`` words, that no neighbouring word extends with period q. Spark deals out
the texts; each is one row, and no text is cut. A batch of texts is handled at once; a long one is a batch of
its own and needs 4 bytes a word for each doubling that its repeats take.

A null text has no words. Rows are independent: repeated rows, ties of doc_id and null doc_id keep their rows
(``digests`` leaves the words of a null doc_id as they are). An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lorebank.llm.common import SOLID_BYTES, Words, blocks, buffers, table, text_of

LEAST_WORDS = 6
LEAST_POWER = 4

#: start, length and period in words, of one text
Run = tuple[int, int, int]


class Names:
    """Names of all stretches of 2^k words, the suffix array and common extensions, of several texts at once.

    ``ids``: equal for equal words; ``first``: the first word of each text, and one after the last. A stretch
    that is cut by its text's end has a name of its own, so no extension leaves its text.
    """

    def __init__(self, ids: np.ndarray, first: np.ndarray):
        n = len(ids)
        counts = np.diff(first)
        owner, end = np.repeat(np.arange(len(counts)), counts), np.repeat(first[1:], counts)
        self.n, self.levels = n, []
        key = owner * (int(ids.max(initial=0)) + 1) + ids
        rank = np.zeros(n, np.int64)
        active = np.arange(n)
        base = np.zeros(n, np.int64)  # suffixes below the group of each active one
        step = 0
        while True:
            order = np.argsort(key, kind="stable")
            active, key, base = active[order], key[order], base[order]
            new = np.ones(len(active), bool)
            new[1:] = key[1:] != key[:-1]
            group = np.maximum.accumulate(np.where(new, np.arange(len(active)), 0))
            if step:  # each group was one before: its first place is known
                outer = np.ones(len(active), bool)
                outer[1:] = base[1:] != base[:-1]
                lead = np.maximum.accumulate(np.where(outer, np.arange(len(active)), 0))
                rank[active] = base + group - lead
            else:
                rank[active] = group
            self.levels.append(np.append(rank, -1).astype(np.int32 if n < 1 << 31 else np.int64))
            size = np.diff(np.append(np.flatnonzero(new), len(active)))
            keep = np.repeat(size > 1, size)
            active = active[keep]
            if not len(active):
                break
            step = 2 * step if step else 1
            base = rank[active]
            after = active + step
            key = base * (n + 1) + np.where(after < end[active], rank[np.minimum(after, n - 1)] + 1, 0)
        self.rank = rank

    def _named(self, level: int, at: np.ndarray) -> np.ndarray:
        return self.levels[level][np.where(at < 0, self.n, np.minimum(at, self.n))]

    def forward(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many words are equal from i and from j > i on."""
        out = np.zeros(len(i), np.int64)
        for level in range(len(self.levels) - 1, -1, -1):
            same = (j + out < self.n) & (self._named(level, i + out) == self._named(level, j + out))
            out[same] += 1 << level
        return out

    def backward(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many words are equal up to i and up to j > i, these included."""
        out = np.zeros(len(i), np.int64)
        for level in range(len(self.levels) - 1, -1, -1):
            at = i - out - (1 << level) + 1
            same = (at >= 0) & (self._named(level, at) == self._named(level, j - out - (1 << level) + 1))
            out[same] += 1 << level
        return out

    def previous_factors(self) -> tuple[np.ndarray, np.ndarray]:
        """Of each word the longest stretch from it on that begins before too, and where it begins then."""
        sa = np.argsort(self.rank)
        length, source = np.zeros(self.n, np.int64), np.full(self.n, -1)
        for side in (sa, sa[::-1]):
            near = _nearest_smaller(side)
            has = near >= 0
            at, from_ = side[has], side[near[has]]
            common = self.forward(from_, at)
            better = common > length[at]
            length[at[better]], source[at[better]] = common[better], from_[better]
        return length, source


def _nearest_smaller(x: np.ndarray) -> np.ndarray:
    """Of each place the nearest one before it with a smaller value, or -1."""
    near = np.arange(-1, len(x) - 1)
    open_ = np.arange(len(x))
    while True:
        open_ = open_[near[open_] >= 0]
        open_ = open_[x[near[open_]] > x[open_]]
        if not len(open_):
            return near
        near[open_] = near[near[open_]]


def _borders(length: np.ndarray) -> np.ndarray:
    """Where the Lempel-Ziv blocks of all texts begin (each text begins one), and the end."""
    step = np.maximum(length, 1).tolist()
    out, at, n = [], 0, len(step)
    while at < n:
        out.append(at)
        at += step[at]
    return np.array([*out, n], np.int64)


def _touching(names: Names, before: np.ndarray, border: np.ndarray, after: np.ndarray, first: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, ...]:
    """Repetitions (start, end, period) that touch a border between the blocks before..border and border..after."""
    # A run that ends in the second block has its second period begin after the start of the first.
    most = np.where(after - before >= LEAST_WORDS, (after - before - 1) // (LEAST_POWER - 1), 0)
    total = int(most.sum())
    at = np.repeat(np.arange(len(border)), most)
    period = np.arange(total) - np.repeat(np.cumsum(most) - most, most) + 1
    b, lo, hi = border[at], first[at], end[at]
    out = []
    for i, fits in ((b, b + period < hi), (b - period, b - period >= lo)):  # a period to the right, to the left
        i, p = i[fits], period[fits]
        start = i - names.backward(i - 1, i + p - 1)
        out.append((start, i + p + names.forward(i, i + p), p))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def _copy_runs(found: dict[int, list[tuple[int, int]]], borders: np.ndarray, source: np.ndarray) -> None:
    """Adds to the runs that touch borders (by start: end, period) those that lie inside blocks."""
    long = np.flatnonzero(np.diff(borders) >= LEAST_WORDS + 2)
    for b, c in zip(borders[long].tolist(), borders[long + 1].tolist()):
        back = b - int(source[b])
        for s in range(b + 1, c - LEAST_WORDS):
            for e, p in found.get(s - back, ()):
                if e + back < c:
                    found.setdefault(s, []).append((e + back, p))


def find_runs(ids: np.ndarray, first: np.ndarray) -> list[list[Run]]:
    """The runs of each text, by start and then period. ``ids`` and ``first`` as for Names."""
    out: list[list[Run]] = [[] for _ in range(len(first) - 1)]
    chosen = _repetitive(ids, first)
    if not len(chosen):
        return out
    own = np.concatenate([np.arange(first[t], first[t + 1]) for t in chosen])
    starts = np.concatenate([[0], np.cumsum(first[chosen + 1] - first[chosen])])
    names = Names(ids[own], starts)
    length, source = names.previous_factors()
    borders = _borders(length)
    before, border, after = borders[:-1], borders[1:], np.append(borders[2:], len(own))
    after = np.where(np.isin(border, starts), border, after)  # the end of a text is a border too, with nothing behind it
    text = np.searchsorted(starts, border - 1, side="right") - 1
    s, e, p = _touching(names, before, border, after, starts[text], starts[text + 1])
    enough = e - s >= np.maximum(LEAST_WORDS, LEAST_POWER * p)
    s, e, p = s[enough], e[enough], p[enough]
    order = np.lexsort((p, e, s))
    s, e, p = s[order], e[order], p[order]
    least = np.ones(len(s), bool)  # of the periods of one stretch the smallest is its own
    least[1:] = (s[1:] != s[:-1]) | (e[1:] != e[:-1])
    by_text: dict[int, dict[int, list[tuple[int, int]]]] = {}
    for t, x, y, z in zip((np.searchsorted(starts, s[least], side="right") - 1).tolist(), s[least].tolist(), e[least].tolist(), p[least].tolist()):
        by_text.setdefault(t, {}).setdefault(x, []).append((y, z))
    for t, found in by_text.items():
        base = int(starts[t])
        _copy_runs(found, borders[np.searchsorted(borders, base) : np.searchsorted(borders, starts[t + 1]) + 1], source)
        out[chosen[t]] = sorted(((x - base, y - x, z) for x, each in found.items() for y, z in each), key=lambda r: (r[0], r[2]))
    return out


def _repetitive(ids: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The texts in which five consecutive words occur twice: a run's second period begins with such a factor."""
    n, need = len(ids), LEAST_WORDS - 1
    counts = np.diff(first)
    if n < need:
        return np.zeros(0, np.int64)
    owner = np.repeat(np.arange(len(counts)), counts)
    name = ids.astype(np.int64)
    at = np.arange(n)
    at = at[at + need <= np.repeat(first[1:], counts)]
    for k in range(need):  # words, then pairs, ... : places whose factor is unique in its text leave
        if not len(at):
            break
        key = (name[at] if k else owner[at]) * (int(ids.max()) + 1) + ids[at + k]
        order = np.argsort(key)
        at, key = at[order], key[order]
        new = np.ones(len(at), bool)
        new[1:] = key[1:] != key[:-1]
        size = np.diff(np.append(np.flatnonzero(new), len(at)))
        name[at] = np.cumsum(new)
        at = at[np.repeat(size > 1, size)]
    return np.unique(owner[at])


def kept_words(n: int, runs: list[Run]) -> np.ndarray:
    """Words that no run contains after its first period."""
    change = np.zeros(n + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return np.cumsum(change[:n]) == 0


def best_run(runs: list[Run]) -> Run | None:
    """The greatest length by period, exactly; of ties the smallest start, then period."""
    best = None
    for r in runs:  # by start, then period
        if best is None or r[1] * best[2] > best[1] * r[2]:
            best = r
    return best


def planted_words(doc_id: int | None, n: int) -> np.ndarray | None:
    """The order of words that makes a text periodic from one word on, for a tenth of all ids; else None."""
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 or not n:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    at = np.arange(n)
    at[a:] = a + (at[a:] - a) % p
    return at


def _batch(texts: pa.Array, doc_ids: list | None) -> tuple[list[int], list[list[Run]], list[bytes]]:
    """Words, runs and collapsed text of each text. With doc_ids, words are first put in the order of planted_words."""
    data, offsets = buffers(texts)
    sizes: list[int] = []
    runs: list[list[Run]] = []
    collapsed: list[bytes] = []
    for a, z in blocks(offsets):
        block, own = data[offsets[a] : offsets[z]], offsets[a : z + 1] - offsets[a]
        words = Words(block, own, SOLID_BYTES, lower=False)
        n = len(words.start)
        ends = np.concatenate([[0], np.cumsum(words.end - words.start)])
        solid = pa.py_buffer(block[SOLID_BYTES[block]])
        ids = pa.LargeBinaryArray.from_buffers(pa.large_binary(), n, [None, pa.py_buffer(ends), solid]).dictionary_encode().indices.to_numpy().astype(np.int64)
        order = np.arange(n)
        moved = np.zeros(z - a, bool)
        if doc_ids is not None:
            for t in range(a, z):
                lo, hi = words.first[t - a], words.first[t - a + 1]
                if (put := planted_words(doc_ids[t], int(hi - lo))) is not None:
                    order[lo:hi] = lo + put
                    moved[t - a] = True
            ids = ids[order]
        found = find_runs(ids, words.first)
        raw = block.tobytes()
        for t in range(z - a):
            lo, hi = words.first[t], words.first[t + 1]
            if found[t] or moved[t]:
                stay = order[lo:hi][kept_words(int(hi - lo), found[t])]
                collapsed.append(b" ".join(raw[s:e] for s, e in zip(words.start[stay].tolist(), words.end[stay].tolist())))
            else:
                collapsed.append(b" ".join(raw[own[t] : own[t + 1]].split()))
        sizes += np.diff(words.first).tolist()
        runs += found
    return sizes, runs, collapsed


def periodic_runs(docs: DataFrame) -> DataFrame:
    """docs with n_words, runs (start, length, period in words) and collapsed_text: each run cut to its first period.

    Columns of docs with these names are replaced.
    """
    kept = [c for c in docs.columns if c not in ("n_words", "runs", "collapsed_text")]
    struct = pa.struct([(k, pa.int64()) for k in ("start", "length", "period")])

    @F.arrow_udf("struct<n_words: long, runs: array<struct<start: long, length: long, period: long>>, collapsed_text: string>")
    def report(texts: pa.Array) -> pa.Array:
        sizes, runs, collapsed = _batch(texts, None)
        rows = [[dict(zip(("start", "length", "period"), r)) for r in each] for each in runs]
        return pa.StructArray.from_arrays(
            [pa.array(sizes, pa.int64()), pa.array(rows, pa.list_(struct)), pa.array(collapsed, pa.binary()).cast(pa.string())], names=["n_words", "runs", "collapsed_text"]
        )

    found = docs.select(*kept, report(text_of("text")).alias("_found"))
    return found.select(*kept, "_found.n_words", "_found.runs", "_found.collapsed_text")


def digests(docs: DataFrame) -> DataFrame:
    """Of each document, its words in the order of planted_words: the best run and digests of all runs and of the collapsed text."""
    schema = pa.schema([(c, pa.int64()) for c in ("doc_id", "n_runs", "start", "length", "period", "exponent_milli")] + [("runs_sha256", pa.string()), ("collapsed_sha256", pa.string())])

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_pylist()
            _, runs, collapsed = _batch(batch.column(1), ids)
            best = [best_run(each) for each in runs]
            yield pa.record_batch(
                [
                    batch.column(0), pa.array([len(x) for x in runs], pa.int64()),
                    *(pa.array([r and r[k] for r in best], pa.int64()) for k in range(3)),
                    pa.array([r and 1000 * r[1] // r[2] for r in best], pa.int64()),
                    pa.array([hashlib.sha256("".join("%d,%d,%d\n" % r for r in x).encode()).hexdigest() for x in runs], pa.string()),
                    pa.array([hashlib.sha256(x).hexdigest() for x in collapsed], pa.string()),
                ],
                schema=schema,
            )

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_of("text").alias("text"))
    return rows.mapInArrow(coded, "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string")


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(table(spark, sf_dir, "documents"))
