"""Language-model scores by a hierarchical Pitman-Yor model.

Tokens are words between white space, A-Z lower-cased, then one end a text. The restaurant of a context
seats the tokens that follow it; a context is the token before (a text begins in the context of the end), and
each token of the training texts has its own. The ``HEADS`` most frequent tokens decide only where pairs are kept
(by token after a head, by context before a head, else by token; buckets tell each other tables and customers of
contexts in every sweep). All contexts share one parent restaurant, in which each table of a context is a customer;
its base is uniform over the training types, with a share for unknown tokens that makes their probability the Good-Turing estimate (tokens seen once over all). Discounts come from
the counts of counts of each level.

Gibbs: given the numbers of tables in the restaurants, the number of tables that serve one token in one
context is drawn from its exact conditional (generalised Stirling numbers) for up to ``EXACT`` customers. For
more, tables are a Poisson number of groups with Sibuya sizes that add up to the customers, and their number
is drawn by the saddle-point mean and variance of that: the mean is within 5 % of the exact one for discounts
from 0.3 to 0.95 (2.6 % from 0.6 to 0.8), and within 11 % for smaller ones. All tokens are drawn in parallel
from the totals of the sweep before, and the totals are summed anew after each sweep. Predictive
probabilities are averaged over the last sweeps.

Everything from the corpus is counted over all training rows, by Spark: counts are added up in each task,
dealt by bucket and added again; tables follow the input. The heads and the most frequent pairs after heads (a
fixed number of each) are broadcast; those pairs are scored where the texts are read. All other tokens go, packed,
to the bucket that holds their probabilities; sums come back, packed by blocks of texts.

Null counts as empty: one token, the end. Repeated rows, and rows of a null doc_id (never held out), are each counted and scored; the id -2^63 stands for null. An empty table gives
an empty result; without training rows the base is one type, the unknown. Tokens are told apart by 52 bits of
a hash, pairs of two other tokens by 64.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache, cached_property, lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, GroupedData, SparkSession
from pyspark.sql import functions as F

from lorebank.llm.common import SOLID_BYTES, Words, blocks, buffers, mixed, table, text_of
from lorebank.llm.scratch import bucketed, checkpointed, removed, shuffles_cleared

#: Tokens whose counts are shared by all tasks and stand in a pair's low bits. They decide where a pair is kept, not how it is seated.
CONTEXTS = 4096
HEADS = CONTEXTS - 1
#: Pairs that are broadcast, and buckets over which the pairs of one head are dealt.
FREQUENT, SPREAD = 1 << 18, 256
#: Sweeps before and while probabilities are averaged.
BURN_IN, SAMPLES = 3, 3
STRENGTH = 1.0
EXACT = 128
BANDS = [1, 2, 3, 4, 5, 6, 8, 10, 12, 16, 20, 24, 32, 40, 48, 64, 80, 96, EXACT]
#: Keys held by a counting task before it passes them on.
HELD_KEYS = 1_500_000
EVENT_BLOCK = 8 << 20
#: Stands for a null doc_id on the way.
NO_ID = -(1 << 63)

_CTX = np.uint64(CONTEXTS - 1)
_TOKEN = ~_CTX
_END = np.uint64(0xA5A5_1234_5678_9A40) & _TOKEN

PARTS = "bucket int, kind int, keys binary, others binary, counts binary"
COUNTS = "bucket int, keys binary, counts binary, b_keys binary, b_counts binary, words binary, others binary, pair_counts binary"
MODEL = "bucket int, keys binary, p binary, tokens binary, p_parent binary, counts binary, back binary, b_keys binary, b_p binary, pairs binary, pair_p binary, pair_back binary, pair_counts binary, home int"
#: What a bucket holds and gets while tables are drawn. Kinds: 0 its repeated pairs, 1 its words, 2 contexts of pairs held
#: elsewhere, 3 tables of contexts, 4 tables of a context's pairs, 5 sums (bucket -1), 6 what contexts leave, 7 all pairs,
#: 8 contexts of repeated pairs held elsewhere. Kinds 2, 3, 4, 6 and 8 go by relays.
STATE = "bucket int, kind int, draw int, src int, a binary, b binary, c binary, d binary, e binary, f binary, g binary, h binary, i binary, j binary, k binary"
PACKED = "bucket int, kind int, a binary, b binary, c binary, d binary, e binary, f binary, g binary, h binary, i binary, j binary, k binary, l binary, block bigint"
SCORES = "block bigint, kind int, a binary, b binary, c binary"
SUMS = "doc_id bigint, n_tokens bigint, n_known bigint, base_score double, score double"


NO_HEADS = np.zeros(0, np.uint64)


class Slots:
    """Finds keys among others, which are in order: by a table of slots, and by search where keys share a slot."""

    def __init__(self, keys: np.ndarray):
        bits = max(8, min(24, (4 * len(keys)).bit_length()))
        self.keys, self.shift = keys, np.uint64(64 - bits)
        slot = self._slot(keys)
        self.at = np.zeros(1 << bits, np.int32)
        self.at[slot] = np.arange(len(keys))
        shared = np.bincount(slot, minlength=1 << bits) > 1
        self.at[shared] = ~self.at[shared]

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def found(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where each key stands, and whether it does."""
        if not len(self.keys):
            return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
        at = self.at[self._slot(keys)]
        shared = at < 0
        at ^= at >> 31
        there = self.keys[at] == keys
        again = np.flatnonzero(shared & ~there)
        if len(again):
            at[again], there[again] = _found(self.keys, keys[again])
        return at, there


@lru_cache(4)
def _slots(keys: bytes) -> Slots:
    return Slots(np.frombuffer(keys, np.uint64))


def _places(heads: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    """The context of what follows each token: its place among the heads from 1 on, 0 for all others."""
    at, there = _slots(heads.tobytes()).found(tokens) if len(tokens) > len(heads) else _found(heads, tokens)
    return np.where(there, at + 1, 0).astype(np.uint64)


def _tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The tokens of all texts, ends too, and the text of each."""
    words = Words(data, offsets, SOLID_BYTES)
    n = np.diff(words.first)
    ends = np.cumsum(n + 1) - 1
    token = np.empty(len(words.start) + len(n), np.uint64)
    is_end = np.zeros(len(token), bool)
    is_end[ends] = True
    token[is_end], token[~is_end] = _END, words.hash & _TOKEN
    return token, np.repeat(np.arange(len(n)), n + 1)


def token_keys(data: np.ndarray, offsets: np.ndarray, heads: np.ndarray = NO_HEADS) -> tuple[np.ndarray, np.ndarray]:
    """Of each token, ends too: key (token in the high bits, place of the head before, or 0, in the low twelve) and its text."""
    token, text = _tokens(data, offsets)
    return token | np.concatenate([_places(heads, np.array([_END])), _places(heads, token)[:-1]]), text


def _pairs(token: np.ndarray, heads: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each token: kind, key and the token before. Kind 0: after a head, keyed by token and the head's place.
    Kind 1: a head after another token, keyed by that token and the head's place. Kind 2: neither is a head, keyed by the token."""
    before, place = np.concatenate([[_END], token[:-1]]), _places(heads, token)
    under = np.concatenate([_places(heads, np.array([_END])), place[:-1]])
    kind = np.where(under > 0, 0, np.where(place > 0, 1, 2))
    return kind, np.where(kind == 1, before | place, token | under), before


def _pair(words: np.ndarray, contexts: np.ndarray) -> np.ndarray:
    """64-bit hashes of pairs of tokens."""
    return mixed(words ^ mixed(contexts ^ np.uint64(0x5851F42D4C957F2D)))


def _bucket(keys: np.ndarray, n: int) -> np.ndarray:
    return ((keys >> np.uint64(40)) % np.uint64(n)).astype(np.int32)


def _relays(bucket: int, n: int, contexts: np.ndarray) -> np.ndarray:
    """The relay between a bucket and those of contexts. Buckets stand in a square; a relay serves a row of those that hold
    pairs and a column of those that hold their contexts, so that rows grow with n ** 1.5 and not with its square."""
    side = int(np.ceil(np.sqrt(n)))
    return bucket // side * side + _bucket(contexts, n) % side


def _dealt_to(keys: np.ndarray, n: int, heads: np.ndarray) -> np.ndarray:
    """The bucket that holds the probability of a key: by token, and for heads by the pair."""
    spread = np.where(_places(heads, keys & _TOKEN) > 0, mixed(keys) % np.uint64(min(n, SPREAD)), np.uint64(0))
    return ((_bucket(keys, n) + spread.astype(np.int64)) % n).astype(np.int32)


def _added(parts: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
    """parts: ids, counts and columns that go with the ids. Counts of equal ids are added; ids in order."""
    ids, counts, *more = (np.concatenate(x) for x in zip(*parts))
    if not len(ids):
        return (ids, counts, *more)
    order = np.argsort(ids, kind="stable")
    ids = ids[order]
    at = np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1]]))
    return (ids[at], np.add.reduceat(counts[order], at), *(x[order[at]] for x in more))


def _kept(held: list[tuple[np.ndarray, ...]], part: tuple[np.ndarray, ...]) -> None:
    """Adds a part to others, of which each is at least double the next."""
    held.append(part)
    while len(held) > 1 and len(held[-2][0]) < 2 * len(held[-1][0]):
        held.append(_added([held.pop(), held.pop()]))


def _row(names: list[str], numbers: list[int], *columns: np.ndarray) -> pa.RecordBatch:
    """One row: whole numbers, then arrays as bytes; columns that are missing are empty."""
    values = [x.tobytes() for x in columns] + [b""] * (len(names) - len(numbers) - len(columns))
    return pa.RecordBatch.from_arrays([*(pa.array([x], pa.int32()) for x in numbers), *(pa.array([x], pa.binary()) for x in values)], names)


def _names(schema: str) -> list[str]:
    return [x.split()[0] for x in schema.split(",")]


def _runs(of: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each value and where it stands."""
    order = np.argsort(of.astype(np.uint16) if len(of) and of.max() < 65536 else of, kind="stable")
    at = np.flatnonzero(np.concatenate([[True], np.diff(of[order]) != 0])) if len(of) else np.zeros(0, np.int64)
    for x, y in zip(at, [*at[1:], len(of)]):
        yield int(of[order[x]]), order[x:y]


def _count_task(n_buckets: int, heads: np.ndarray | None):
    """Counts of pairs, or of tokens where no heads are given."""

    def dealt(held: dict[int, list]) -> Iterator[pa.RecordBatch]:
        for kind, parts in held.items():
            if parts:
                ids, counts, *more = _added(parts)
                words, others = more or (ids, ids[:0])
                for b, at in _runs(_bucket(words, n_buckets)):
                    yield _row(_names(PARTS), [b, kind], words[at], others[at] if more else others, counts[at])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {0: [], 1: [], 2: []}
        for batch in batches:
            data, offsets = buffers(batch["text"])
            for a, b in blocks(offsets):
                token, _ = _tokens(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                kind, keys, before = _pairs(token, heads) if heads is not None else (np.zeros(len(token), np.int64), token, token)
                for one in (0, 1):
                    k, c = np.unique(keys[kind == one], return_counts=True)
                    _kept(held[one], (k, c.astype(np.int64)))
                words, others = keys[kind == 2], before[kind == 2]
                ids = _pair(words, others)
                at = np.argsort(ids)
                new = np.flatnonzero(np.concatenate([[True], np.diff(ids[at]) != 0])) if len(ids) else np.zeros(0, np.int64)
                first = at[new]
                _kept(held[2], (ids[first], np.diff(new, append=len(ids)), words[first], others[first]))
                if sum(len(x[0]) for parts in held.values() for x in parts) > HELD_KEYS:
                    yield from dealt(held)
                    held = {0: [], 1: [], 2: []}
        yield from dealt(held)

    return task


def _add_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All counts of the buckets of a task, one row a bucket with keys in order."""
    held: dict[int, dict[int, list]] = {}
    for batch in batches:
        for b, kind, k, o, c in zip(*(batch[x].to_pylist() for x in _names(PARTS))):
            own = held.setdefault(b, {0: [], 1: [], 2: []})[kind]
            k, o, c = np.frombuffer(k, np.uint64), np.frombuffer(o, np.uint64), np.frombuffer(c, np.int64)
            _kept(own, (_pair(k, o), c, k, o) if kind == 2 else (k, c))
    none, zero = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    for b, own in held.items():
        (keys, counts), (b_keys, b_counts) = (_added(own[kind]) if own[kind] else (none, zero) for kind in (0, 1))
        _, c, words, others = _added(own[2]) if own[2] else (none, zero, none, none)
        order = np.lexsort((others, words))
        yield _row(_names(COUNTS), [b], keys, counts, b_keys, b_counts, words[order], others[order], c[order])


def _arrays(row: dict) -> dict[str, np.ndarray]:
    """A row of COUNTS as arrays."""
    return {x: np.frombuffer(row[x], np.int64 if x.endswith("counts") else np.uint64) for x in _names(COUNTS)[1:]}


def _sums_task(measure):
    """Applies measure to the arrays of each bucket: an array of statistics, one row for each."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for row in batch.to_pylist():
                own = measure(_arrays(row))
                total = own if total is None else total + own
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total), dtype=np.int32)), pa.array(total.astype(np.int64))], ["i", "x"])

    return task


def _summed(counts: DataFrame, measure, n: int) -> np.ndarray:
    """Sums of a fixed number of statistics over all buckets."""
    out = np.zeros(n, np.int64)
    for r in counts.mapInArrow(_sums_task(measure), "i int, x bigint").groupBy("i").agg(F.sum("x").alias("x")).collect():
        out[r.i] = r.x
    return out


def _at_places(places: np.ndarray, weights: np.ndarray | None = None) -> np.ndarray:
    """Sums by place of a head."""
    return np.bincount(places.astype(np.int64), weights=weights, minlength=CONTEXTS).astype(np.int64)


def _facts(heads: np.ndarray):
    def measure(x: dict[str, np.ndarray]) -> np.ndarray:
        context, after = x["keys"] & _CTX, x["b_keys"] & _CTX
        token, of = np.unique(np.concatenate([x["keys"] & _TOKEN, x["words"]]), return_inverse=True)
        whole = np.bincount(of, weights=np.concatenate([x["counts"], x["pair_counts"]]), minlength=len(token))
        contexts, place = np.bincount(of, minlength=len(token)), _places(heads, token)
        rare, own = place == 0, place > 0
        every = np.concatenate([x["counts"], x["b_counts"], x["pair_counts"]])
        some = [rare.sum(), (whole[rare] == 1).sum(), (every == 1).sum(), (every == 2).sum(), (contexts[rare] == 1).sum(), (contexts[rare] == 2).sum()]
        some += [every.sum(), len(x["b_keys"]) + len(x["words"]), (x["b_counts"] == 1).sum() + (x["pair_counts"] == 1).sum()]
        by_place = [_at_places(context, x["counts"]), _at_places(context), _at_places(context[x["counts"] == 1])]
        by_place += [_at_places(place[own], whole[own]), _at_places(place[own], contexts[own])]
        by_place += [_at_places(after, x["b_counts"]), _at_places(after), _at_places(after[x["b_counts"] == 1])]
        return np.concatenate([*by_place, some]).astype(np.int64)

    return measure


class Totals:
    """What the tasks of a sweep share: sizes of the heads' restaurants, their place in the parent, and sums over all
    others. Its size is fixed."""

    SIZE = 8 * CONTEXTS + 9

    def __init__(self, facts: np.ndarray):
        by_place = facts[: 8 * CONTEXTS].reshape(8, CONTEXTS)
        customers, tables, self.ones, whole, contexts, after, sent, self.sent_ones = by_place
        self.customers, self.tables = customers.astype(float), tables.astype(float)
        self.sent, self.sent_b, self.opened = contexts.astype(float), sent.astype(float), np.minimum(contexts + sent, 1).astype(float)
        types, self.hapax, n1, n2, p1, p2, self.tokens, rare, self.rare_ones = (int(x) for x in facts[8 * CONTEXTS :])
        self.head_counts = whole + after
        contexts = contexts + sent
        self.types = types + int((contexts > 0).sum())
        p1, p2 = p1 + int((contexts == 1).sum()), p2 + int((contexts == 2).sum())
        once = self.hapax + int((self.head_counts == 1).sum())
        self.discount = min(0.95, max(0.05, n1 / (n1 + 2 * n2))) if n1 else 0.5
        self.parent_discount = min(0.95, max(0.05, p1 / (p1 + 2 * p2))) if p1 else 0.5
        self.parent_tables, self.rare_tables, self.rare_back = float(self.types), float(rare), 0.0
        self.once = once / self.tokens if self.tokens else 1.0

    def after(self, sums: np.ndarray) -> "Totals":
        """The totals with the sums of a sweep."""
        import copy

        new, (tables, sent, opened, sent_b) = copy.copy(self), sums[: 4 * CONTEXTS].reshape(4, CONTEXTS)
        rare, parent, back = sums[4 * CONTEXTS :]
        new.tables, new.sent, new.opened, new.sent_b = (x.astype(float) for x in (self.ones + tables, sent, opened, self.sent_ones + sent_b))
        new.rare_tables, new.parent_tables = float(self.rare_ones + rare), float(self.hapax + parent)
        return new.leaving(back)

    def leaving(self, back: int) -> "Totals":
        """With the customers that all contexts but the heads leave to the parent, in units of 2**-20."""
        self.rare_back = float(back) / (1 << 20) + self.hapax * self.hapax_back
        return self

    @property
    def hapax_back(self) -> float:
        """What a context of one customer leaves to the parent."""
        return (STRENGTH + self.discount) / (STRENGTH + 1)

    @property
    def back(self) -> np.ndarray:
        """What each head leaves to the parent; at 0 a context without customers, which leaves all."""
        return (STRENGTH + self.discount * self.tables) / (STRENGTH + self.customers)

    @property
    def below(self) -> float:
        """Tables of all contexts."""
        return self.tables.sum() + self.rare_tables

    @property
    def parent_back(self) -> float:
        return (STRENGTH + self.parent_discount * self.parent_tables) / (STRENGTH + self.below)

    @property
    def unknown(self) -> float:
        """The base's share of unknown tokens."""
        if not self.types:
            return 1.0
        mean = float(((self.customers * self.back).sum() + self.rare_back) / max(1.0, self.tokens))
        return min(0.95, max(1e-6, self.once / max(1e-12, mean * self.parent_back)))

    @property
    def p_unknown(self) -> float:
        return self.parent_back * self.unknown

    @property
    def p_type(self) -> float:
        return (1 - self.unknown) / max(1, self.types)

    def p_parent(self, sent: np.ndarray, opened: np.ndarray) -> np.ndarray:
        """The parent's probability of tokens with so many customers and tables in it."""
        return (sent - self.parent_discount * opened) / (STRENGTH + self.below) + self.parent_back * self.p_type

    @property
    def p_head(self) -> np.ndarray:
        return self.p_parent(self.sent + self.sent_b, self.opened)


@cache
def _stirling(discount: float) -> np.ndarray:
    """Logarithms of generalised Stirling numbers: ways to seat n customers at t tables."""
    out = np.full((EXACT + 1, EXACT + 1), -np.inf)
    out[1, 1] = 0
    for n in range(1, EXACT):
        t = np.arange(1, n + 2)
        with np.errstate(divide="ignore", invalid="ignore"):
            stay = out[n, t] + np.log(np.maximum(n - discount * t, 1e-300))
        out[n + 1, t] = np.logaddexp(out[n, t - 1], np.where(np.isfinite(out[n, t]), stay, -np.inf))
    return out


def _uniform(keys: np.ndarray, turn: int) -> np.ndarray:
    """The same numbers for the same keys and turn, wherever and however often a task runs."""
    return ((mixed(keys ^ mixed(np.uint64(turn))) >> np.uint64(11)).astype(float) + 0.5) * 2.0**-53


def seated(keys: np.ndarray, customers: np.ndarray, rate: np.ndarray, discount: float, turn: int) -> np.ndarray:
    """Tables for the customers of each key; rate: weight of a new table."""
    ways = _stirling(discount).T
    tables = np.minimum(customers, 1)
    u, log_rate = _uniform(keys, turn), np.log(rate)
    few = np.where(customers > EXACT, 0, customers).astype(np.uint8)
    order = np.argsort(few, kind="stable")
    ends = np.cumsum(np.bincount(few, minlength=EXACT + 1))
    # Bands of numbers of customers at once: there are no ways to seat n at more than n tables.
    for low, high in zip(BANDS, BANDS[1:]):
        at, t = order[ends[low] : ends[high]], np.arange(1, high + 1)[:, None]
        for a in range(0, len(at), 40_000 // high):
            part = at[a : a + 40_000 // high]
            weight = np.take(ways[1 : high + 1], few[part], axis=1) + t * log_rate[part]
            weight = np.cumsum(np.exp(weight - weight.max(axis=0)), axis=0)
            tables[part] = 1 + (weight < u[part] * weight[-1]).sum(axis=0)
    many = np.flatnonzero(customers > EXACT)
    if len(many):
        n = customers[many].astype(float)
        mean, spread = _many_tables(n, rate[many], discount)
        v = _uniform(keys[many], turn + 7919)
        z = np.sqrt(-2 * np.log(v)) * np.cos(2 * np.pi * _uniform(keys[many], turn + 104729))
        drawn = np.where(mean > 8, np.rint(1 + mean - (mean / n) ** 2 + np.sqrt(spread) * z), 1 + _poisson(np.minimum(mean, 9), v))
        tables[many] = np.clip(drawn, 1, n).astype(np.int64)
    return tables


def _many_tables(customers: np.ndarray, rate: np.ndarray, discount: float) -> tuple[np.ndarray, np.ndarray]:
    """Mean and variance of the tables beyond the first: the saddle point, found by halving on a logarithmic scale."""
    low, high = np.full(len(rate), -700.0), np.zeros(len(rate))
    log_rate, log_customers = np.log(rate), np.log(customers)
    for _ in range(60):
        mid = (low + high) / 2
        above = log_rate + np.log1p(-np.exp(mid)) - (1 - discount) * mid > log_customers
        low, high = np.where(above, mid, low), np.where(above, high, mid)
    z = np.exp((low + high) / 2)
    mean = rate * -np.expm1(discount * (low + high) / 2) / discount
    sizes = rate * (1 - z) * (z ** (discount - 1) + (1 - z) * (1 - discount) * z ** (discount - 2))
    return mean, np.maximum(mean - customers**2 / sizes, 0.0)


def _poisson(mean: np.ndarray, u: np.ndarray) -> np.ndarray:
    p = np.exp(-mean)
    total, out = p.copy(), np.zeros(len(mean))
    for k in range(1, 40):
        out += u > total
        p = p * mean / k
        total += p
    return out


def _state_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each bucket: its repeated pairs and the numbers of the others (a pair of one customer has one table)."""
    for batch in batches:
        for row in batch.to_pylist():
            x, b = _arrays(row), row["bucket"]
            often, b_often, pair_often = (x[c] > 1 for c in ("counts", "b_counts", "pair_counts"))
            ones = np.unique(np.concatenate([x["keys"][~often] & _TOKEN, x["words"][~pair_often]]), return_counts=True)
            b_ones = np.unique(x["b_keys"][~b_often] & _TOKEN, return_counts=True)
            pairs = (x["words"][pair_often], x["others"][pair_often], x["pair_counts"][pair_often])
            yield _row(_names(STATE), [b, 0, -1, b], x["keys"][often], x["counts"][often], *ones, *pairs, x["b_keys"][b_often], x["b_counts"][b_often], *b_ones)


def _asking_task(n_buckets: int):
    """For the relays: of which contexts a bucket holds pairs of kind 2, and how many of one customer (kind 2) or more (kind 8)."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b, others, counts in zip(*(batch[x].to_pylist() for x in ("bucket", "others", "pair_counts"))):
                often = np.frombuffer(counts, np.int64) > 1
                contexts, of = np.unique(np.frombuffer(others, np.uint64), return_inverse=True)
                single, many = (np.bincount(of, weights=x, minlength=len(contexts)).astype(np.int32) for x in (~often, often))
                for to, at in _runs(_relays(b, n_buckets, contexts)):
                    yield _row(_names(STATE), [to, 2, -1, b], contexts[at], single[at])
                    at = at[many[at] > 0]
                    if len(at):
                        yield _row(_names(STATE), [to, 8, -1, b], contexts[at], many[at])

    return task


def _relay_task(n_buckets: int, adds: tuple[int, ...], answers: dict[int, tuple[int, tuple]]):
    """A relay: numbers of the kinds in adds go, added up by context, to the contexts' buckets. Of a kind in answers, each
    bucket gets the values (of the types there) of the contexts that it asked for by a row of the other kind there."""

    def relay(rows: pa.Table) -> pa.Table:
        got: dict[int, list[dict]] = {}
        for row in rows.to_pylist():
            got.setdefault(row["kind"], []).append(row)
        own, out = rows["bucket"][0].as_py(), []
        for kind in adds:
            if kind in got:
                contexts, of = np.unique(np.concatenate([np.frombuffer(r["a"], np.uint64) for r in got[kind]]), return_inverse=True)
                sums = np.bincount(of, weights=np.concatenate([np.frombuffer(r["b"], np.int32) for r in got[kind]]), minlength=len(contexts)).astype(np.int32)
                for to, at in _runs(_bucket(contexts, n_buckets)):
                    out.append(_row(_names(STATE), [to, kind, got[kind][0]["draw"], own], contexts[at], sums[at]))
        for kind, (asked, types) in answers.items():
            if kind in got:
                contexts = np.concatenate([np.frombuffer(r["a"], np.uint64) for r in got[kind]])
                values = [np.concatenate([np.frombuffer(r[c], x) for r in got[kind]]) for c, x in zip("bc", types)]
                order = np.argsort(contexts)
                for r in got[asked]:
                    wanted = np.frombuffer(r["a"], np.uint64)
                    at = order[np.searchsorted(contexts, wanted, sorter=order)]
                    out.append(_row(_names(STATE), [r["src"], kind, got[kind][0]["draw"], own], wanted, *(x[at] for x in values)))
        return _batches(out, STATE)

    return relay


def _words_task(heads: np.ndarray):
    """The heads and repeated tokens of each bucket."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                tokens, counts = (x := _arrays(row))["keys"], x["counts"]
                at = (counts > 1) | (_places(heads, tokens) > 0)
                yield _row(_names(STATE), [row["bucket"], 1, -1, row["bucket"]], tokens[at], counts[at])

    return task


class Seats:
    """The repeated pairs of a bucket: draws their tables, given the totals and what other buckets sent."""

    def __init__(self, rows: pa.Table, heads: np.ndarray):
        self.got: dict[int, list[dict]] = {}
        for row in sorted(rows.to_pylist(), key=lambda r: (r["kind"], r["draw"], r["src"])):
            self.got.setdefault(row["kind"], []).append(row)
        word = self.got.get(1, [{"a": b"", "b": b""}])[0]
        self.tokens, self.customers = np.frombuffer(word["a"], np.uint64), np.frombuffer(word["b"], np.int64)
        kinds = (np.uint64, np.int64, np.uint64, np.int64, np.uint64, np.uint64, np.int64, np.uint64, np.int64, np.uint64, np.int64)
        own = self.got.get(0, [dict.fromkeys("abcdefghijk", b"")])[0]
        self.keys, self.counts, one, ones, self.words, self.others, pair_counts, self.b_keys, self.b_counts, b_one, b_ones = (np.frombuffer(own[c], kind) for c, kind in zip("abcdefghijk", kinds))
        self.place = _places(heads, self.tokens)
        self.head = self.place > 0
        self.context = (self.keys & _CTX).astype(np.int64)
        self.of = np.searchsorted(self.tokens, np.concatenate([self.keys & _TOKEN, self.words]))
        self.ids = np.concatenate([self.keys, self.words ^ mixed(self.others)])
        self.every = np.concatenate([self.counts, pair_counts])
        self.ones = self._added(self.tokens, [(one, ones)])
        # The contexts kept here, and their tables for pairs of one customer.
        self.contexts, self.c_customers = self.tokens[~self.head], self.customers[~self.head]
        self.c_of = np.searchsorted(self.contexts, self.b_keys & _TOKEN)
        held = [(np.frombuffer(r["a"], np.uint64), np.frombuffer(r["b"], np.int32)) for r in self.got.get(2, [])]
        self.c_ones = self._added(self.contexts, [(b_one, b_ones), *held])

    @staticmethod
    def _added(tokens: np.ndarray, parts: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """Sums of values for each of the tokens; values of others are left out. A part names a token once."""
        out = np.zeros(len(tokens))
        for t, x in parts:
            at = np.minimum(np.searchsorted(tokens, t), max(0, len(tokens) - 1))
            there = tokens[at] == t if len(tokens) else np.zeros(len(t), bool)
            out[at[there]] += x[there]
        return out

    def asked(self, draw: int) -> list[tuple[int, np.ndarray, np.ndarray]]:
        """Which relay has repeated pairs of which contexts of this bucket, and their tables in the sweep before."""
        got = self.got.get(8, []) if draw < 1 else [r for r in self.got.get(4, []) if r["draw"] == draw]
        return [(r["src"], np.frombuffer(r["a"], np.uint64), np.frombuffer(r["b"], np.int32)) for r in got]

    def drawn(self, t: Totals, sweep: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Tables of the pairs kept by token; of each token, its customers and tables in the parent, and its probability:
        two turns, the first to find its place there."""
        known = [(np.frombuffer(r["a"], np.uint64), np.frombuffer(r["b"], np.int64)) for r in self.got.get(3, []) if r["draw"] == sweep]
        contexts, tables = (np.concatenate([np.zeros(0, kind), *x]) for kind, x in zip((np.uint64, np.int64), zip(*known) if known else ((), ())))
        order = np.argsort(contexts)
        beside = tables[order][np.searchsorted(contexts[order], self.others)]
        weight = STRENGTH + t.discount * np.concatenate([t.tables[self.context], beside])
        away = np.where(self.head, t.sent_b[self.place.astype(np.int64)], 0)
        base = self.ones + away
        sent = base + np.bincount(self.of, minlength=len(base))
        opened = np.minimum(sent, 1)
        for turn in (0, 1):
            rate = weight * t.p_parent(sent, opened)[self.of]
            tables = seated(self.ids, self.every, rate, t.discount, 2 * sweep + turn)
            sent = base + np.bincount(self.of, weights=tables, minlength=len(base))
            up = np.full(len(base), (STRENGTH + t.parent_discount * t.parent_tables) * t.p_type)
            opened = seated(self.tokens, sent.astype(np.int64), up, t.parent_discount, 2 * sweep + turn + 1_000_003)
        return tables, sent - away, opened, t.p_parent(sent, opened)

    def left(self, t: Totals, sweep: int) -> tuple[np.ndarray, np.ndarray]:
        """Tables of the pairs kept by context, and all tables of each context kept here. Before the first sweep each pair has one."""
        base = self.c_ones + self._added(self.contexts, [(c, n) for _, c, n in self.asked(sweep)])
        tables = np.ones(len(self.b_keys), np.int64)
        whole = base + np.bincount(self.c_of, minlength=len(base))
        up = t.p_head[(self.b_keys & _CTX).astype(np.int64)]
        for turn in (0, 1) if sweep >= 0 else ():
            tables = seated(~self.b_keys, self.b_counts, (STRENGTH + t.discount * whole[self.c_of]) * up, t.discount, 2 * sweep + turn)
            whole = base + np.bincount(self.c_of, weights=tables, minlength=len(base))
        return tables, whole

    def back(self, t: Totals, whole: np.ndarray) -> np.ndarray:
        return (STRENGTH + t.discount * whole) / (STRENGTH + self.c_customers)


def _batches(rows: list[pa.RecordBatch], schema: str) -> pa.Table:
    if rows:
        return pa.Table.from_batches(rows)
    return pa.table({x: pa.array([], pa.int32() if kind == "int" else pa.binary()) for x, kind in (c.split() for c in schema.split(","))})


def _sweep_task(t: Totals, sweep: int, heads: np.ndarray, n_buckets: int):
    """A sweep over a bucket: sums (bucket -1) and what the next sweep needs. Before the first, at -1, nothing is drawn."""

    def task(rows: pa.Table) -> pa.Table:
        seats, out = Seats(rows, heads), []
        bucket = rows["bucket"][0].as_py()
        b_tables, whole = seats.left(t, sweep)
        for src, contexts, _ in seats.asked(sweep):
            out.append(_row(_names(STATE), [src, 3, sweep + 1, bucket], contexts, whole[np.searchsorted(seats.contexts, contexts)].astype(np.int64)))
        left = int(np.rint(seats.c_customers * seats.back(t, whole) * (1 << 20)).astype(np.int64).sum())
        sums = np.zeros(4 * CONTEXTS, np.int64)
        rare = opened = np.zeros(0)
        if sweep >= 0:
            tables, sent, opened, _ = seats.drawn(t, sweep)
            n = len(seats.keys)
            at, rare = seats.place[seats.head], tables[n:]
            sums = np.concatenate([_at_places(seats.context, tables[:n]), _at_places(at, sent[seats.head]), _at_places(at, opened[seats.head]), _at_places(seats.b_keys & _CTX, b_tables)])
            contexts, of = np.unique(seats.others, return_inverse=True)
            all_ = np.bincount(of, weights=rare, minlength=len(contexts)).astype(np.int32)
            for to, at in _runs(_relays(bucket, n_buckets, contexts)):
                out.append(_row(_names(STATE), [to, 4, sweep + 1, bucket], contexts[at], all_[at]))
        some = np.array([rare.sum() + b_tables.sum(), opened.sum(), left]).astype(np.int64)
        out.append(_row(_names(STATE), [-1, 5, sweep, bucket], np.concatenate([sums, some])))
        return _batches(out, STATE)

    return task


def _back_task(draws: list[tuple[Totals, int]], heads: np.ndarray):
    """What each context leaves to the parent, averaged, and its customers: for the relays of all buckets that hold pairs of it."""

    def task(rows: pa.Table) -> pa.Table:
        seats, out = Seats(rows, heads), []
        bucket = rows["bucket"][0].as_py()
        back = np.mean([seats.back(t, seats.left(t, sweep)[1]) for t, sweep in draws], axis=0)
        for r in seats.got.get(2, []):
            contexts = np.frombuffer(r["a"], np.uint64)
            out.append(_row(_names(STATE), [r["src"], 6, -1, bucket], contexts, *_of_contexts(contexts, seats, back, draws[0][0])))
        return _batches(out, STATE)

    return task


def _of_contexts(contexts: np.ndarray, seats: Seats, back: np.ndarray, t: Totals) -> tuple[np.ndarray, np.ndarray]:
    """What contexts leave to the parent, and their customers. Those that are not repeated have one."""
    if not len(seats.contexts):
        return np.full(len(contexts), t.hapax_back, np.float32), np.ones(len(contexts), np.int32)
    at = np.minimum(np.searchsorted(seats.contexts, contexts), len(seats.contexts) - 1)
    there = seats.contexts[at] == contexts
    return np.where(there, back[at], t.hapax_back).astype(np.float32), np.where(there, seats.c_customers[at], 1).astype(np.int32)


def _predict_task(draws: list[tuple[Totals, int]], heads: np.ndarray, least: int, n_buckets: int):
    """Probabilities of every pair and token from averaged tables. Bucket -1: heads, and pairs of at least that level."""

    def task(rows: pa.Table) -> pa.Table:
        seats, out = Seats(rows, heads), []
        home = bucket = rows["bucket"][0].as_py()
        full = seats.got.get(7, [dict.fromkeys("abcdefg", b"")])[0]
        x = _arrays(dict(zip(_names(COUNTS)[1:], (full[c] for c in "abcdefg"))))
        t = draws[0][0]
        d, one = t.discount, np.mean([t.p_parent(1.0, 1.0) for t, _ in draws])
        drawn = [seats.drawn(t, sweep) for t, sweep in draws]
        left = [seats.left(t, sweep) for t, sweep in draws]
        n = len(seats.keys)

        def averaged(counts: np.ndarray, tables: list[np.ndarray]) -> np.ndarray:
            out = np.ones(len(counts))
            out[counts > 1] = np.mean(tables, axis=0)
            return out

        tokens = np.unique(np.concatenate([seats.tokens, x["keys"] & _TOKEN, x["words"]]))
        parent, whole = np.full(len(tokens), one), np.ones(len(tokens), np.int64)
        at = np.searchsorted(tokens, seats.tokens)
        parent[at], whole[at] = np.mean([r[3] for r in drawn], axis=0), seats.customers
        c_back = np.mean([seats.back(t, w) for (t, _), (_, w) in zip(draws, left)], axis=0)
        back, _ = _of_contexts(tokens, seats, c_back, t)
        # After heads.
        keys, counts = x["keys"], x["counts"]
        context, token = (keys & _CTX).astype(np.int64), np.searchsorted(tokens, keys & _TOKEN)
        p = (counts - d * averaged(counts, [r[0][:n] for r in drawn])) / (STRENGTH + t.customers[context]) + np.mean([t.back for t, _ in draws], axis=0)[context] * parent[token]
        # Heads after other tokens.
        context, place = np.searchsorted(tokens, x["b_keys"] & _TOKEN), (x["b_keys"] & _CTX).astype(np.int64)
        b_p = (x["b_counts"] - d * averaged(x["b_counts"], [r[0] for r in left])) / (STRENGTH + whole[context]) + back[context] * np.mean([t.p_head for t, _ in draws], axis=0)[place]
        # Other tokens after other tokens.
        beside = [(np.frombuffer(r["a"], np.uint64), np.frombuffer(r["b"], np.float32), np.frombuffer(r["c"], np.int32)) for r in seats.got.get(6, [])]
        contexts, backs, customers = (np.concatenate(c) for c in zip(*beside)) if beside else (np.zeros(0, kind) for kind in (np.uint64, np.float32, np.int32))
        order = np.argsort(contexts)
        at = order[np.searchsorted(contexts[order], x["others"])]
        pair_back, word = backs[at], np.searchsorted(tokens, x["words"])
        pair_p = (x["pair_counts"] - d * averaged(x["pair_counts"], [r[0][n:] for r in drawn])) / (STRENGTH + customers[at]) + pair_back * parent[word]
        ids = _pair(x["words"], x["others"])
        rare = (x["b_keys"], b_p.astype(np.float32), ids, pair_p.astype(np.float32), pair_back, whole[word])
        none = (np.zeros(0, np.uint64),) * 6

        def row(bucket: int, keys, p, tokens, parent, counts, back=none[0], rare=none) -> None:
            one = _row(_names(MODEL)[:-1], [bucket], keys, p.astype(np.float32), tokens, parent.astype(np.float32), counts, back, *rare)
            out.append(pa.RecordBatch.from_arrays([*one.columns, pa.array([home], pa.int32())], _names(MODEL)))

        head, often = _places(heads, tokens) > 0, _level(counts) >= least
        some = head | (np.bincount(token[often], minlength=len(tokens)) > 0)
        row(-1, keys[often], p[often], tokens[some], parent[some], whole[some])
        rest = ~head[token]
        row(bucket, keys[rest], p[rest], tokens[~head], parent[~head], whole[~head], back[~head], rare)
        keys, p = keys[~rest], p[~rest]
        for to, at in _runs(_dealt_to(keys, n_buckets, heads)):
            row(to, keys[at], p[at], *none[:3])
        return _batches(out, MODEL)

    return task


class Rare:
    """Probabilities and training counts of pairs whose context is no head, as far as one bucket holds them."""

    def __init__(self, rows: list[tuple], look: "Lookup", p_head: np.ndarray, head_counts: np.ndarray):
        """rows: the columns of MODEL from tokens on, as bytes."""
        kinds = (np.uint64, np.float32, np.uint64, np.float32, np.uint64, np.float32, np.float32, np.int64)
        cols = [np.concatenate([np.zeros(0, kind), *(np.frombuffer(r[i], kind) for r in rows)]) for i, kind in enumerate(kinds)]
        by_token, by_key, by_pair = (np.argsort(cols[i], kind="stable") for i in (0, 2, 4))
        self.tokens, self.back = Slots(cols[0][by_token]), cols[1][by_token]
        self.b_keys, self.b_p = Slots(cols[2][by_key]), cols[3][by_key]
        self.pairs, (self.pair_p, self.pair_back, self.pair_counts) = Slots(cols[4][by_pair]), (x[by_pair] for x in cols[5:])
        self.look, self.p_head, self.head_counts = look, p_head, head_counts

    def backs(self, contexts: np.ndarray) -> np.ndarray:
        """What contexts leave to the parent: all, where they have no customers."""
        at, there = self.tokens.found(contexts)
        return np.where(there, self.back[at], 1.0) if len(self.back) else np.ones(len(contexts))

    def heads(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of heads after other tokens."""
        (at, there), place = self.b_keys.found(keys), (keys & _CTX).astype(np.int64)
        p = self.backs(keys & _TOKEN) * self.p_head[place]
        return np.where(there, self.b_p[at], p) if len(self.b_p) else p, self.head_counts[place]

    def seen(self, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of pairs of training texts."""
        at, there = self.pairs.found(pairs)
        if not there.all():
            raise ValueError("a text that is marked as trained is not among the training texts")
        return self.pair_p[at], self.pair_counts[at]

    def any(self, words: np.ndarray, contexts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of any pairs, over what their contexts leave to the parent; that comes from the contexts' buckets."""
        p, counts = self.look(words)
        at, there = self.pairs.found(_pair(words, contexts))
        return np.where(there, self.pair_p[at] / self.pair_back[at], p) if len(self.pair_p) else p, counts


def _found(sorted_: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each key stands, and whether it does."""
    if not len(sorted_):
        return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
    at = np.searchsorted(sorted_, keys)
    at[at == len(sorted_)] = 0
    return at, sorted_[at] == keys


class Lookup:
    """Probabilities of some tokens in some contexts, and their counts."""

    def __init__(self, keys, p, tokens, parent, counts, back: np.ndarray, unknown: float):
        self.keys, self.p, self.tokens, self.parent, self.counts, self.back, self.unknown = keys, p, tokens, parent, counts, back, unknown
        # The counts of the keys' own tokens: a key is there only together with its token.
        self.key_counts = counts[np.minimum(np.searchsorted(tokens, keys & _TOKEN), max(0, len(tokens) - 1))] if len(tokens) else counts

    def __call__(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Probability and training count of each key."""
        if not len(self.tokens):
            return self.back[(keys & _CTX).astype(np.int64)] * self.unknown, np.zeros(len(keys), np.int64)
        token, known = self.token_slots.found(keys & _TOKEN)
        out = self.back[(keys & _CTX).astype(np.int64)] * np.where(known, self.parent[token], self.unknown)
        if len(self.keys):
            at, there = self.found(keys)
            out = np.where(there, self.p[at], out)
        return out, np.where(known, self.counts[token], 0)

    # Built where they are used, so that they are not broadcast.
    @cached_property
    def slots(self) -> Slots:
        return Slots(self.keys)

    @cached_property
    def token_slots(self) -> Slots:
        return Slots(self.tokens)

    def found(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where each key stands, and whether it does."""
        return self.slots.found(keys)

    def of(self, heads: np.ndarray) -> tuple[bytes, bytes, bytes, bytes, bytes]:
        """The heads without pairs, as a row of ``_lookup``."""
        own = _places(heads, self.tokens) > 0
        return (b"", b"", self.tokens[own].tobytes(), self.parent[own].tobytes(), self.counts[own].tobytes())


def _lookup(rows: list[tuple], back: np.ndarray, unknown: float) -> Lookup:
    """rows: keys, p, tokens, parent, counts as bytes."""
    kinds = (np.uint64, np.float32, np.uint64, np.float32, np.int64)
    cols = [np.concatenate([np.zeros(0, kind), *(np.frombuffer(r[i], kind) for r in rows)]) for i, kind in enumerate(kinds)]
    by_key, by_token = np.argsort(cols[0]), np.argsort(cols[2])
    return Lookup(cols[0][by_key], cols[1][by_key], cols[2][by_token], cols[3][by_token], cols[4][by_token], back, unknown)


def _level(counts: np.ndarray) -> np.ndarray:
    """Sixteen levels for each doubling of a count."""
    return np.floor(16 * np.log2(np.maximum(counts, 1))).astype(np.int64)


def _levels(x: dict[str, np.ndarray]) -> np.ndarray:
    """Of keys, how many have each level."""
    return np.bincount(_level(x["counts"]), minlength=16 * 64)


def _least(levels: np.ndarray, most: int) -> int:
    """The lowest level from which on there are at most so many."""
    above = np.cumsum(levels[::-1])[::-1]
    return int(np.argmax(above <= most)) if (above <= most).any() else len(above)


def _often_task(least: int):
    """Keys of at least that level."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, c in zip(batch["keys"].to_pylist(), batch["counts"].to_pylist()):
                yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(k, np.uint64)[_level(np.frombuffer(c, np.int64)) >= least].view(np.int64))], ["token"])

    return task


def _counted(training: DataFrame, n_buckets: int, heads: np.ndarray | None = None) -> DataFrame:
    """Counts of all pairs, or of tokens where no heads are given: one row a bucket."""
    partial = training.select("text").mapInArrow(_count_task(n_buckets, heads), PARTS)
    return bucketed(partial.repartition(n_buckets, "bucket").mapInArrow(_add_task, COUNTS), n_buckets, "bucket")


def head_tokens(words: DataFrame, most: int = HEADS) -> np.ndarray:
    """The most frequent tokens, at most so many (of equal level all or none), in order."""
    least = _least(_summed(words, _levels, 16 * 64), most)
    return np.sort(np.array([r.token for r in words.mapInArrow(_often_task(least), "token bigint").collect()], np.int64).view(np.uint64))


def _base(counts: np.ndarray, n: int, types: int) -> np.ndarray:
    return np.log10((counts + 0.1) / (n + 0.1 * (types + 1)))


def _event_task(shared, n_buckets: int, n: int, types: int):
    """Scores frequent pairs; packs the other tokens by bucket.

    A block of texts has one row of kind 2 (its doc_ids, sums so far), and one of kind 1 a bucket: the texts of its
    tokens, by their place in the block, and keys in five parts. 0 and 1: those kinds of pairs. 2: hashes of other
    pairs of trained texts. 3: words of other pairs, with their contexts; 4: those contexts, for their own bucket."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        (heads, look, *_), block = shared.value, TaskContext.get().partitionId() << 32
        for batch in batches:
            data, offsets = buffers(batch["text"])
            ids = np.asarray(batch["doc_id"].fill_null(NO_ID).to_numpy(zero_copy_only=False), np.int64)
            trained = batch["trained"].to_numpy(zero_copy_only=False)
            for a, b in blocks(offsets, EVENT_BLOCK):
                bounds = offsets[a : b + 1] - offsets[a]
                kind, keys, before, text = [], [], [], []
                for x, y in blocks(bounds):
                    token, of = _tokens(data[offsets[a + x] : offsets[a + y]], bounds[x : y + 1] - bounds[x])
                    for all_, own in zip((kind, keys, before, text), (*_pairs(token, heads), of + x)):
                        all_.append(own)
                kind, keys, before, text = (np.concatenate(x) for x in (kind, keys, before, text))
                kind = kind.astype(np.int8)
                often = kind == 0
                spot = np.zeros(len(keys), np.int64)
                spot[often], often[often] = look.found(keys[often])
                p, c = look.p[spot[often]], look.key_counts[spot[often]]
                m = b - a
                sums = np.stack([np.bincount(text[often], weights=w, minlength=m) for w in (_base(c, n, types), np.log10(p.astype(float)))])
                whole = np.stack([np.bincount(text, minlength=m), np.bincount(text[often], weights=c > 0, minlength=m).astype(np.int64)])
                rows = [(int(mixed(np.uint64(block))[0] % np.uint64(n_buckets)), 2, ids[a:b].tobytes(), whole.tobytes(), sums.tobytes(), b"", b"")]
                kind, keys, before, text = kind[~often], keys[~often], before[~often], text[~often].astype(np.int32)
                bucket = np.where(kind == 0, _dealt_to(keys, n_buckets, heads), _bucket(keys, n_buckets))
                apart = kind == 2
                seen = apart & trained[a:b][text]
                keys = np.where(seen, _pair(keys, before), keys)
                kind[apart & ~seen] = 3
                more = kind == 3
                bucket, keys, text, before = (np.concatenate([x, y]) for x, y in ((bucket, _bucket(before[more], n_buckets)), (keys, before[more]), (text, text[more]), (before, before[more])))
                kind = np.concatenate([kind, np.full(more.sum(), 4, np.int8)])
                place_of = np.zeros(m, np.int32)
                for to, at in _runs(bucket):
                    at = at[np.argsort(kind[at], kind="stable")]
                    if m < 4 * len(at):
                        own = np.flatnonzero(np.bincount(text[at], minlength=m)).astype(np.int32)
                        place_of[own] = np.arange(len(own))
                        place = place_of[text[at]]
                    else:
                        own, place = np.unique(text[at], return_inverse=True)
                    of = kind[at]
                    place = place.astype(np.uint16 if len(own) < 65536 else np.uint32)
                    rows.append((to, 1, own.tobytes(), place.tobytes(), keys[at].tobytes(), np.bincount(of, minlength=5).astype(np.int32).tobytes(), before[at[of == 3]].tobytes()))
                none = pa.array([b""] * len(rows), pa.binary())
                columns = [*(pa.array([r[i] for r in rows], pa.int32()) for i in (0, 1)), *(pa.array([r[i] for r in rows], pa.binary()) for i in range(2, 7)), *[none] * 7]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(np.full(len(rows), block))], _names(PACKED))
                block += 1

    return task


def _score_task(shared, n: int, types: int):
    """A bucket's probabilities (kind 0) and its tokens: sums for the texts of each block."""

    def task(met: pa.Table) -> pa.Table:
        heads, often, p_head, head_counts = shared.value
        out, rows = [], met.to_batches(max_chunksize=1024)
        named = ("kind", "block", *"abcdefghijkl")
        known = [x for batch in rows for kind, _, *x in zip(*(batch[c].to_pylist() for c in named)) if kind == 0]
        look = _lookup([often.of(heads), *known], often.back, often.unknown)
        rare = Rare([(x[2], *x[5:]) for x in known], look, p_head, head_counts)
        for batch in rows:
            for kind, block, *x in zip(*(batch[c].to_pylist() for c in named[:7])):
                if kind == 2:
                    out.append((block, 2, *x[:3]))
                elif kind == 1:
                    own, keys = np.frombuffer(x[0], np.int32), np.frombuffer(x[2], np.uint64)
                    place = np.frombuffer(x[1], np.uint16 if len(x[1]) == 2 * len(keys) else np.uint32)
                    after, heads_after, pairs, words, contexts = np.split(keys, np.cumsum(np.frombuffer(x[3], np.int32))[:-1])
                    found = [look(after), rare.heads(heads_after), rare.seen(pairs), rare.any(words, np.frombuffer(x[4], np.uint64))]
                    p, c = np.concatenate([*(f[0] for f in found), rare.backs(contexts)]), np.concatenate([f[1] for f in found])
                    at = place[: len(c)]
                    of = np.bincount(at, weights=c > 0, minlength=len(own)).astype(np.int32)
                    sums = np.stack([np.bincount(at, weights=_base(c, n, types), minlength=len(own)), np.bincount(place, weights=np.log10(p), minlength=len(own))])
                    out.append((block, 1, x[0], of.tobytes(), sums.tobytes()))
        columns = zip(*out) if out else [()] * 5
        return pa.table([pa.array(list(x), kind) for x, kind in zip(columns, (pa.int64(), pa.int32(), *[pa.binary()] * 3))], _names(SCORES))

    return task


def _gather_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All sums of a block come together: one row a text. The row of kind 2 is a block's first."""
    ids = None

    def done() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x) for x in (ids, total, known, base, score)], ["doc_id", "n_tokens", "n_known", "base_score", "score"])

    for batch in batches:
        for kind, a, b, c in zip(*(batch[x].to_pylist() for x in ("kind", "a", "b", "c"))):
            if kind == 2:
                if ids is not None:
                    yield done()
                ids = np.frombuffer(a, np.int64)
                (total, known), (base, score) = np.frombuffer(b, np.int64).reshape(2, -1).copy(), np.frombuffer(c, np.float64).reshape(2, -1).copy()
            else:
                own, more = np.frombuffer(a, np.int32), np.frombuffer(c, np.float64).reshape(2, -1)
                known[own] += np.frombuffer(b, np.int32)
                base[own] += more[0]
                score[own] += more[1]
    if ids is not None:
        yield done()


def fit(training: DataFrame, n_buckets: int) -> tuple[DataFrame, np.ndarray, Totals, list[tuple[Totals, int]]]:
    """Probabilities by bucket, the heads, the totals, and the sweeps that they average."""
    words = _counted(training, n_buckets)
    heads = head_tokens(words)
    counts = _counted(training, n_buckets, heads)
    now = Totals(_summed(counts, _facts(heads), Totals.SIZE))
    shuffles_cleared(training.sparkSession)
    asked = checkpointed(counts.select("bucket", "others", "pair_counts").mapInArrow(_asking_task(n_buckets), STATE))
    asked_often = checkpointed(asked.filter("kind = 8"))
    own = counts.mapInArrow(_state_task, STATE).unionByName(words.mapInArrow(_words_task(heads), STATE))
    own = own.unionByName(asked.groupBy("bucket").applyInArrow(_relay_task(n_buckets, (2, 8), {}), STATE))
    state = bucketed(own.repartition(n_buckets, "bucket"), n_buckets, "bucket")
    removed(words)
    shuffles_cleared(training.sparkSession)

    def met(*others: DataFrame, here: DataFrame | None = None) -> GroupedData:
        """The state of each bucket, with what was sent to it and what is kept in the same buckets."""
        every = state if here is None else state.unionByName(here)
        for df in others:
            every = every.unionByName(df.filter("bucket >= 0").repartition(n_buckets, "bucket"))
        return every.groupBy("bucket")

    def relayed(sent: DataFrame, asked: DataFrame, adds: tuple[int, ...], answers: dict[int, tuple[int, tuple]]) -> DataFrame:
        met_ = sent.filter("bucket >= 0").unionByName(asked).groupBy("bucket")
        out = checkpointed(met_.applyInArrow(_relay_task(n_buckets, adds, answers), STATE))
        removed(sent)
        return out

    # sent[s]: what sweep s needs from the one before; the first has only what stands for one table a pair.
    sent: list[DataFrame] = []
    draws = []
    for sweep in range(-1, BURN_IN + SAMPLES):
        if sweep >= BURN_IN:
            draws.append((now, sweep))
        if sweep == BURN_IN + SAMPLES - 1:
            break
        swept = checkpointed(met(*sent[-1:]).applyInArrow(_sweep_task(now, sweep, heads, n_buckets), STATE))
        sums = np.zeros(4 * CONTEXTS + 3, np.int64)
        for r in swept.filter("bucket = -1").select("a").mapInArrow(_total_task, "i int, x bigint").groupBy("i").agg(F.sum("x").alias("x")).collect():
            sums[r.i] = r.x
        now = now.after(sums) if sweep >= 0 else now.leaving(int(sums[-1]))
        sent.append(relayed(swept, asked_often, (4,), {3: (8, (np.int64,))}))
    used = [sent[sweep] for _, sweep in draws]
    left = checkpointed(met(*used).applyInArrow(_back_task(draws, heads), STATE))
    back = relayed(left, asked.filter("kind = 2"), (), {6: (2, (np.float32, np.int32))})
    names = dict(zip(_names(STATE)[4:], _names(COUNTS)[1:]))
    full = counts.select("bucket", F.lit(7).alias("kind"), F.lit(-1).alias("draw"), F.lit(-1).alias("src"), *(F.col(names[c]).alias(c) if c in names else F.lit(b"").alias(c) for c in _names(STATE)[4:]))
    least = _least(_summed(counts, _levels, 16 * 64), FREQUENT)
    shuffles_cleared(training.sparkSession)
    every = met(*used, back, here=full)
    model = bucketed(every.applyInArrow(_predict_task(draws, heads, least, n_buckets), MODEL), n_buckets, "home")
    removed(state, counts, asked, asked_often, back, *sent)
    del own, every, full
    shuffles_cleared(training.sparkSession)
    return model, heads, now, draws


def _total_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds up arrays of the same length."""
    total = None
    for batch in batches:
        for x in batch["a"].to_pylist():
            own = np.frombuffer(x, np.int64)
            total = own if total is None else total + own
    if total is not None:
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total), dtype=np.int32)), pa.array(total)], ["i", "x"])


def scored(docs: DataFrame, training: DataFrame | None = None) -> DataFrame:
    """One row per document: doc_id, n_tokens, n_known, train_tokens, base_score, score.

    A boolean column ``trained`` of docs may mark texts that are in training too: their pairs take less to look up."""
    spark = docs.sparkSession
    trained = F.lit(True) if training is None else F.col("trained") if "trained" in docs.columns else F.lit(False)
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_of("text").alias("text"), trained.alias("trained"))
    training = (texts if training is None else training).select(text_of("text").alias("text"))
    n_buckets = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    model, heads, totals, draws = fit(training, n_buckets)
    back = np.mean([t.back for t, _ in draws], axis=0)
    unknown = float(np.mean([t.p_unknown for t, _ in draws]))
    p_head = np.mean([t.p_head for t, _ in draws], axis=0)
    # At most HEADS tokens and FREQUENT pairs with their tokens, whatever the size of the data.
    top = model.filter("bucket = -1").drop("bucket").collect()
    shared = spark.sparkContext.broadcast((heads, _lookup([tuple(map(bytes, r)) for r in top], back, unknown), p_head, totals.head_counts))
    n, types = totals.tokens, totals.types
    events = texts.mapInArrow(_event_task(shared, n_buckets, n, types), PACKED)
    columns = [F.lit(0).alias("kind"), *(F.col(x).alias(c) for x, c in zip(_names(MODEL)[1:-1], "abcdefghijkl")), F.lit(-1).cast("bigint").alias("block")]
    known = model.filter("bucket = home").select(F.col("home").alias("bucket"), *columns)
    for df in (model.filter("bucket >= 0 and bucket <> home").select("bucket", *columns), events):
        known = known.unionByName(df.repartition(n_buckets, "bucket"))
    parts = known.groupBy("bucket").applyInArrow(_score_task(shared, n, types), SCORES)
    sums = parts.repartition(n_buckets, "block").sortWithinPartitions("block", F.desc("kind")).mapInArrow(_gather_task, SUMS)
    return sums.select(F.nullif("doc_id", F.lit(NO_ID)).alias("doc_id"), "n_tokens", "n_known", F.lit(n).cast("bigint").alias("train_tokens"), "base_score", "score")


def op9_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 10 == 0, F.lit(False))
    return scored(docs.withColumn("trained", ~held_out), docs.filter(~held_out)).select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
