"""Toxicity by compression distance: zstandard dictionaries of toxic and of ordinary text.

A window is one word between fixed bytes (so that the compressor, which searches neither the first nor the
last bytes of an input, sees all of it). The ordinary dictionary is trained on runs of words of ordinary
documents; the toxic one on the words of toxic documents that ordinary ones nearly never have, and it holds
the ordinary one too. A window's distance is how much shorter it gets with the toxic dictionary; with the
length that is left it picks a cell, whose log odds were learned. The three highest log odds of a document's
distinct words and its length give the score, by a logistic curve.

Fitting uses a bounded sample of labelled rows (``MAX_TOXIC`` and ``MAX_ORDINARY`` rows by hash of doc_id, whole
texts, in an order by hash, each that still fits into ``MAX_SAMPLE_BYTES`` of its kind; a text longer than that is not
learned from, but scored): one half trains the dictionaries, the other the cells and the curve.
Scoring compresses every distinct word of every whole text; a worker keeps the odds of words it has met.

Null and empty texts have no windows and get the score of such a document. Without labels of both kinds,
the score is the share of toxic labels (0 without any). Null labels and labels of a null doc_id are ignored, and
documents of a null doc_id are scored and never held out; a document with several
labels counts as toxic if one of them is. Repeated rows are scored one by one.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lorebank.llm.common import Words, blocks, buffers, table, text_of

MAX_TOXIC, MAX_ORDINARY, MAX_SAMPLE_BYTES = 1500, 3000, 12 << 20
DICTIONARY_BYTES = 4096
CUT = 0.3
#: Documents of the sample in which a toxic word occurs, and how many times likelier it is there.
LEAST_DOCS, LEAST_RATIO = 3, 8
MAX_WORDS = 2_000_000

_HEAD, _TAIL = bytes(range(1, 31)), bytes(range(200, 209))
_DISTANCES, _LENGTHS = 16, 32


class Model:
    """Everything that scoring needs; its size is fixed."""

    def __init__(self, ordinary: bytes, toxic: bytes, odds: np.ndarray, curve: np.ndarray, prior: float):
        self.ordinary, self.toxic, self.odds, self.curve, self.prior = ordinary, toxic, odds, curve, prior

    def compressors(self):
        import zstandard

        p = zstandard.ZstdCompressionParameters(
            window_log=14, hash_log=13, chain_log=13, search_log=4, min_match=3, target_length=64, strategy=zstandard.STRATEGY_LAZY2,
            write_content_size=False, write_checksum=False, write_dict_id=False,
        )
        out = []
        for content in (self.ordinary, self.ordinary + self.toxic):
            d = zstandard.ZstdCompressionDict(content + _HEAD, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(compression_params=p)
            out.append(zstandard.ZstdCompressor(dict_data=d, compression_params=p))
        return out

    def scores(self, features: np.ndarray) -> np.ndarray:
        if self.curve is None:
            return np.full(len(features), self.prior)
        return 1 / (1 + np.exp(-np.clip(_terms(features) @ self.curve, -30, 30)))


class Windows:
    """Compression distances of words; those met before are looked up by hash."""

    def __init__(self, model: Model):
        self.model, self.pair = model, model.compressors()
        self.hashes, self.cells = np.zeros(0, np.uint64), np.zeros(0, np.int32)

    def cells_of(self, words: list[bytes]) -> np.ndarray:
        if not words:
            return np.zeros(0, np.int32)
        inputs = [_HEAD + b" " + w + b" " + _TAIL for w in words]
        a, b = (np.array([len(x) for x in c.multi_compress_to_buffer(inputs, threads=0)]) for c in self.pair)
        return (np.clip(a - b, 0, _DISTANCES - 1) * _LENGTHS + np.clip(b - 16, 0, _LENGTHS - 1)).astype(np.int32)

    def block(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Text and cell of every distinct word of each text, and the number of words of each."""
        words = Words(data, offsets)
        key = (words.owner().astype(np.uint64) << np.uint64(44)) | (words.hash >> np.uint64(20))
        _, at = np.unique(key, return_index=True)
        hashes, text = words.hash[at], words.owner()[at]
        spot = np.minimum(np.searchsorted(self.hashes, hashes), max(0, len(self.hashes) - 1))
        known = self.hashes[spot] == hashes if len(self.hashes) else np.zeros(len(hashes), bool)
        new, first = np.unique(hashes[~known], return_index=True)
        if len(new):
            place = at[~known][first]
            cells = self.cells_of([words.low[a:b].tobytes() for a, b in zip(words.start[place].tolist(), words.end[place].tolist())])
            if len(self.hashes) > MAX_WORDS:
                self.hashes, self.cells = self.hashes[:0], self.cells[:0]
                fresh, place = np.unique(hashes, return_index=True)
                new = fresh
                cells = self.cells_of([words.low[words.start[at[i]] : words.end[at[i]]].tobytes() for i in place.tolist()])
            where = np.searchsorted(self.hashes, new)
            self.hashes, self.cells = np.insert(self.hashes, where, new), np.insert(self.cells, where, cells)
        cell = self.cells[np.searchsorted(self.hashes, hashes)] if len(hashes) else np.zeros(0, np.int32)
        return text, cell, np.diff(words.first)

    def features(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Of each text: its three highest log odds, and the logarithm of its length."""
        text, cell, n = self.block(data, offsets)
        odds = self.model.odds[cell]
        up = odds > 0
        text, odds = text[up], odds[up]
        order = np.lexsort((-odds, text))
        text, odds = text[order], odds[order]
        rank = np.arange(len(text)) - np.searchsorted(text, text)
        out = np.zeros((len(n), 4))
        for k in range(3):
            out[text[rank == k], k] = odds[rank == k]
        out[:, 3] = np.log1p(n)
        return out


def _terms(features: np.ndarray) -> np.ndarray:
    top, second, third, size = features.T
    return np.stack([np.ones(len(features)), top, second, third, size, size * top], axis=1)


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.5) -> np.ndarray:
    """Ridge-penalised maximum likelihood, by Newton steps that are halved until they help."""
    w, penalty = np.zeros(x.shape[1]), np.full(x.shape[1], ridge)
    penalty[0] = 1e-6

    def cost(w: np.ndarray) -> float:
        z = x @ w
        return float(np.logaddexp(0, z).sum() - (y * z).sum() + 0.5 * (penalty * w * w).sum())

    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (p - y) + penalty * w
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty), grad)
        scale = 1.0
        while scale > 1e-6 and cost(w - scale * step) > cost(w):
            scale /= 2
        w = w - scale * step
        if np.abs(scale * step).max() < 1e-8:
            break
    return w


def _dictionary(samples: list[bytes], size: int) -> bytes:
    import zstandard

    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:  # too few samples to train on: they are the dictionary
        return b"".join(dict.fromkeys(samples))[-size:]


def _words_of(texts: list[str]) -> list[list[bytes]]:
    w = Words(*buffers(pa.array(texts, pa.large_string())))
    flat = [w.low[a:b].tobytes() for a, b in zip(w.start.tolist(), w.end.tolist())]
    return [flat[a:b] for a, b in zip(w.first.tolist(), w.first[1:].tolist())]


def fit(sample: list[tuple[int, str, int]]) -> Model:
    """sample: doc_id, text, label; a bounded number of rows."""
    prior = sum(y for *_, y in sample) / len(sample) if sample else 0.0
    sample = sorted(sample)
    half = [zlib.crc32(b"half" + str(i).encode()) % 2 for i, *_ in sample]
    first = [(t, y) for (_, t, y), h in zip(sample, half) if h]
    own = list(zip(_words_of([t for t, _ in first]), (y for _, y in first)))
    n_toxic = sum(y for _, y in own)
    n_ordinary = len(own) - n_toxic
    if not n_toxic or not n_ordinary or not any(y for (*_, y), h in zip(sample, half) if not h):
        return Model(b"", b"", np.zeros(_DISTANCES * _LENGTHS), None, prior)
    in_toxic, in_ordinary = Counter(), Counter()
    for w, y in own:
        (in_toxic if y else in_ordinary).update(set(w))
    least = min(LEAST_DOCS, max(1, n_toxic // 4))
    telling = {w for w, c in in_toxic.items() if c >= least and c / n_toxic >= LEAST_RATIO * (in_ordinary[w] + 0.5) / (n_ordinary + 1)}
    runs = [b" " + b" ".join(w[i : i + 12]) + b" " for w, y in own if not y for i in range(0, len(w), 12)]
    runs = sorted(runs, key=zlib.crc32)[:20_000]
    marked = [b" " + x + b" " for w, y in own if y for x in w if x in telling]
    marked = [x for _, x in sorted((zlib.crc32(b"%d" % i), x) for i, x in enumerate(marked))]  # shuffled, always alike
    toxic = [b"".join(marked[i : i + 12]) for i in range(0, len(marked), 12)]
    model = Model(_dictionary(runs, DICTIONARY_BYTES), _dictionary(toxic, DICTIONARY_BYTES // 4) if toxic else b"", np.zeros(_DISTANCES * _LENGTHS), None, prior)
    rest = [(t, y) for (_, t, y), h in zip(sample, half) if not h]
    label = np.array([y for _, y in rest])
    windows = Windows(model)
    data, offsets = buffers(pa.array([t for t, _ in rest], pa.large_string()))
    text, cell, _ = windows.block(data, offsets)
    seen = [np.bincount(cell[label[text] == y], minlength=len(model.odds)) for y in (0, 1)]
    rate = [(s + 0.5 * (seen[0] + seen[1] + 1) / (seen[0] + seen[1] + 1).sum() * 50) / (s.sum() + 25) for s in seen]
    model.odds = np.log(rate[1] / rate[0])
    features = Windows(model).features(data, offsets)
    model.curve = _logistic(_terms(features), label)
    return model


def compared_bounds(sample: list[tuple[int, str, int]], bounds: tuple[int, ...], folds: int = 3) -> dict[int, float]:
    """For each bound of the bytes of a kind: area under the curve of labelled rows that were left out, mean over folds.

    This chose ``MAX_SAMPLE_BYTES``. ``sample``: rows that may be learned from, and no others."""
    fold = lambda i: zlib.crc32(b"fold%d" % i) % folds
    out = {}
    for bound in bounds:
        areas = []
        for f in range(folds):
            model = fit([r for y in (0, 1) for r in _fitting([r for r in sample if r[2] == y and fold(r[0]) != f], bound * (folds - 1) // folds)])
            rest = [r for r in sample if fold(r[0]) == f]
            score = model.scores(Windows(model).features(*buffers(pa.array([t for _, t, _ in rest], pa.large_string()))))
            label = np.array([y for *_, y in rest], bool)
            below = np.sort(score[~label])
            areas.append(((np.searchsorted(below, score[label], "left") + np.searchsorted(below, score[label], "right")) / 2 / len(below)).mean())
        out[bound] = float(np.mean(areas))
    return out


def _fitting(rows: list[tuple[int, str, int]], bound: int) -> list[tuple[int, str, int]]:
    """Rows in an order by hash of doc_id, each that still fits."""
    out, total = [], 0
    for r in sorted(rows, key=lambda r: (zlib.crc32(b"%d" % r[0]), r[0])):
        size = len(r[1].encode())
        if total + size <= bound:
            total += size
            out.append(r)
    return out


def labelled_texts(docs: DataFrame, labels: DataFrame) -> list[tuple[int, str, int]]:
    """The bounded sample of labelled rows that fitting uses."""
    marks = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("toxic").cast("int").alias("y")).dropna().groupBy("doc_id").agg(F.max("y").alias("y"))
    out: list[tuple[int, str, int]] = []
    order = F.xxhash64(F.lit(17), "doc_id")
    for y, limit in ((1, MAX_TOXIC), (0, MAX_ORDINARY)):
        ids = [r.doc_id for r in marks.filter(F.col("y") == y).orderBy(order, "doc_id").limit(limit).collect()]
        if ids:
            rows = docs.filter(F.col("doc_id").isin(ids)).select("doc_id", text_of("text").alias("text"))
            sizes = rows.groupBy("doc_id").agg(F.sum(F.octet_length("text")).alias("size")).collect()
            fits, total = [], 0
            for r in sorted(sizes, key=lambda r: (zlib.crc32(b"%d" % r.doc_id), r.doc_id)):
                if total + r.size <= MAX_SAMPLE_BYTES:
                    total += r.size
                    fits.append(r.doc_id)
            out += [(r.doc_id, r.text, y) for r in rows.filter(F.col("doc_id").isin(fits)).orderBy("doc_id").limit(limit).collect()]
    return out


def score_udf(model: Model, spark: SparkSession):
    shared = spark.sparkContext.broadcast(model)

    @F.arrow_udf(T.DoubleType())
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        windows = Windows(shared.value)
        for texts in batches:
            data, offsets = buffers(texts)
            out = np.zeros(len(texts))
            for a, b in blocks(offsets):
                out[a:b] = shared.value.scores(windows.features(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]))
            yield pa.array(out)

    return score


def scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: doc_id, score, predicted. Labels are learned from all rows of ``labels``."""
    model = fit(labelled_texts(docs, labels))
    out = docs.select("doc_id", score_udf(model, docs.sparkSession)(text_of("text")).alias("score"))
    return out.withColumn("predicted", (F.col("score") >= CUT).cast("int"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = lambda: F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    return scored(docs, labels.filter(~held_out())).select("doc_id", held_out().alias("held_out"), "score", "predicted")
