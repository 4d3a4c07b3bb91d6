"""A quality classifier on learned subword embeddings.

Words and their character n-grams are hashed to buckets, each with a learned vector; a document is
the mean of its vectors, put through a softmax over the two labels. Trained by stochastic gradient
descent in numpy on a bounded sample of labelled rows. For scoring, the difference of the two
label scores is linear in the mean, so one number per bucket goes to the executors.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import WordHasher, ascii_space, bounded_batches, chunks, mix

BUCKETS = 1 << 17
REPEATED_WORD, REPEATED_LINE = 0, 1  # the buckets of two words made up for repetitions


class Features:
    """Bucket numbers of every word, n-gram and repetition of a text."""

    def __init__(self, sizes: tuple[int, ...] = (2, 3, 4)):
        self.sizes, self.space = sizes, ascii_space()
        self.words = WordHasher(~self.space)
        self.words.codes = mix(np.arange(256, dtype=np.uint64) + np.uint64(77))  # case matters here
        line = np.ones(256, bool)
        line[10] = False
        self.lines = WordHasher(line)

    def __call__(self, data: np.ndarray, offsets: np.ndarray) -> Iterator[np.ndarray]:
        words, rows = self.words(data, offsets)
        lines, line_rows = self.lines(data, offsets)
        grams, places = self._grams(data, offsets)
        bounds = [np.searchsorted(p, offsets) for p in places]
        for k in range(len(offsets) - 1):
            own = words[rows[k] : rows[k + 1]]
            found = lines[line_rows[k] : line_rows[k + 1]]
            again = len(found) - len(np.unique(found))
            share = again * len(own) // max(len(found), 1)
            same = int((own[1:] == own[:-1]).sum())
            parts = [_bucket(own), *(g[b[k] : b[k + 1]] for g, b in zip(grams, bounds))]
            yield np.concatenate(
                [*parts, np.full(same, REPEATED_WORD, np.int32), np.full(share, REPEATED_LINE, np.int32)]
            )

    def _grams(self, data: np.ndarray, offsets: np.ndarray):
        """For every size the buckets of n-grams with white space at their ends only, and places."""
        blank = self.space[data]
        inner = offsets[1:-1]
        grams, places = [], []
        for size in self.sizes:
            many = len(data) - size + 1
            if many <= 0:
                grams.append(np.zeros(0, np.int32))
                places.append(np.zeros(0, np.int64))
                continue
            keep = ~(blank[:many] & blank[size - 1 :]) if size > 1 else ~blank
            for k in range(1, size - 1):
                keep &= ~blank[k : k + many]
            for cut in range(1, size):  # none that reaches into the next text
                keep[inner[(inner >= cut) & (inner - cut < many)] - cut] = False
            code = np.full(many, size, np.uint32)
            for k in range(size):
                code = code * np.uint32(0x01000193) + data[k : k + many] * np.uint32(0x9E3779B1)
            at = np.flatnonzero(keep)
            grams.append(_bucket(mix(code[at].astype(np.uint64))))
            places.append(at)
        return grams, places


def _bucket(hashes: np.ndarray) -> np.ndarray:
    return (hashes % np.uint64(BUCKETS - 2)).astype(np.int32) + 2


def _bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(label, bucket numbers, their shares) of every text that has any feature."""
    features = Features()
    for batch in batches:
        labels, bags, shares = [], [], []
        for first, _, data, offsets in chunks(batch.column(0)):
            for k, found in enumerate(features(data, offsets)):
                if len(found):
                    bucket, seen = np.unique(found, return_counts=True)
                    labels.append(batch.column(1)[first + k].as_py())
                    bags.append(bucket.astype(np.int32).tobytes())
                    shares.append((seen / len(found)).astype(np.float32).tobytes())
        yield pa.RecordBatch.from_arrays(
            [pa.array(labels, pa.int32()), pa.array(bags, pa.binary()), pa.array(shares, pa.binary())],
            names=["label", "bag", "share"],
        )


def train_quality(
    docs: DataFrame,
    labels: DataFrame,
    text_col: str = "text",
    label_col: str = "quality",
    id_col: str = "doc_id",
    max_rows: int = 3_000,
    width: int = 16,
    rounds: int = 6,
    rate: float = 2.0,
    seed: int = 7,
) -> dict:
    """The score of every bucket and the bias, fitted on at most ``max_rows`` labelled ids.

    The ids are picked by a hash, the same every time. They are few enough to broadcast, so no
    text is shuffled. Rows without a text or a label of 0 or 1 do not count; an id with several
    labels counts with each. Without rows, or with one label only, scores follow the labels' share.
    """
    bounded_batches(docs.sparkSession)
    wanted = labels.filter(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull())
    wanted = wanted.select(id_col, F.col(label_col).cast("int").alias("__qc_label"))
    picked = wanted.orderBy(F.xxhash64(id_col), id_col, "__qc_label").limit(max_rows)
    rows = docs.select(id_col, text_col).filter(F.col(text_col).isNotNull())
    rows = rows.join(F.broadcast(picked), id_col).select(text_col, "__qc_label")
    bags = rows.mapInArrow(_bags, "label int, bag binary, share binary")
    sample = sorted((int(r["label"]), bytes(r["bag"]), bytes(r["share"])) for r in bags.toLocalIterator())
    sample = [(label, np.frombuffer(b, np.int32), np.frombuffer(s, np.float32)) for label, b, s in sample]
    return fit(sample, width, rounds, rate, seed)


def fit(sample, width: int, rounds: int, rate: float, seed: int) -> dict:
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / width, 1 / width, (BUCKETS, width)).astype(np.float32)
    weights = np.zeros((2, width), np.float32)
    ones = sum(label for label, _, _ in sample)
    bias = np.log(np.array([len(sample) - ones + 1, ones + 1], np.float32) / (len(sample) + 2))
    steps = max(rounds * len(sample), 1)
    for step in range(rounds * len(sample)):
        if step % len(sample) == 0:
            order = rng.permutation(len(sample))
        label, bag, share = sample[order[step % len(sample)]]
        own = vectors[bag]
        hidden = share @ own
        odds = np.exp(weights @ hidden + bias)
        slope = odds / odds.sum()
        slope[label] -= 1
        now = rate * (1 - step / steps)
        vectors[bag] = own - now * np.outer(share, slope @ weights)
        weights -= now * np.outer(slope, hidden)
        bias -= 0.1 * now * slope
    return {"scores": (vectors @ (weights[1] - weights[0])).astype(np.float32), "bias": float(bias[1] - bias[0])}


def _score(sent, place: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, features = sent.value, Features()
        for batch in batches:
            out = []
            for _, _, data, offsets in chunks(batch.column(place)):
                for found in features(data, offsets):
                    odds = model["bias"] + (float(model["scores"][found].mean(dtype=np.float64)) if len(found) else 0.0)
                    out.append(float(1 / (1 + np.exp(-odds))))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(out, pa.float64())], names=[*batch.schema.names, "score"]
            )

    return run


def score_quality(docs: DataFrame, model: dict, text_col: str = "text") -> DataFrame:
    """``docs`` with ``score`` added: the model's probability (0 to 1) of label 1.

    Null and empty texts get the score of the bias alone. The model sees the text only. A column
    ``score`` is replaced; repeated rows stay; an empty table stays empty.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    kept = [c for c in docs.columns if c != "score"]
    rows = docs.select(F.col(text_col).alias("__qc_text"), *(f"`{c}`" for c in kept))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    sent = spark.sparkContext.broadcast(model)
    return rows.mapInArrow(_score(sent, 0), f"{schema}, score double").drop("__qc_text")
