"""Language identification by words first, with back-off to character n-grams.

A known word adds its log frequency in each language. A word that the model has not seen is
scored by its longest character n-grams that the model knows: n-grams of one length are tried
after another, from long to short, and the mean over the known ones of the first length that has
any counts as the word's evidence.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import bounded_batches, mix, stored, texts

SIZES = (5, 4, 3, 2, 1)
BASE = 0x9E3779B97F4A7C15


class Letters:
    """Splits texts into lower-case words of letters and hashes words and n-grams."""

    def __init__(self):
        every = [chr(c) for c in range(0x110000)]
        self.alpha = np.array([c.isalpha() for c in every])
        lower = (c.lower() for c in every)
        self.lower = np.array([ord(x) if len(x) == 1 else k for k, x in enumerate(lower)], np.uint32)
        self.powers = np.ones(1, np.uint64)

    def chunk(self, rows: list[bytes]):
        """Word starts and ends, row bounds in words, and prefix sums for the hashes."""
        text = (b"\n" + b"\n".join(rows) + b"\n").decode("utf-8", "replace")
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        inside = self.alpha[codes]
        codes = np.where(inside, self.lower[codes], np.uint32(32))
        steps = np.diff(inside.astype(np.int8))
        starts, ends = np.flatnonzero(steps == 1) + 1, np.flatnonzero(steps == -1) + 1
        sizes = np.array([len(r.decode("utf-8", "replace")) for r in rows], np.int64)
        bounds = np.concatenate([[0], np.cumsum(sizes + 1)])
        if len(self.powers) <= len(codes):
            base = np.full(len(codes) + 1, BASE, np.uint64)
            back = np.full(len(codes) + 1, pow(BASE, -1, 1 << 64), np.uint64)
            base[0] = back[0] = 1
            self.powers, self.inverses = np.cumprod(base), np.cumprod(back)
        self.sums = np.zeros(len(codes) + 1, np.uint64)
        np.cumsum(mix(codes + np.uint64(1)) * self.powers[: len(codes)], out=self.sums[1:])
        return starts, ends, np.searchsorted(starts, bounds + 1)

    def hashes(self, starts: np.ndarray, ends: np.ndarray, level: int) -> np.ndarray:
        raw = (self.sums[ends] - self.sums[starts]) * self.inverses[starts]
        return mix(raw + (ends - starts).astype(np.uint64) + (np.uint64(level) << np.uint64(56)))

    def grams(self, starts: np.ndarray, ends: np.ndarray, size: int):
        """(word, hash) of every n-gram; those of two letters and more see the word's edges."""
        edge = int(size > 1)
        many = np.maximum(ends - starts + 2 * edge - size + 1, 0)
        word = np.repeat(np.arange(len(starts)), many)
        last = np.cumsum(many)
        at = np.repeat(starts - edge, many) + np.arange(len(word)) - np.repeat(last - many, many)
        return word, self.hashes(at, at + size, size)


def _pieces(column: pa.Array, size: int = 1 << 20) -> Iterator[list[bytes]]:
    held, total = [], 0
    for text in texts(column):
        if held and total + len(text) > size:
            yield held
            held, total = [], 0
        held.append(text)
        total += len(text)
    if held:
        yield held


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(language, level, hash, count); level 0 is words, others the n-grams of distinct words."""
    letters = Letters()
    for batch in batches:
        langs = np.array(batch.column(1).to_pylist(), object)
        for lang in sorted(set(langs)):
            own = batch.column(0).filter(pa.array(langs == lang))
            for rows in _pieces(own):
                starts, ends, _ = letters.chunk(rows)
                words, at, seen = np.unique(
                    letters.hashes(starts, ends, 0), return_index=True, return_counts=True
                )
                yield _counted(lang, 0, words, seen)
                for size in SIZES:
                    _, found = letters.grams(starts[at], ends[at], size)
                    yield _counted(lang, size, *np.unique(found, return_counts=True))


def _counted(lang, level, hashes, seen) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            pa.array([lang] * len(hashes), pa.string()),
            pa.array(np.full(len(hashes), level, np.int32)),
            pa.array(hashes.view(np.int64)),
            pa.array(seen.astype(np.int64)),
        ],
        names=["lang", "level", "hash", "seen"],
    )


def learn_languages(
    labelled: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    max_rows: int = 20_000,
    max_terms: int = 200_000,
) -> dict:
    """Log frequencies of words and n-grams per language.

    Fitted on at most about ``max_rows`` rows with a language, picked by a hash of their text; the
    model keeps the most frequent words and n-grams that occur twice or more, as many counts as
    fit into ``max_terms`` terms, which bounds what is sent to executors. Without labelled rows the model knows no language.
    """
    rows = labelled.filter(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    total = rows.count()
    if total > max_rows:
        share = int(2**31 * (max_rows / total))
        rows = rows.filter(F.pmod(F.xxhash64(F.col(text_col)), F.lit(2**31)) < share)
    bounded_batches(labelled.sparkSession)
    counted = rows.select(F.col(text_col), F.col(lang_col)).mapInArrow(
        _counts, "lang string, level int, hash long, seen long"
    )
    terms = stored(
        counted.groupBy("level", "hash", "lang")
        .agg(F.sum("seen").alias("seen"))
        .groupBy("level", "hash")
        .agg(F.sum("seen").alias("total"), F.map_from_entries(F.collect_list(F.struct("lang", "seen"))).alias("by"))
        .filter("total > 1"),
        "language-terms",
    )
    langs = sorted(r[0] for r in terms.select(F.explode(F.map_keys("by"))).distinct().collect())
    if not langs:
        return {"langs": [], "levels": {}}
    steps = terms.groupBy(F.least("total", F.lit(1000)).alias("total")).count().collect()
    least, kept = 1001, 0
    for total, n in sorted(steps, reverse=True):
        kept += n
        if kept > max_terms:
            break
        least = total
    seen = (F.coalesce(F.col("by")[lang], F.lit(0)).alias(f"n{k}") for k, lang in enumerate(langs))
    found = terms.filter(F.col("total") >= least).select("level", "hash", *seen).toArrow()
    model = {"langs": langs, "levels": {}}
    level, keys = found["level"].to_numpy(), found["hash"].to_numpy().view(np.uint64)
    counts = np.array([found[f"n{k}"].to_numpy() for k in range(len(langs))], float).reshape(len(langs), -1).T
    for one in np.unique(level).tolist():
        own = np.flatnonzero(level == one)
        own = own[np.argsort(keys[own])]
        logs = np.log((counts[own] + 0.5) / (counts[own].sum(axis=0) + 0.5 * len(own)))
        model["levels"][one] = keys[own], logs
    return model


def _known(level, hashes: np.ndarray):
    """(found, place in the table) of hashes in one level of the model."""
    if level is None:
        return np.zeros(len(hashes), bool), np.zeros(len(hashes), np.int64)
    at = np.minimum(np.searchsorted(level[0], hashes), len(level[0]) - 1)
    return level[0][at] == hashes, at


def score_words(letters: Letters, model: dict, starts, ends) -> np.ndarray:
    """The evidence of each word for each language; zero where nothing of it is known."""
    levels = model["levels"]
    out = np.zeros((len(starts), len(model["langs"])))
    found, at = _known(levels.get(0), letters.hashes(starts, ends, 0))
    if found.any():
        out[found] = levels[0][1][at[found]]
    rest = np.flatnonzero(~found)
    for size in SIZES:
        if not len(rest) or size not in levels:
            continue
        word, hashes = letters.grams(starts[rest], ends[rest], size)
        found, at = _known(levels[size], hashes)
        word, at = word[found], at[found]
        many = np.bincount(word, minlength=len(rest))
        done = many > 0
        for k in range(out.shape[1]):
            sums = np.bincount(word, levels[size][1][at, k], len(rest))
            out[rest[done], k] = sums[done] / many[done]
        rest = rest[~done]
    return out


def _predict(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = model.value
        letters = known.setdefault("letters", None) or Letters()
        known["letters"] = letters
        langs = known["langs"]
        for batch in batches:
            names, scores = [], []
            for rows in _pieces(batch.column(0)):
                starts, ends, bounds = letters.chunk(rows)
                words = score_words(letters, known, starts, ends)
                sums = np.zeros((len(words) + 1, max(len(langs), 1)))
                np.cumsum(words, axis=0, out=sums[1:, : len(langs)])
                total = sums[bounds[1:]] - sums[bounds[:-1]]
                for own, many in zip(total, np.diff(bounds)):
                    if not many or not langs:
                        names.append("und")
                        scores.append(0.0)
                        continue
                    odds = np.exp(own - own.max())
                    names.append(langs[int(own.argmax())])
                    scores.append(float(odds.max() / odds.sum()))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                names=[*batch.schema.names, "lang_pred", "score"],
            )

    return run


def identify_languages(docs: DataFrame, model: dict, text_col: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` (0 to 1) added, replacing columns of these names.

    A text that is null or has no letter is ``und`` with score 0; so is every text under a model
    without languages. Ties go to the first language by name. The model never sees any column but
    the text. Repeated rows stay; an empty table stays empty.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    kept = [c for c in docs.columns if c not in ("lang_pred", "score")]
    rows = docs.select(F.col(text_col).alias("__li_text"), *(f"`{c}`" for c in kept))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    sent = spark.sparkContext.broadcast(model)
    return rows.mapInArrow(_predict(sent), f"{schema}, lang_pred string, score double").drop("__li_text")
