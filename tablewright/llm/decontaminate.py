"""Exact phrase and proximity matches of benchmark texts in a corpus, by positional postings.

The test items are a stated query set: their windows go out in blocks of bounded size. One pass
counts how often each test term occurs in the whole corpus. In the second, every task builds the
positional postings of the test terms over its own documents, takes for each window the postings
of its rarest term, moved by the term's offset, as possible places, and intersects them with the
equally moved postings of the next rarer terms. Documents are never shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import WordHasher, bounded_batches, chunks, stored

BLOCK_WINDOWS = 200_000


def word_bytes() -> np.ndarray:
    """Digits, ASCII letters and everything beyond ASCII."""
    table = np.zeros(256, bool)
    table[0x30:0x3A] = table[0x41:0x5B] = table[0x61:0x7B] = True
    table[0x80:] = True
    return table


class Block:
    """The distinct windows of some items: terms, items that have them, terms by rarity."""

    def __init__(self, windows: dict[tuple[int, ...], set[str]]):
        self.terms = np.unique(np.array([t for w in windows for t in w], np.uint64))
        self.by_size: list[tuple[np.ndarray, list[list[str]]]] = []
        for size in sorted({len(w) for w in windows}):
            own = sorted(w for w in windows if len(w) == size)
            ids = np.searchsorted(self.terms, np.array(own, np.uint64).reshape(-1, size))
            self.by_size.append((ids, [sorted(windows[w]) for w in own]))
        self.plans: list[tuple] = []

    def order(self, seen: np.ndarray) -> None:
        """Per window the places from its rarest term on; windows with an unseen term go."""
        for ids, items in self.by_size:
            counts = seen[ids]
            alive = np.flatnonzero(counts.min(axis=1) > 0)
            if not len(alive):
                continue
            ids, counts = ids[alive], counts[alive]
            places = np.argsort(counts, axis=1, kind="stable")
            first = np.take_along_axis(ids, places[:, :1], 1)[:, 0]
            by_first = np.argsort(first, kind="stable")
            ids, places, first = ids[by_first], places[by_first], first[by_first]
            starts = np.searchsorted(first, np.arange(len(self.terms) + 1))
            self.plans.append((ids, places, starts, [items[alive[k]] for k in by_first]))


def _postings(terms: np.ndarray, words: np.ndarray) -> np.ndarray:
    """The term number at every word place, -1 for words that are no test term."""
    at = np.minimum(np.searchsorted(terms, words), len(terms) - 1)
    return np.where(terms[at] == words, at, -1)


def _matches(plan, found: np.ndarray, rows: np.ndarray, slack: int):
    """(window, first place) of every match in a chunk; ``rows`` bound the documents' places."""
    ids, places, starts, _ = plan
    size = ids.shape[1]
    posts = np.flatnonzero(found >= 0)
    lists = starts[found[posts] + 1] - starts[found[posts]]
    posts, lists = posts[lists > 0], lists[lists > 0]
    # every window of the term at a place, side by side
    window = np.repeat(starts[found[posts]], lists) + _ranks(lists)
    start = np.repeat(posts, lists) - places[window, 0]
    doc = np.searchsorted(rows, np.repeat(posts, lists), "right") - 1
    low, high = rows[doc], rows[doc + 1]
    keep = (start >= low) & (start + size <= high)
    window, start, low, high = window[keep], start[keep], low[keep], high[keep]
    for k in range(1, size):
        if not len(window):
            break
        place = places[window, k]
        wanted, at = ids[window, place], start + place
        keep = found[at] == wanted
        for move in (m for d in range(1, slack + 1) for m in (-d, d)):
            moved = at + move
            inside = (moved >= low) & (moved < high)
            keep |= inside & (found[np.where(inside, moved, at)] == wanted)
        window, start, low, high = window[keep], start[keep], low[keep], high[keep]
    return window, start


def _ranks(lists: np.ndarray) -> np.ndarray:
    """0, 1, ... within each run of the given lengths."""
    ends = np.cumsum(lists)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - lists, lists)


def _count(sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, hasher = sent.value, WordHasher(word_bytes())
        seen = np.zeros(len(terms), np.int64)
        for batch in batches:
            for _, _, data, offsets in chunks(batch.column(0)):
                words, _ = hasher(data, offsets)
                found = _postings(terms, words)
                seen += np.bincount(found[found >= 0], minlength=len(seen))
        some = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(seen[some])], names=["term", "seen"])

    return run


def _search(sent, slack: int):
    """Add to each row the words hit, the items found and the hit stretches of one block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (terms, plans), hasher = sent.value, WordHasher(word_bytes())
        for batch in batches:
            own = batch.num_columns - len(ADDED)
            counts, hits, items, spans = [], [], [], []
            for first, stop, data, offsets in chunks(batch.column(own - 1)):
                words, rows = hasher(data, offsets)
                edges = np.zeros(len(words) + 1, np.int64)
                known: dict[int, set[str]] = {}
                for d in range(stop - first):  # what earlier blocks have found
                    for span in batch.column(own + 3)[first + d].as_py() or ():
                        edges[rows[d] + span["start"]] += 1
                        edges[rows[d] + span["end"]] -= 1
                        known.setdefault(d, set(batch.column(own + 2)[first + d].as_py()))
                found = _postings(terms, words) if plans else None
                for plan in plans:
                    window, start = _matches(plan, found, rows, slack)
                    np.add.at(edges, start, 1)
                    np.add.at(edges, start + plan[0].shape[1], -1)
                    doc = np.searchsorted(rows, start, "right") - 1
                    for w, d in set(zip(window.tolist(), doc.tolist())):
                        known.setdefault(d, set()).update(plan[3][w])
                hit = np.cumsum(edges[:-1]) > 0
                total = np.concatenate([[0], np.cumsum(hit)])
                counts += np.diff(rows).tolist()
                hits += (total[rows[1:]] - total[rows[:-1]]).tolist()
                for d, (a, b) in enumerate(zip(rows[:-1].tolist(), rows[1:].tolist())):
                    items.append(sorted(known.get(d, ())))
                    spans.append(_stretches(hit[a:b]) if d in known else [])
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[:own],
                    pa.array(counts, pa.int64()),
                    pa.array(hits, pa.int64()),
                    pa.array(items, pa.list_(pa.string())),
                    pa.array(spans, pa.list_(SPAN)),
                ],
                names=batch.schema.names,
            )

    return run


ADDED = {
    "n_words": "long",
    "n_hit": "long",
    "items": "array<string>",
    "spans": "array<struct<start:int,end:int>>",
}
SPAN = pa.struct([("start", pa.int32()), ("end", pa.int32())])


def _stretches(hit: np.ndarray) -> list[dict]:
    steps = np.flatnonzero(np.diff(np.concatenate([[0], hit.astype(np.int8), [0]])))
    return [{"start": int(a), "end": int(b)} for a, b in zip(steps[::2], steps[1::2])]


def blocks(benchmark: DataFrame, item_col: str, text_col: str, window: int, most: int) -> Iterator[Block]:
    """The benchmark's windows in blocks of about ``most``, read one partition at a time."""
    hasher, held = WordHasher(word_bytes()), {}
    items = benchmark.select(F.col(item_col).cast("string"), F.col(text_col).cast("string"))
    for item, text in items.filter(F.col(text_col).isNotNull()).toLocalIterator():
        for _, _, data, offsets in chunks(pa.array([text])):
            words = hasher(data, offsets)[0].tolist()
            for k in range(max(len(words) - window + 1, 1) if words else 0):
                held.setdefault(tuple(words[k : k + window]), set()).add(item or "")
        if len(held) >= most:
            yield Block(held)
            held = {}
    if held:
        yield Block(held)


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = 10,
    slack: int = 0,
    block: int = BLOCK_WINDOWS,
) -> DataFrame:
    """``docs`` with ``n_words``, ``n_hit``, ``items`` and ``spans`` added.

    Words are runs of digits, letters and non-ASCII characters, A-Z lower-cased. A window is
    ``window`` neighbouring words of an item, or all words of a shorter one. A document word in
    an occurrence of a window is hit; ``items`` are the ids (as sorted strings) of items with
    occurring windows, ``spans`` the hit stretches in words. With ``slack`` every word of a
    window but its rarest may stand up to that many words from its place (a proximity match; the
    stretch of the plain window counts as hit). Null texts and items have no words and no
    windows; an empty benchmark gives no hits. Columns of these names are replaced, repeated rows
    stay. Words are compared by 64-bit hashes. Each block of the benchmark is a pass of its own;
    between passes the rows lie in the shared folder.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    kept = [c for c in docs.columns if c not in ADDED]
    none = (F.lit(None).cast(kind).alias(name) for name, kind in ADDED.items())
    rows = docs.select(*(f"`{c}`" for c in kept), F.col(f"`{text_col}`").alias("__dc_text"), *none)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    passes = 0
    for part in blocks(benchmark, item_col, item_text_col, window, block):
        terms = spark.sparkContext.broadcast(part.terms)
        counted = docs.select(text_col).mapInArrow(_count(terms), "term long, seen long")
        seen = np.zeros(len(part.terms), np.int64)
        for term, n in counted.groupBy("term").agg(F.sum("seen")).collect():
            seen[term] = n
        part.order(seen)
        sent = spark.sparkContext.broadcast((part.terms, part.plans))
        rows = (stored(rows, "contamination") if passes else rows).mapInArrow(_search(sent, slack), schema)
        passes += 1
    if not passes:
        nothing = spark.sparkContext.broadcast((np.zeros(0, np.uint64), []))
        rows = rows.mapInArrow(_search(nothing, slack), schema)
    return rows.drop("__dc_text")
