"""Language-model scores from a probabilistic suffix tree, and smoothed word frequencies.

A text is the bytes of its lower-cased words with one space between and an end sign. Contexts are
the up to five bytes before a byte. A context is kept when it was seen a fixed number of times and
its next bytes are distributed differently from those of its own suffix (the divergence, weighted by
the context's count, exceeds a cut), so more text gives more contexts. A kept context's distribution
is smoothed with its suffix's. Spark tests the contexts of each length by a join with the next
shorter one. What is sent out has a bound that no corpus exceeds, as no more than 1 / share contexts
or runs can have that share of all places: the tree's frequent contexts, as an automaton (the state
after each byte is the longest kept suffix of what has been read), and the values of frequent runs.
Places that neither settles are joined with the whole tree.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablewright.llm.common import bounded_batches, stored, texts

DEPTH = 5
START = b"\t\t\t\t\n"  # no byte of it can be in a word
END = b"\n"
LEAST_COUNT = 32  # of a context, at any size of the corpus
CONTEXT_SHARE = 4e-5  # of all places, for a context that is sent to executors
RUN_SHARE = 2.5e-7  # of all places, for a run of six bytes that is sent to executors
SMOOTH = 8.0  # counts that a suffix's distribution is worth
LANE = 512
HEAD_SHARE = 2e-6  # of all tokens, for a word that is sent to executors
HELD_BYTES, WORD_BYTES = 24 << 20, 120  # of counted words in a worker; what a word takes besides its letters
HELD_PLACES, SENT = 8_000_000, 200_000  # runs in a worker before they are counted, and those that it gives out at a time
HASH, EMPTY = np.uint64(0x9E3779B97F4A7C15), np.int64(-1)  # of a table of runs


def stream(rows: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, place after each text): every text behind a start that its context can see."""
    parts = [START + b" ".join(words) + END for words in rows]
    data = np.frombuffer(b"".join(parts), np.uint8)
    return data, np.cumsum([len(p) for p in parts])


def scored_places(data: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """True for every byte that belongs to a text or its end."""
    begins = np.concatenate([[0], ends[:-1]]).astype(np.int64)
    marks = np.ones(len(data), bool)
    for k in range(len(START)):
        marks[begins + k] = False
    return marks


def _codes(data: np.ndarray, at: np.ndarray | slice = slice(None)) -> np.ndarray:
    """The runs of a byte with the five before it, as numbers, that begin at places ``at``."""
    padded = np.concatenate([data, np.zeros(2, np.uint8)])
    every = np.ndarray(max(len(data) - DEPTH, 0), ">u8", padded, strides=(1,))
    return every[at].astype(np.uint64) >> np.uint64(16)


def _last(size: int, column: str = "code") -> Column:
    """The last ``size`` bytes of a run."""
    return F.col(column).bitwiseAND(F.lit((1 << 8 * size) - 1))


def _gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of words and of byte runs, combined within the task as far as memory allows.

    A worker holds HELD_BYTES of words, however long, and HELD_PLACES runs, which are sorted where they stand.
    """
    words: Counter = Counter()
    word_bytes, held, size = 0, [], 0
    codes, many = np.empty(HELD_PLACES, np.uint64), 0

    def runs() -> Iterator[pa.RecordBatch]:
        nonlocal many
        if not many:
            return
        own = codes[:many]
        own.sort()
        new = np.ones(many, bool)
        np.not_equal(own[1:], own[:-1], out=new[1:])
        first = np.flatnonzero(new)
        seen, own = np.diff(first, append=many), own[first]
        many = 0
        for k in range(0, len(own), SENT):
            yield _counted(None, own[k : k + SENT], seen[k : k + SENT])

    def place() -> Iterator[pa.RecordBatch]:
        nonlocal held, size, many
        data, ends = stream(held)
        code = _codes(data)[scored_places(data, ends)[DEPTH:]]
        held, size = [], 0
        while len(code):
            part, code = code[: HELD_PLACES - many], code[HELD_PLACES - many :]
            codes[many : many + len(part)] = part
            many += len(part)
            if many == HELD_PLACES:
                yield from runs()

    for batch in batches:
        for text in texts(batch.column(0)):
            own = text.lower().split()
            for word, n in Counter(own).items():
                if word not in words:
                    word_bytes += WORD_BYTES + len(word)
                words[word] += n
            words[END] += 1
            held.append(own)
            size += len(text)
            if size > 1 << 20:
                yield from place()
            if word_bytes > HELD_BYTES:
                yield _counted(list(words), None, list(words.values()))
                words.clear()
                word_bytes = 0
    if held:
        yield from place()
    yield from runs()
    yield _counted(list(words), None, list(words.values()))


def _counted(words, codes, seen) -> pa.RecordBatch:
    word = pa.nulls(len(seen), pa.binary()) if words is None else pa.array(words, pa.binary())
    code = pa.nulls(len(seen), pa.int64()) if codes is None else pa.array(codes.view(np.int64))
    return pa.RecordBatch.from_arrays([word, code, pa.array(seen, pa.int64())], names=["word", "code", "seen"])


class Frequencies:
    """Word counts of the training texts, and the tree learnt from them."""

    def __init__(self, training: DataFrame, text_col: str = "text"):
        spark = training.sparkSession
        bounded_batches(spark)
        partial = training.select(text_col).mapInArrow(_gather, "word binary, code long, seen long")
        # read once, so what the tasks have counted goes to the shuffle without being written before
        counts = stored(partial.groupBy("word", "code").agg(F.sum("seen").alias("c")), "suffix-counts")
        self.words = counts.filter("word IS NOT NULL").select("word", "c")
        total = self.words.agg(F.sum("c"), F.count(F.lit(1))).first()
        self.tokens, self.distinct = total[0] or 0, total[1]
        self.places = counts.filter("code IS NOT NULL").select("code", "c")
        self.total = self.places.agg(F.sum("c")).first()[0] or 0
        # (code, c) of every run of a context and a byte, by the context's length: each from the next longer
        self.runs = {DEPTH: self.places}
        for length in range(DEPTH - 1, -1, -1):
            shorter = self.runs[length + 1].groupBy(_last(length + 1).alias("code")).agg(F.sum("c").alias("c"))
            self.runs[length] = stored(shorter, "suffix-runs")

    def log_share(self, count) -> float:
        return math.log10((count + 0.1) / (self.tokens + 0.1 * (self.distinct + 1)))

    def head(self) -> dict[bytes, float]:
        """Log shares of the words above ``HEAD_SHARE``: 1 / HEAD_SHARE words at the most."""
        rows = self.words.filter(F.col("c") >= max(1.0, HEAD_SHARE * self.tokens)).toLocalIterator()
        return {bytes(word): self.log_share(c) for word, c in rows}

    def levels(self) -> list[DataFrame]:
        """(code, c, n, p) of every run by the length of its context.

        ``p`` is the byte's share after the longest kept suffix of the context, and ``n`` the
        context's count where the context itself is kept. A group is one context's next bytes.
        """
        every = self.places.sparkSession.range(256).select(F.col("id").alias("code"))
        root = every.join(self.runs[0], "code", "left").select("code", F.coalesce("c", F.lit(0)).alias("c"))
        share = (F.col("c") + F.lit(0.5)) / F.lit(self.total + 128.0)
        levels = [stored(root.select("code", "c", F.lit(None).cast("long").alias("n"), share.alias("p")), "suffix-level")]
        own = Window.partitionBy(F.shiftright("code", 8))
        for length in range(1, DEPTH + 1):
            below = levels[-1].select(F.col("code").alias("tail"), F.col("p").alias("below"))
            rows = self.runs[length].withColumn("tail", _last(length)).join(below, "tail")
            n = F.sum("c").over(own)
            apart = F.sum(F.col("c") * F.log(F.col("c") / F.col("below"))).over(own) - n * F.log(n.cast("double"))
            kept = (n >= LEAST_COUNT) & (apart >= F.lit(least_apart(self.total)))
            rows = rows.select("code", "c", "below", F.when(kept, n).alias("n"))
            smooth = (F.col("c") + SMOOTH * F.col("below")) / (F.col("n") + SMOOTH)
            levels.append(stored(rows.select("code", "c", "n", F.coalesce(smooth, "below").alias("p")), "suffix-level"))
        return levels

    def frequent_runs(self, levels: list[DataFrame]) -> tuple[np.ndarray, np.ndarray]:
        """A table of the codes and log10 shares of the runs above ``RUN_SHARE``: 1 / RUN_SHARE runs at the most."""
        often = levels[-1].filter(F.col("c") >= max(1.0, RUN_SHARE * self.total))
        got = often.select("code", F.log10("p").cast("float").alias("log")).toArrow()
        return run_table(got["code"].to_numpy(), got["log"].to_numpy())

    def tree(self) -> dict:
        """The automaton of the contexts above ``CONTEXT_SHARE``."""
        least = max(LEAST_COUNT, CONTEXT_SHARE * self.total)

        def level(length: int) -> np.ndarray:
            grams = self.runs[length]
            often = grams.groupBy(F.shiftright("code", 8).alias("context")).agg(F.sum("c").alias("n"))
            if length:
                often = often.filter(F.col("n") >= least)
            rows = grams.withColumn("context", F.shiftright("code", 8)).join(often, "context")
            got = rows.select("context", (F.col("code").bitwiseAND(F.lit(255))).alias("next"), "c").toArrow()
            got = got.sort_by([("context", "ascending"), ("next", "ascending")])
            return np.stack([got[name].to_numpy() for name in ("context", "next", "c")], axis=1)

        return automaton(map(level, range(DEPTH + 1)), self.total)


def run_values(levels: list[DataFrame], codes: DataFrame) -> DataFrame:
    """(code, p) of distinct runs, also of such as training has not seen.

    Longer runs are joined with the values of their tails; a tail has at most 256 of them.
    """
    values = levels[0].select("code", "p")
    for length in range(1, DEPTH + 1):
        context = F.shiftright("code", 8)
        kept = levels[length].filter("n IS NOT NULL").groupBy(context.alias("context")).agg(F.max("n").alias("n"))
        seen = levels[length].select("code", F.col("p").alias("own"))
        tails = values.select(F.col("code").alias("tail"), F.col("p").alias("below"))
        rows = codes.select(_last(length + 1).alias("code")).distinct().join(seen, "code", "left")
        rows = rows.withColumns({"context": context, "tail": _last(length)})
        rows = rows.join(kept, "context", "left").join(tails, "tail")
        smooth = SMOOTH * F.col("below") / (F.col("n") + SMOOTH)
        values = rows.select("code", F.coalesce("own", smooth, "below").alias("p"))
    return values


def least_apart(total: int) -> float:
    """The weighted divergence from which a context is kept."""
    return 2.0 * math.log(total + 2)


def automaton(levels: Iterator[np.ndarray], total: int) -> dict:
    """States, their log10 distributions and transitions from (context, next byte, count) rows.

    Levels are taken one by one; the first has every byte that any has. Contexts of full length have the
    last states, from ``deep`` on, whether kept or not.
    """
    rows = next(levels)
    alphabet = np.unique(np.concatenate([rows[:, 1], np.frombuffer(START, np.uint8)]))
    place = np.zeros(256, np.int64)
    place[alphabet] = np.arange(1, len(alphabet) + 1)
    width = len(alphabet) + 1  # column 0 stands for any one byte that training has not seen
    root = np.full(width, 0.5)
    np.add.at(root, place[rows[:, 1]], rows[:, 2])
    shares = {b"": root / (total + 128.0)}
    cut = least_apart(total)
    for length, rows in enumerate(levels, 1):
        contexts, first = np.unique(rows[:, 0], return_index=True)
        for context, a, b in zip(contexts.tolist(), first.tolist(), [*first[1:].tolist(), len(rows)]):
            name = context.to_bytes(length, "big")
            below = next(shares[name[k:]] for k in range(1, length + 1) if name[k:] in shares)
            seen = np.zeros(width)
            seen[place[rows[a:b, 1]]] = rows[a:b, 2]
            count = seen.sum()
            some = seen > 0
            apart = float((seen[some] * np.log(seen[some] / count / below[some])).sum())
            if apart >= cut:
                shares[name] = (seen + SMOOTH * below) / (count + SMOOTH)
    deep = {context.to_bytes(DEPTH, "big") for context in contexts.tolist()}
    # with every part of such a context a state of its own, a byte leads from state to state
    names = {name[a:b] for name in deep.union(shares) for a in range(len(name) + 1) for b in range(a, len(name) + 1)}
    names |= {START[:k][a:] for k in range(len(START) + 1) for a in range(k + 1)}
    order = sorted(names, key=lambda n: (len(n), n in deep, n))
    del names
    number = {name: k for k, name in enumerate(order)}
    logs = np.zeros((len(order), width), np.float32)
    for k, name in enumerate(order):
        logs[k] = np.log10(shares.pop(name)) if name in shares else logs[number[name[1:]]]
    step = np.zeros((len(order), width), np.int32)
    for k, name in enumerate(order):
        suffix = number[name[1:]] if name else 0
        step[k] = step[suffix]
        for byte in alphabet.tolist():
            if (longer := number.get(name + bytes([byte]))) is not None:
                step[k, place[byte]] = longer
    step *= width
    first = (len(order) - len(deep)) * width
    return {"place": place.astype(np.uint8), "logs": logs.ravel(), "step": step.ravel(), "deep": first}


def text_scores(tree: dict, rows: list[list[bytes]]) -> np.ndarray:
    """Log10 probability of every text by the automaton alone."""
    data, ends = stream(rows)
    return _per_text(_place_scores(tree, data, ends)[0], ends)


def _per_text(scores: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return np.add.reduceat(scores, np.concatenate([[0], ends[:-1]]).astype(np.int64))


def _place_scores(tree: dict, data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log10 probability of every byte, and whether it is open: not behind a frequent context of full length. The stream is read in lanes side by side.

    A state depends on the last five bytes only, so a lane that starts five bytes early is in the
    right state when its own part begins.
    """
    codes = tree["place"][data].astype(np.int64)
    lanes = -(-len(codes) // LANE)
    padded = np.zeros(DEPTH + lanes * LANE, np.int64)
    padded[DEPTH : DEPTH + len(codes)] = codes
    grid = np.lib.stride_tricks.as_strided(padded, (lanes, LANE + DEPTH), (LANE * 8, 8))
    grid = np.ascontiguousarray(grid.T)
    got, rest = np.zeros((LANE, lanes), np.float32), np.zeros((LANE, lanes), bool)
    state = np.zeros(lanes, np.int64)
    for k in range(LANE + DEPTH):
        at = state + grid[k]
        if k >= DEPTH:
            tree["logs"].take(at, out=got[k - DEPTH], mode="clip")
            np.less(state, tree["deep"], out=rest[k - DEPTH])
        state = tree["step"].take(at).astype(np.int64)
    marks = scored_places(data, ends)
    flat = got.T.ravel()[: len(codes)].astype(np.float64)
    flat[~marks] = 0.0
    return flat, rest.T.ravel()[: len(codes)] & marks


def run_table(codes: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes and their values by hash, each in the first free place from its own on; half are free."""
    bits = max(2 * len(codes), 2).bit_length()
    keys, out = np.full(1 << bits, EMPTY), np.zeros(1 << bits, np.float32)
    at, left = _slots(codes, bits), np.arange(len(codes))
    while len(left):
        free = np.flatnonzero(keys[at] == EMPTY)
        own, which = np.unique(at[free], return_index=True)
        keys[own], out[own] = codes[left[free[which]]], values[left[free[which]]]
        more = keys[at] != codes[left]
        at, left = at[more] + 1 & len(keys) - 1, left[more]
    return keys, out


def _slots(codes: np.ndarray, bits: int) -> np.ndarray:
    return (codes.astype(np.uint64) * HASH >> np.uint64(64 - bits)).astype(np.int64)


def looked_up(table: tuple[np.ndarray, np.ndarray], codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(whether each code is in a ``run_table``, its value or 0)."""
    keys, values = table
    found, got = np.zeros(len(codes), bool), np.zeros(len(codes), np.float32)
    at, left = _slots(codes, len(keys).bit_length() - 1), np.arange(len(codes))
    while len(left):
        there = keys[at]
        hit = there == codes[left]
        found[left[hit]], got[left[hit]] = True, values[at[hit]]
        more = ~hit & (there != EMPTY)
        at, left = at[more] + 1 & len(keys) - 1, left[more]
    return found, got


def open_scores(tree: dict, runs: tuple, rows: list[list[bytes]]) -> tuple[np.ndarray, pa.ListArray]:
    """Per text the log10 probability of its settled places, and (code, n) of its other runs.

    A place is settled when its five bytes are a frequent context, or with it a frequent run.
    """
    data, ends = stream(rows)
    scores, left = _place_scores(tree, data, ends)
    place = np.flatnonzero(left)
    code = _codes(data, place - DEPTH).view(np.int64)
    found, value = looked_up(runs, code)
    scores[place] = value
    place, code = place[~found], code[~found]
    text = np.searchsorted(ends, place, "right")
    order = np.lexsort((code, text))
    text, code = text[order], code[order]
    new = np.ones(len(text), bool)
    new[1:] = (text[1:] != text[:-1]) | (code[1:] != code[:-1])
    first = np.flatnonzero(new)
    many = np.diff(np.append(first, len(text)))
    pairs = pa.StructArray.from_arrays([pa.array(code[first]), pa.array(many, pa.int64())], names=["code", "n"])
    offsets = np.searchsorted(text[first], np.arange(len(rows) + 1)).astype(np.int32)
    return _per_text(scores, ends), pa.ListArray.from_arrays(pa.array(offsets), pairs)


def _measure(sent):
    """Per text: row number, tokens, what frequent words and places add, the other words and runs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, tree, runs = sent.value
        get, number = head.get, TaskContext.get().partitionId() << 33
        for batch in batches:
            first, size, column = 0, 0, batch.column(0)
            for row, length in enumerate(pc.fill_null(pc.binary_length(column), 0).to_pylist()):
                size += length
                if size > 1 << 20 or row + 1 == batch.num_rows:  # small pieces: words are many objects
                    part = batch.slice(first, row + 1 - first)
                    yield piece(part, get, tree, runs, number + first)
                    first, size = row + 1, 0
            number += batch.num_rows

    def piece(part: pa.RecordBatch, get, tree, runs, number: int) -> pa.RecordBatch:
        rows = [text.lower().split() for text in texts(part.column(0))]
        known, sums, words, counts, ends = [], [], [], [], [0]
        for own in rows:
            logs = [get(w) for w in (*own, END)]
            if None in logs:
                rest = Counter(w for w, x in zip((*own, END), logs) if x is None)
                words.extend(rest)
                counts.extend(rest.values())
                logs = [x for x in logs if x is not None]
            ends.append(len(words))
            known.append(len(logs))
            sums.append(math.fsum(logs))
        pairs = pa.StructArray.from_arrays(
            [pa.array(words, pa.binary()), pa.array(counts, pa.int64())], names=["word", "n"]
        )
        score, other = open_scores(tree, runs, rows)
        columns = [
            pa.array(np.arange(number, number + len(rows))),
            pa.array([len(own) + 1 for own in rows], pa.int64()),
            pa.array(known, pa.int64()),
            pa.array(sums, pa.float64()),
            pa.array(score),
            pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pairs),
            other,
        ]
        names = ["__st_row", "n_tokens", "__st_known", "__st_sum", "__st_score", "__st_rest", "__st_runs"]
        return pa.RecordBatch.from_arrays([*part.columns[1:], *columns], names=[*part.schema.names[1:], *names])

    return run


def score_texts(docs: DataFrame, model: Frequencies, text_col: str = "text") -> DataFrame:
    """``docs`` without its text, with ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score``.

    Tokens are runs of bytes other than ASCII white space, A-Z lower-cased, and one end. The base
    score adds log10((c + 0.1) / (N + 0.1 (V + 1))) over the tokens; ``score`` is the tree's log10
    probability of the text and its end. A null or empty text has the end as its only token.
    Columns of these names are replaced. Frequent words and places are looked up in tables of bounded size,
    all others joined with the full counts and the whole tree. Such a word or run is rare in training, but may be
    frequent in other texts: the table of counts is written, so the join splits its rows. Repeated
    rows stay; with no training texts all tokens are unknown and score alike.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    added = ("n_tokens", "n_known", "train_tokens", "base_score", "score", text_col)
    kept = [c for c in docs.columns if c not in added]
    rows = docs.select(F.col(text_col).alias("__st_text"), *(f"`{c}`" for c in kept))
    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in rows.schema.fields[1:])
    schema += "__st_row long, n_tokens long, __st_known long, __st_sum double, __st_score double, "
    schema += "__st_rest array<struct<word:binary,n:bigint>>, __st_runs array<struct<code:bigint,n:bigint>>"
    levels = model.levels()
    sent = spark.sparkContext.broadcast((model.head(), model.tree(), model.frequent_runs(levels)))
    done = stored(rows.mapInArrow(_measure(sent), schema), "suffix-scores")
    rest = done.select("__st_row", F.inline("__st_rest")).join(model.words, "word", "left")
    share = F.log10(
        (F.coalesce("c", F.lit(0)) + F.lit(0.1)) / F.lit(model.tokens + 0.1 * (model.distinct + 1))
    )
    rest = rest.select(
        "__st_row",
        (F.col("n") * share).alias("__st_more"),
        F.when(F.col("c") > 0, F.col("n")).otherwise(F.lit(0)).alias("__st_found"),
        F.lit(0.0).alias("__st_tree"),
    )
    runs = done.select("__st_row", F.inline("__st_runs"))
    values = stored(run_values(levels, stored(runs.select("code").distinct(), "suffix-sought")), "suffix-values")
    runs = runs.join(values, "code").select(
        "__st_row",
        F.lit(0.0).alias("__st_more"),
        F.lit(0).cast("long").alias("__st_found"),
        (F.col("n") * F.log10("p")).alias("__st_tree"),
    )
    rest = rest.unionByName(runs).groupBy("__st_row").agg(
        *(F.sum(name).alias(name) for name in ("__st_more", "__st_found", "__st_tree"))
    )
    return done.join(rest, "__st_row", "left").select(
        *(f"`{c}`" for c in kept),
        "n_tokens",
        (F.col("__st_known") + F.coalesce("__st_found", F.lit(0))).alias("n_known"),
        F.lit(model.tokens).cast("long").alias("train_tokens"),
        (F.col("__st_sum") + F.coalesce("__st_more", F.lit(0.0))).alias("base_score"),
        (F.col("__st_score") + F.coalesce("__st_tree", F.lit(0.0))).alias("score"),
    )
