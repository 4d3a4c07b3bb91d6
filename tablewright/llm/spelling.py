"""Words that differ by one inserted, deleted or replaced letter, through numbered trie nodes.

All words form a trie, and all reversed words another. A node is numbered by an integer, so a pair
(node of the letters before a place, node of the letters behind it) stands for a word with that place
left open. Two words have the same pair with one letter skipped in each when they differ in that
letter alone, and the pair of one with a letter skipped is the pair of the other with none skipped when
they differ by that letter. These integer pairs are joined by grouping: a pair has one row per letter
that can stand in the gap and one for no letter, so a group is no larger than the alphabet. A letter
that repeats the one before it is not skipped for insertions, so a neighbour is met just once.

Nodes are numbered without writing out prefixes: words are sorted by range, and a prefix is new at the
first word that has it. A prefix that goes on over the bounds of a range is numbered by the first bound
it spans.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablewright.llm.common import bounded_batches, stored, tasks_for

RUN = re.compile("[A-Za-zÀ-ÿ]+")
HELD_BYTES = 32 << 20  # of counted words in a worker
WORD_BYTES = 120  # that a counted word takes besides its letters
BOUND = 1 << 62


def shared_letters(a: str, b: str) -> int:
    """How many leading letters are equal."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        middle = (low + high + 1) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle - 1
    return low


def _counted(drop_every: int, shortest: int):
    """Counts of the words of a task's texts, combined as far as memory allows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        held = 0
        for batch in batches:
            for doc, text in zip(batch.column(0), batch.column(1)):
                text = text.as_py()
                if not text:
                    continue
                own = Counter(RUN.findall(text.encode().lower().decode()))
                name = f"{doc.as_py()}:".encode() if doc.is_valid else b"null:"
                start = zlib.crc32(name)
                for word, n in own.items():
                    if drop_every:
                        h = zlib.crc32(word.encode(), start)
                        if h % drop_every == 0:
                            at = h % len(word)
                            word = word[:at] + word[at + 1 :]
                    if len(word) >= shortest:
                        if word not in seen:
                            held += WORD_BYTES + len(word)
                        seen[word] += n
                if held > HELD_BYTES:
                    yield flush(seen)
                    seen, held = Counter(), 0
        yield flush(seen)

    def flush(seen: Counter) -> pa.RecordBatch:
        columns = [pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())]
        return pa.RecordBatch.from_arrays(columns, names=["word", "n"])

    return run


def word_counts(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    least: int = 3,
    shortest: int = 5,
    drop_every: int = 0,
) -> DataFrame:
    """(word, n) of all runs of A-Z, a-z and U+00C0 to U+00FF, A-Z lower-cased.

    Words of fewer than ``shortest`` code points or fewer than ``least`` occurrences are left out.
    With ``drop_every`` a run whose crc32 of `id:run` that number divides loses the letter at crc32
    modulo its length; the id of a row without one is written `null`.
    """
    bounded_batches(docs.sparkSession)
    slim = docs.select(F.col(f"`{id_col}`").cast("string"), F.col(f"`{text_col}`").cast("string"))
    parts = slim.mapInArrow(_counted(drop_every, shortest), "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)


def _bounds(sorted_words: DataFrame) -> list[tuple[int, str, str, int]]:
    """(range, first word, last word, letters that its first word shares with the word before).

    Two words for every range, and there are as many ranges as shuffle partitions.
    """
    rows = sorted_words.groupBy("part").agg(F.min("key"), F.max("key")).orderBy("part").collect()
    out = []
    for k, (part, first, last) in enumerate(rows):
        out.append((part, first, last, shared_letters(rows[k - 1][2], first) if k else 0))
    return out


def _numbered(bounds: list[tuple[int, str, str, int]]):
    """For every word of a sorted range the numbers of the nodes of its prefixes, shortest first."""
    place = {part: k for k, (part, *_) in enumerate(bounds)}

    def first_bound(k: int) -> list[int]:
        """For each prefix of range k's first word that the range before also has: the first bound it spans."""
        shared = bounds[k][3]
        out = [k] * (shared + 1)
        while k > 0:
            # goes on over the whole range before, if that range's first word has it too
            shared = min(shared, bounds[k - 1][3], shared_letters(bounds[k - 1][1], bounds[k - 1][2]))
            k -= 1
            out[: shared + 1] = [k] * (shared + 1)
            if not shared:
                break
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, count, word, nodes, left, right = None, 0, "", [0], [], 0
        for batch in batches:
            words, every, cuts, ids = [], [], [0], []
            for part, key in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if part != now:
                    now, index, count, word, nodes = part, 0, 0, "", [0]
                    k = place[part]
                    left = first_bound(k)
                    last, right = bounds[k][2], bounds[k + 1][3] if k + 1 < len(bounds) else 0
                    base = part << 36
                    same = 0
                else:
                    same = shared_letters(word, key)
                near_left = shared_letters(bounds[k][1], key)
                near_right = min(shared_letters(last, key), right)
                fresh = []
                for size in range(same + 1, len(key) + 1):
                    if size <= near_left and size < len(left):
                        fresh.append(BOUND | left[size] << 32 | size)
                    elif size <= near_right:
                        fresh.append(BOUND | (k + 1) << 32 | size)
                    else:
                        count += 1
                        fresh.append(base + count)
                nodes = nodes[: same + 1] + fresh
                word = key
                ids.append(base + index)
                index += 1
                words.append(key)
                every.append(np.array(nodes, np.int64))
                cuts.append(cuts[-1] + len(nodes))
                if cuts[-1] > 500_000:
                    yield rows(ids, words, every, cuts)
                    words, every, cuts, ids = [], [], [0], []
            if words:
                yield rows(ids, words, every, cuts)

    def rows(ids, words, every, cuts) -> pa.RecordBatch:
        nodes = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(np.concatenate(every)))
        columns = [pa.array(ids, pa.int64()), pa.array(words, pa.string()), nodes]
        return pa.RecordBatch.from_arrays(columns, names=["number", "key", "nodes"])

    return run


def trie_nodes(words: DataFrame, column: str, label: str) -> DataFrame:
    """(number, key, nodes) of distinct words.

    ``number`` follows the order of code points. ``nodes`` has the node of the empty prefix (0) and
    of each longer one; equal numbers stand for equal prefixes.
    """
    spark = words.sparkSession
    tasks = tasks_for(spark)
    keys = words.select(F.col(column).alias("key"))
    dealt = keys.repartitionByRange(tasks, "key").select(F.spark_partition_id().alias("part"), "key")
    dealt = stored(dealt, f"{label}-words")
    bounds = _bounds(dealt)
    ranged = dealt.repartition(tasks, "part").sortWithinPartitions("part", "key")
    nodes = ranged.mapInArrow(_numbered(bounds), "number long, key string, nodes array<long>")
    return stored(nodes, f"{label}-nodes")


def _pairs(numbered: DataFrame) -> DataFrame:
    """(before, behind, kind, number, n): a row for every letter skipped and every place between.

    Kind 2 is a skipped letter that differs from the one before it, 1 one that repeats it, 0 none.
    """
    size = F.size("letters")
    skipped = F.transform(
        F.sequence(F.lit(1), size),
        lambda i: F.struct(
            F.element_at("prefix", i).alias("before"),
            F.element_at("suffix", size - i + 1).alias("behind"),
            F.when((i > 1) & (F.get("letters", i - 1) == F.get("letters", i - 2)), 1)
            .otherwise(2)
            .alias("kind"),
        ),
    )
    between = F.transform(
        F.sequence(F.lit(1), size + 1),
        lambda i: F.struct(
            F.element_at("prefix", i).alias("before"),
            F.element_at("suffix", size - i + 2).alias("behind"),
            F.lit(0).alias("kind"),
        ),
    )
    every = F.inline(F.concat(skipped, between))
    return numbered.select("number", "n", every)


def neighbours(words: DataFrame) -> DataFrame:
    """(number, word, n, n_near, best): near words of every (word, n), and the most frequent of them.

    ``best`` is a struct (n, number) or null; of equal n the smallest word has the least number.
    """
    forward = trie_nodes(words, "word", "spelling-forward")
    backward = trie_nodes(words.select(F.reverse("word").alias("key")), "key", "spelling-backward")
    numbered = words.join(
        forward.select("number", F.col("key").alias("word"), F.col("nodes").alias("prefix")), "word"
    ).join(backward.select(F.reverse("key").alias("word"), F.col("nodes").alias("suffix")), "word")
    numbered = stored(numbered.withColumn("letters", F.split("word", "")), "spelling-numbered")
    member = F.struct("n", (-F.col("number")).alias("back"), "kind")
    groups = (
        _pairs(numbered)
        .groupBy("before", "behind")
        .agg(F.sort_array(F.collect_list(member), asc=False).alias("all"))
        .filter(F.size("all") > 1)
    )

    def near(one):
        """What can be put for ``one`` in its group, the most frequent first."""
        return F.filter(
            "all",
            lambda x: F.when(one["kind"] == 0, x["kind"] == 2)
            .when(x["kind"] == 0, one["kind"] == 2)
            .otherwise(x["back"] != one["back"]),
        )

    each = F.transform(
        "all",
        lambda one: F.struct(
            (-one["back"]).alias("number"),
            F.size(near(one)).cast("long").alias("near"),
            F.get(near(one), F.lit(0)).alias("first"),
        ),
    )
    found = groups.select(F.inline(each)).filter("near > 0").groupBy("number").agg(
        F.sum("near").alias("n_near"), F.max(F.struct("first.n", "first.back")).alias("best")
    )
    best = F.when(F.col("best").isNotNull(), F.struct("best.n", (-F.col("best.back")).alias("number")))
    return numbered.select("number", "word", "n").join(found, "number", "left").select(
        "number", "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), best.alias("best")
    )


def roots(links: DataFrame) -> DataFrame:
    """(number, root) of (number, next): the last one reached; ``next`` is null at the end.

    Pointer doubling: as a form is at least twice as frequent as its word, chains have at most as
    many links as the largest count has bits, and rounds grow with the logarithm of that.
    """
    state = stored(links.select("number", F.coalesce("next", "number").alias("root")), "spelling-roots")
    while True:
        above = state.select(F.col("number").alias("root"), F.col("root").alias("up"))
        moved = stored(state.join(above, "root").select("number", "root", "up"), "spelling-roots")
        state = moved.select("number", F.col("up").alias("root"))
        if moved.filter("up <> root").isEmpty():
            return state


def spelling_variants(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    least: int = 3,
    shortest: int = 5,
    ratio: int = 2,
    drop_every: int = 0,
) -> DataFrame:
    """One row per word: ``word``, ``form``, ``root``, ``n``, ``n_near``, ``form_n``.

    Words and counts are those of ``word_counts``. Words are near when they differ by just one
    inserted, deleted or replaced code point. ``form`` is the near word of the largest n (of equal
    ones the smallest by code points) if that is at least ``ratio`` (2 or more) times the word's own, else null;
    ``root`` is the last word reached by following forms. Null and empty texts have no words, a
    run of any length is one word, repeated rows count each, other columns are ignored, an empty
    table gives no rows.
    """
    if ratio < 2:
        raise ValueError("with a smaller ratio chains of forms need not be short")
    words = stored(word_counts(docs, id_col, text_col, least, shortest, drop_every), "spelling-words")
    found = stored(neighbours(words), "spelling-near")
    chosen = F.when(F.col("best.n") >= ratio * F.col("n"), F.col("best.number"))
    found = found.withColumn("next", chosen)
    ends = roots(found)
    names = found.select("number", "word", "n")
    form = names.select(F.col("number").alias("next"), F.col("word").alias("form"), F.col("n").alias("form_n"))
    root = names.select(F.col("number").alias("root_number"), F.col("word").alias("root"))
    ends = ends.select("number", F.col("root").alias("root_number"))
    return (
        found.join(form, "next", "left")
        .join(ends, "number")
        .join(root, "root_number")
        .select("word", "form", "root", "n", "n_near", "form_n")
    )
