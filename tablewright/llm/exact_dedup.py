"""Exact duplicates through radix tries over whole texts.

Every task first puts its own rows into a compressed trie, so copies that it holds meet there and
one row per distinct text goes on. These are dealt out by (length, content hash), inserted into
one trie per partition, and a terminal node keeps the owner of its text and how many rows it has.
A trie over its memory bound moves whole subtrees to a temporary file and works them off later; the file
is the task's own, and a task that runs again makes it anew.
"""

from __future__ import annotations

import hashlib
import pickle
import tempfile
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import bounded_batches, stored, tasks_for, texts

NODE_BYTES = 200


class Node:
    __slots__ = ("label", "children", "entry", "spill")

    def __init__(self, label: bytes):
        self.label, self.children, self.entry, self.spill = label, {}, None, None


def shared_length(a: bytes, b: bytes) -> int:
    """How many leading bytes are equal."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        middle = (low + high + 1) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle - 1
    return low


def read_back(node: Node) -> Iterator[tuple[bytes, object]]:
    """The strings below a node that lie in its file, if it has one."""
    if node.spill is not None:
        node.spill.seek(0)
        while True:
            try:
                yield pickle.load(node.spill)
            except EOFError:
                break
        node.spill.close()


class RadixTrie:
    """A compressed trie over byte strings; each terminal node holds one entry.

    ``merge(old, new)`` joins the entries of equal strings. Beyond ``budget`` bytes the largest
    subtrees go to files, and later strings below them are appended there unread.
    """

    def __init__(self, merge, budget: int):
        self.merge, self.budget = merge, budget
        self.root, self.held = Node(b""), 0

    def insert(self, key: bytes, entry):
        """The merged entry of ``key``, or None where its subtree lies in a file."""
        node, at = self.root, 0
        while at < len(key):
            child = node.children.get(key[at])
            if child is None:
                child = Node(key[at:])
                node.children[key[at]] = child
                self.held += NODE_BYTES + len(child.label)
                node, at = child, len(key)
            elif key.startswith(child.label, at):
                node, at = child, at + len(child.label)
                if node.spill is not None:
                    pickle.dump((key[at:], entry), node.spill, -1)
                    return None
            else:
                cut = shared_length(child.label, key[at:])
                upper = Node(child.label[:cut])
                child.label = child.label[cut:]
                upper.children[child.label[0]] = child
                node.children[key[at]] = upper
                self.held += NODE_BYTES
                node, at = upper, at + cut
        node.entry = entry if node.entry is None else self.merge(node.entry, entry)
        entry = node.entry
        while self.held > self.budget and self._spill_one():
            pass
        return entry

    def _spill_one(self) -> bool:
        """Move the subtree reached by following the largest child to a file."""
        sizes: dict[int, int] = {}
        order = [n for n, _ in self._nodes(b"")]
        for n in reversed(order):
            sizes[id(n)] = NODE_BYTES + len(n.label) + sum(sizes[id(c)] for c in n.children.values())
        node = self.root
        while True:
            there = [c for c in node.children.values() if c.spill is None and (c.children or c.entry)]
            if not there:
                break
            node = max(there, key=lambda c: sizes[id(c)])
            if sizes[id(node)] <= self.budget // 2 and node.children:
                break
        if node is self.root or not (node.children or node.entry is not None):
            return False
        file = tempfile.TemporaryFile()
        for n, suffix in list(self._nodes(b"", node)):
            if n.entry is not None:
                pickle.dump((suffix, n.entry), file, -1)
            for below, entry in read_back(n):
                pickle.dump((suffix + below, entry), file, -1)
        self.held -= sizes[id(node)] - NODE_BYTES - len(node.label)
        node.children, node.entry, node.spill = {}, None, file
        return True

    def _nodes(self, path: bytes, top: Node | None = None) -> Iterator[tuple[Node, bytes]]:
        """Every node with the bytes on the way to it, parents first."""
        stack = [(top or self.root, path)]
        while stack:
            node, path = stack.pop()
            yield node, path
            stack.extend((c, path + c.label) for c in node.children.values())

    def entries(self) -> Iterator:
        """Every terminal's entry; files are read back one at a time."""
        stack = [self.root]
        while stack:
            node = stack.pop()
            if node.entry is not None:
                yield node.entry
            stack.extend(node.children.values())
            if node.spill is not None:
                below = RadixTrie(self.merge, self.budget)
                for key, entry in read_back(node):
                    below.insert(key, entry)
                yield from below.entries()


def better(a, b, largest: bool):
    """Of two (id, row number) the owner: the wanted end of the ids, then the first row."""
    if a[0] is None or b[0] is None:
        return a if b[0] is None and (a[0] is not None or a[1] <= b[1]) else b
    if a[0] == b[0]:
        return min(a, b)
    return (max if largest else min)(a, b)


def _combine(largest: bool, merge):
    def join(a, b):
        return better(a[0], b[0], largest), a[1] + b[1], merge(a[2], b[2])

    return join


def _local(id_name: str, text_name: str, largest: bool, window: int):
    """Mark each row of a task with the first row of the same text in its window.

    A window ends when its trie or the batches it waits with hold ``window`` bytes, so copies fill it
    as well; the first row of a text carries the owner and the number of its rows in the window.
    """
    join = _combine(largest, lambda a, b: a)

    def settled(held: list, trie: RadixTrie) -> Iterator[pa.RecordBatch]:
        final = {entry[2]: entry for entry in trie.entries()}
        for batch, numbers, marks, sums, lengths, hashes in held:
            totals = [final[m] if m == n else ((None, None), None) for n, m in zip(numbers, marks)]
            extra = (
                numbers, marks, sums, lengths, hashes,
                [t[0][0] for t in totals], [t[0][1] for t in totals], [t[1] for t in totals],
            )
            kinds = [pa.string() if name == "__xd_sha256" else pa.int64() for name in EXTRA]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *(pa.array(x, k) for x, k in zip(extra, kinds))],
                names=[*batch.schema.names, *EXTRA],
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 33
        held, size, trie = [], 0, RadixTrie(join, 1 << 62)
        for batch in batches:
            numbers, marks, sums, lengths, hashes = [], [], [], [], []
            for doc, text in zip(batch.column(id_name).to_pylist(), texts(batch.column(text_name))):
                text = text.lower()
                digest = hashlib.sha256(text)
                marks.append(trie.insert(text, ((doc, number), 1, number))[2])
                numbers.append(number)
                sums.append(digest.hexdigest())
                lengths.append(len(text))
                hashes.append(int.from_bytes(digest.digest()[:8], "big", signed=True))
                number += 1
            held.append((batch, numbers, marks, sums, lengths, hashes))
            size += batch.nbytes + NODE_BYTES * batch.num_rows
            if max(trie.held, size) > window:
                yield from settled(held, trie)
                held, size, trie = [], 0, RadixTrie(join, 1 << 62)
        yield from settled(held, trie)

    return run


EXTRA = (
    "__xd_row", "__xd_mark", "__xd_sha256", "__xd_length", "__xd_hash",
    "__xd_owner", "__xd_owner_row", "__xd_count",
)
EXTRA_TYPES = (
    "__xd_row long, __xd_mark long, __xd_sha256 string, __xd_length long, __xd_hash long, "
    "__xd_owner long, __xd_owner_row long, __xd_count long"
)


def gathered(marks: list[int], more: list[int]) -> list[int]:
    marks.extend(more)
    return marks


def _owners(largest: bool, budget: int):
    """One row for each mark: the owner and size of its text's whole group."""
    join = _combine(largest, gathered)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = RadixTrie(join, budget)
        for batch in batches:
            rows = zip(*(batch.column(k).to_pylist() for k in range(1, 5)))
            for text, (mark, owner, row, count) in zip(texts(batch.column(0)), rows):
                trie.insert(text.lower(), ((owner, row), count, [mark]))
        out = ([], [], [], [])
        for (owner, row), count, marks in trie.entries():
            for mark in marks:
                for column, value in zip(out, (mark, owner, row, count)):
                    column.append(value)
            if len(out[0]) >= 50_000:
                yield _batch(out)
                out = ([], [], [], [])
        yield _batch(out)

    return run


def _batch(columns) -> pa.RecordBatch:
    names = ("__xd_mark", "keep_id", "__xd_keep_row", "group_size")
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=list(names))


def marked(
    docs: DataFrame, id_col: str, text_col: str, largest: bool, memory: int = 48 << 20
) -> tuple[DataFrame, DataFrame]:
    """(all rows with a row number and a mark, owner and size for every mark)."""
    spark = docs.sparkSession
    bounded_batches(spark)
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema), EXTRA_TYPES])
    rows = stored(docs.mapInArrow(_local(id_col, text_col, largest, memory // 2), schema), "exact-rows")
    firsts = rows.filter("__xd_row = __xd_mark").select(
        text_col, "__xd_mark", "__xd_owner", "__xd_owner_row", "__xd_count", "__xd_length", "__xd_hash"
    )
    owners = firsts.repartition(tasks_for(spark), "__xd_length", "__xd_hash").mapInArrow(
        _owners(largest, memory), "__xd_mark long, keep_id long, __xd_keep_row long, group_size long"
    )
    return rows, owners


def exact_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest"
) -> DataFrame:
    """One row per input row: id, owner's id, group size, kept or not, SHA-256 of the text.

    Texts are equal when their bytes are after lower-casing A-Z; null counts as empty. The owner
    is the ``keep`` ("smallest" or "largest") id. Of repeated rows with the owner's id the first
    one is kept, so each group keeps exactly one row; null ids own a group only among
    themselves. An empty table gives no rows. Other columns are ignored.
    """
    if keep not in ("smallest", "largest"):
        raise ValueError(keep)
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("__xd_text"))
    rows, owners = marked(slim, "doc_id", "__xd_text", keep == "largest")
    return (
        rows.select("doc_id", "__xd_row", "__xd_mark", "__xd_sha256")
        .join(owners, "__xd_mark")
        .select(
            "doc_id",
            "keep_id",
            "group_size",
            (F.col("__xd_row") == F.col("__xd_keep_row")).alias("kept"),
            F.col("__xd_sha256").alias("text_sha256"),
        )
    )


def exact_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest"
) -> DataFrame:
    """The rows that own their text, with all their columns as they came. See ``exact_groups``."""
    rows, owners = marked(
        docs.withColumn("__xd_id", F.col(id_col).cast("long")), "__xd_id", text_col, keep == "largest"
    )
    kept = owners.select(F.col("__xd_keep_row").alias("__xd_row")).distinct()
    return rows.join(kept, "__xd_row", "left_semi").select(*(f"`{c}`" for c in docs.columns))
