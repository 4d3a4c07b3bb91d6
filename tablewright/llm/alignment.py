"""Alignment of two tokenizers over the same texts.

The left tokenizer is a byte-level one of the tokenizers library, the right one a sentencepiece
model that puts a space in front of a text. Both read a text with that space. Spans that the two
libraries report (characters on the left, bytes of the proto on the right) are the coarse cuts; where
a span does not hold just its token's bytes, as for tokens inside one character and for byte-fallback
pieces, the decoded bytes of the tokens say where they end. Offsets at which tokens of both sides
end cut a text into groups, and the two tokens that end there are linked.

Neither tokenizer joins a word with the space behind it (checked against the vocabulary), so a single
space between two words is a cut for both. Texts are aligned part by part between such spaces, and
parts that come again are looked up.

How often a pair is linked in the whole corpus is counted by Spark. Pairs above ``HEAD_SHARE`` of all
links (1 / HEAD_SHARE pairs at the most) are sent to executors, all others joined; none of those
can hold more than that share of the rows.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.llm.bpe import byte_letters
from tablewright.llm.common import bounded_batches, others, schema_of, stored

HEAD_SHARE = 2e-6  # of all links, for a pair whose count is sent to executors
KEPT_PARTS, KEPT_LENGTH = 500_000, 32  # parts that are remembered in a worker, and their longest
PIECE = 1 << 20  # characters of texts worked on together
STEP, LUMP = 1 << 16, 2000  # and of their new parts: handed to the libraries, and put together as one text
SPACE = "▁"
CUT = re.compile(r"(?<=\S) (?=\S)")
BOTH = 1 << 40
NO_LINKS = np.zeros(0, np.int64)


class Aligner:
    """Both tokenizers, and the bytes that each of their tokens stands for."""

    def __init__(self, left_path: str, right_path: str):
        import sentencepiece
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.left = Tokenizer.from_file(left_path)
        self.left.encode_special_tokens = True
        self.left.no_truncation()
        self.left.no_padding()
        self.right = sentencepiece.SentencePieceProcessor(model_file=right_path)
        byte_of = {letter: b for b, letter in enumerate(byte_letters())}
        self.left_bytes: dict[int, bytes] = {}
        for token, number in self.left.get_vocab(with_added_tokens=False).items():
            self.left_bytes[number] = bytes(byte_of[letter] for letter in token)
        pieces = [self.right.id_to_piece(k) for k in range(self.right.get_piece_size())]
        self.right_bytes = [
            bytes([int(piece[3:5], 16)]) if self.right.is_byte(k) else piece.replace(SPACE, " ").encode()
            for k, piece in enumerate(pieces)
        ]
        inner = re.compile(f"[^{SPACE}]{SPACE}")
        self.cuts = not any(inner.search(piece) for piece in pieces)
        self.right_from = max(self.left_bytes) + 1
        self.left_sizes = np.zeros(self.right_from, np.int64)
        self.left_sizes[list(self.left_bytes)] = [len(x) for x in self.left_bytes.values()]
        self.right_sizes = np.array([len(x) for x in self.right_bytes])
        ids = [*range(self.right_from), *range(len(self.right_bytes))]
        self.names = [f"{k}{mark}" for k in ids for mark in ",|;"]  # of left ids, then of right ones
        self.kept: dict[str, tuple | None] = {}

    def parts(self, text: str) -> list[str]:
        """The text cut at spaces where both tokenizers cut; each part had a space in front."""
        return CUT.split(text) if self.cuts else [text]

    def look_up(self, parts: list[str]) -> None:
        """Align parts that are not remembered, many at a time, put together as they were cut."""
        lumps, size = [[]], 0
        for part in parts:
            if lumps[-1] and (size > LUMP or not self.cuts):
                lumps.append([])
                size = 0
            lumps[-1].append(part)
            size += len(part) + 1
        first, size = 0, 0
        for k, lump in enumerate(lumps):
            size += sum(map(len, lump))
            if size > STEP or k + 1 == len(lumps):
                some = [" ".join(x) for x in lumps[first : k + 1]]
                lefts = self.left.encode_batch([" " + x for x in some], add_special_tokens=False)
                protos = self.right.encode(some, num_threads=1, return_type="proto")
                for one, left, proto in zip(lumps[first : k + 1], lefts, protos):
                    self.align(one, left, proto)
                first, size = k + 1, 0

    def align(self, parts: list[str], left, proto) -> None:
        """Keep for each part (tokens, groups as text, pairs), or None; tokens are left * BOTH + right.

        If the bytes of a side are not the parts' own, the parts are looked at one by one, and a
        part for which this holds has no tokens.
        """
        raw = b"".join([b" " + part.encode() for part in parts])
        found = self.ends(raw, left, proto)
        if found is not None:
            a, a_ends, b, b_ends = found
            at = np.minimum(np.searchsorted(b_ends, a_ends), len(b) - 1)
            hit = b_ends[at] == a_ends
            a_last, b_last = np.flatnonzero(hit), at[hit]
            stops = np.cumsum([len(part.encode()) + 1 for part in parts])
            last = np.searchsorted(a_ends[a_last], stops)
            if np.array_equal(a_ends[a_last[last]], stops):
                self._keep(parts, a, b, a_last, b_last, last)
                return
        if len(parts) == 1:
            self.kept[parts[0]] = None
        else:
            for part in parts:
                alone = self.right.encode(part, num_threads=1, return_type="proto")
                self.align([part], self.left.encode(" " + part, add_special_tokens=False), alone)

    def ends(self, raw: bytes, left, proto) -> tuple[np.ndarray, ...] | None:
        """Ids and byte ends of both sides; None where the bytes of a side are not ``raw``."""
        a = np.array(left.ids, np.int64)
        flat = [x for piece in proto.pieces for x in (piece.id, piece.begin, piece.end)]
        pieces = np.array(flat, np.int64).reshape(-1, 3)
        b, b_spans = pieces[:, 0], pieces[:, 1:] + 1
        for ids, bytes_of in ((a, self.left_bytes), (b, self.right_bytes)):
            if b"".join([bytes_of[k] for k in ids.tolist()]) != raw:
                return None
        letters = np.flatnonzero(np.frombuffer(raw, np.uint8) & 0xC0 != 0x80)
        spans = np.fromiter(chain.from_iterable(left.offsets), np.int64, 2 * len(a)).reshape(-1, 2)
        a_spans = np.append(letters, len(raw))[spans]
        return a, refined(a_spans, self.left_sizes[a]), b, refined(b_spans, self.right_sizes[b])

    def _keep(self, parts, a, b, a_last, b_last, last) -> None:
        """Write the groups out, and cut them and their pairs into the parts' own."""
        group = np.concatenate(
            [np.searchsorted(a_last, np.arange(len(a))) * 2, np.searchsorted(b_last, np.arange(len(b))) * 2 + 1]
        )
        order = np.argsort(group, kind="stable")
        group = group[order]
        follow = np.append(group[1:], -1)
        mark = np.where(follow == group, 0, 1 + group % 2)
        code = (np.concatenate([a, b + self.right_from])[order] * 3 + mark).tolist()
        names = [self.names[k] for k in code]
        written = "".join(names)
        upto = np.cumsum([len(name) for name in names])
        stop = upto[a_last + b_last + 1][last].tolist()
        pairs = (b[b_last] << 32 | a[a_last]).tobytes()
        tokens = ((a_last[last] + 1) * BOTH + b_last[last] + 1).tolist()
        t0 = p0 = s0 = 0
        for part, t, p, s in zip(parts, tokens, (8 * last + 8).tolist(), stop):
            self.kept[part] = t - t0, written[s0 : s - 1], pairs[p0:p]
            t0, p0, s0 = t, p, s

    def texts(self, texts: list[str]) -> list[tuple[int, int, int, str, np.ndarray]]:
        """(left tokens, right tokens, groups, groups as text, pairs) of whole texts."""
        if len(self.kept) > KEPT_PARTS:
            self.kept = {}
        kept = self.kept
        split = [self.parts(text) if text else [] for text in texts]
        fresh = list({part for parts in split for part in parts if part not in kept})
        self.look_up(fresh)
        out = []
        for parts in split:
            found = [kept[part] for part in parts]
            if not found or None in found:
                out.append((0, 0, 0, "", NO_LINKS))
                continue
            tokens, written, pairs = zip(*found)
            links = np.frombuffer(b"".join(pairs), np.int64)
            out.append((*divmod(sum(tokens), BOTH), len(links), ";".join(written), links))
        for part in fresh:
            if len(part) > KEPT_LENGTH:
                del kept[part]
        return out


def refined(spans: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Where every token ends: its span's end if the span holds just its bytes, else by the bytes so far."""
    return np.where(spans[:, 1] - spans[:, 0] == sizes, spans[:, 1], np.cumsum(sizes))


ADDED = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "groups")


def _align(left_path: str, right_path: str, spelled: bool):
    """Per text: row number, token and group counts, digest and groups, and its distinct pairs."""
    made: list[Aligner] = []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not made:
            made.append(Aligner(left_path, right_path))
        number = TaskContext.get().partitionId() << 33
        for batch in batches:
            first, size = 0, 0
            for row, length in enumerate(pc.fill_null(pc.utf8_length(batch.column(0)), 0).to_pylist()):
                size += length
                if size > PIECE or row + 1 - first == 512 or row + 1 == batch.num_rows:
                    yield piece(made[0], batch.slice(first, row + 1 - first), number + first)
                    first, size = row + 1, 0
            number += batch.num_rows

    def piece(aligner: Aligner, part: pa.RecordBatch, number: int) -> pa.RecordBatch:
        counts, digests, texts, codes, many, cuts = [], [], [], [], [], [0]
        for *sizes, written, pairs in aligner.texts(part.column(0).to_pylist()):
            counts.append((*sizes, len(pairs)))
            digests.append(hashlib.sha256(written.encode()).hexdigest() if sizes[0] else "")
            texts.append(written if spelled else None)
            own, seen = np.unique(pairs, return_counts=True)
            codes.append(own)
            many.append(seen)
            cuts.append(cuts[-1] + len(own))
        pairs = pa.StructArray.from_arrays(
            [pa.array(np.concatenate(codes)), pa.array(np.concatenate(many).astype(np.int64))], names=["pair", "n"]
        )
        columns = [
            pa.array(np.arange(number, number + part.num_rows)),
            *(pa.array(x, pa.int64()) for x in zip(*counts)),
            pa.array(digests, pa.string()),
            pa.array(texts, pa.string()),
            pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pairs),
        ]
        names = ["__al_row", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "groups", "__al_pairs"]
        return pa.RecordBatch.from_arrays([*part.columns[1:], *columns], names=[*part.schema.names[1:], *names])

    return run


def _summed(sent):
    """Per text: what its frequent pairs add, and its other pairs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, counts, best = sent.value
        for batch in batches:
            pairs = batch.column(batch.num_columns - 1)
            flat = pairs.flatten()
            code, n = flat.field(0).to_numpy(), flat.field(1).to_numpy()
            sizes = np.diff(pairs.offsets.to_numpy())
            row = np.repeat(np.arange(batch.num_rows), sizes)
            at = np.minimum(np.searchsorted(known, code), max(len(known) - 1, 0))
            found = known[at] == code if len(known) else np.zeros(len(code), bool)
            at, seen = at[found], n[found]
            sums, bests = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64)
            np.add.at(sums, row[found], seen * counts[at])
            np.add.at(bests, row[found], np.where(best[at], seen, 0))
            left = ~found
            offsets = np.concatenate([[0], np.cumsum(np.bincount(row[left], minlength=batch.num_rows))])
            rest = pa.ListArray.from_arrays(
                pa.array(offsets, pa.int32()),
                pa.StructArray.from_arrays([pa.array(code[left]), pa.array(n[left])], names=["pair", "n"]),
            )
            columns = [batch.column(0), pa.array(bests), pa.array(sums), rest]
            yield pa.RecordBatch.from_arrays(columns, names=["__al_row", "__al_best", "__al_sum", "__al_rest"])

    return run


def pair_counts(pairs: DataFrame) -> DataFrame:
    """(pair, c, best) of (pair, n) rows: links of a pair, and whether no pair of its right id has more.

    A right id has one row per left id here, whatever the corpus; there are as many ids as the
    vocabulary has, so the table of their best counts is bounded.
    """
    counts = stored(pairs.groupBy("pair").agg(F.sum("n").alias("c")), "alignment-counts")
    right = F.shiftright("pair", 32)
    top = counts.groupBy(right.alias("right")).agg(F.max("c").alias("top"))
    joined = counts.withColumn("right", right).join(top, "right")
    return stored(joined.select("pair", "c", (F.col("c") == F.col("top")).alias("best")), "alignment-pairs")


def align_texts(
    docs: DataFrame,
    left_path: str,
    right_path: str,
    text_col: str = "text",
    spelled: bool = False,
    head_share: float = HEAD_SHARE,
) -> DataFrame:
    """``docs`` without its text, with the figures of the alignment of every text.

    ``n_a`` and ``n_b`` tokens of the left and the right side, ``n_groups`` and ``n_links``; ``n_best``
    links whose pair is its right id's most frequent one in the corpus (ties included),
    ``count_sum`` the corpus counts of its links added up, ``groups_sha256`` of `a1,a2|b1;a3|b2` and,
    if ``spelled``, these ``groups`` themselves. Texts that are null or empty, or whose tokens of
    either side do not give back the text with its space, have zeros and empty texts. Special
    tokens' strings are plain text. Repeated rows stay and count each. A text of any length is
    aligned whole, part by part. An empty table gives no rows. Columns of these names are
    replaced, whatever their case; all others are kept.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    kept = others(docs, text_col, *ADDED)
    rows = docs.select(F.col(f"`{text_col}`").cast("string").alias("__al_text"), *kept)
    schema = ", ".join(
        [
            *schema_of(rows)[1:],
            "__al_row long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, groups string",
            "__al_pairs array<struct<pair:bigint,n:bigint>>",
        ]
    )
    done = stored(rows.mapInArrow(_align(left_path, right_path, spelled), schema), "alignment-texts")
    counts = pair_counts(done.select(F.inline("__al_pairs")))
    total = done.agg(F.sum("n_links")).first()[0] or 0
    head = counts.filter(F.col("c") > total * head_share).toArrow().sort_by("pair")
    sent = spark.sparkContext.broadcast(tuple(head[name].to_numpy() for name in ("pair", "c", "best")))
    sums = stored(
        done.select("__al_row", "__al_pairs").mapInArrow(
            _summed(sent),
            "__al_row long, __al_best long, __al_sum long, __al_rest array<struct<pair:bigint,n:bigint>>",
        ),
        "alignment-sums",
    )
    rest = sums.select("__al_row", F.inline("__al_rest")).join(counts, "pair").select(
        "__al_row",
        F.when(F.col("best"), F.col("n")).otherwise(F.lit(0)).alias("__al_best"),
        (F.col("n") * F.col("c")).alias("__al_sum"),
    )
    added = sums.select("__al_row", "__al_best", "__al_sum").union(rest).groupBy("__al_row").agg(
        F.sum("__al_best").alias("n_best"), F.sum("__al_sum").alias("count_sum")
    )
    names = [*ADDED[:-1], *(["groups"] if spelled else [])]
    return done.drop("__al_pairs").join(added, "__al_row").select(*kept, *names)
