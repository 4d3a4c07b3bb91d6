"""Token ids of a corpus in binary files, and reading them back.

A file is a row of records, each with a line end behind it. A record has a head (magic, vocabulary
size, number of the file, place in the file, lengths), the ids and token counts of the documents that
begin in it, one block of ids (``range_coder``), and a check sum of all that. Blocks can be decoded by
themselves. Files hold documents in ascending order of their ids and are numbered in that order, so
a document's place among all ids follows from the counts.

Spark writes the records through its text writer (a record is a row and its bytes go out as they are)
and reads files whole, so a file is kept to a few million ids; a longer document goes over blocks.
"""

from __future__ import annotations

import json
import os
import re
import struct
import zlib
from codecs import charmap_decode
from collections.abc import Iterator
from functools import lru_cache
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tablewright.llm.common import bounded_batches, chunks, stored, tasks_for
from tablewright.llm.range_coder import BLOCK, decode_block, encode_block

HEAD = "<4sIIIII"  # magic, vocabulary size, file, place, documents, bytes of the block
HEAD_SIZE = struct.calcsize(HEAD)
MAGIC = b"TKR1"
FILE_IDS = 8 << 20
KEPT_RUNS, KEPT_LENGTH = 1_000_000, 32  # runs whose ids a worker remembers, and their longest
PIECE = 4 << 20  # bytes of text that are looked up at a time
#: How a tokenizer must treat words for ``PLAIN`` ones to be cut here: case, composed forms and white space, then runs.
LAYOUT = {
    "normalizer": {
        "type": "Sequence",
        "normalizers": [
            {"type": "NFC"},
            {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "},
            {"type": "Lowercase"},
        ],
    },
    "pre_tokenizer": {
        "type": "Sequence",
        "pretokenizers": [
            {
                "type": "Split",
                "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"},
                "behavior": "Removed",
                "invert": True,
            },
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        ],
    },
    "post_processor": None,
    "end": "</w>",
}
END = LAYOUT["end"]
#: What a byte is where the tokenizer cuts as ``LAYOUT`` says: its words' gaps, then what runs are made of. Other bytes,
#: but those of Latin-1 letters (composed, and with one lower case each), leave their word to the whole library.
GAP, LETTER, DIGIT, SIGN, OTHER = range(5)
GAPS = b" \t\n"
KINDS = np.full(256, OTHER, np.uint8)
KINDS[list(GAPS)] = GAP
KINDS[0x21:0x7F] = SIGN
KINDS[list(b"0123456789")] = DIGIT
KINDS[list(b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ")] = LETTER
KINDS[ord("'")] = OTHER
KINDS = KINDS.tobytes()
LOWER = bytes(range(256)).lower()
LATIN, TIMES, DIVIDED, CASE = 0xC3, 0x97, 0xB7, 0x20  # lead byte of U+00C0 to U+00FF, the two that are no letters, case bit
#: The characters that stand for the 256 bytes in byte-level models: a printable one of Latin-1 for itself.
PRINTED = [b for b in range(256) if chr(b).isprintable() and b != 0x20]
BYTE_LETTERS = "".join(chr(b if b in PRINTED else 256 + b - sum(x < b for x in PRINTED)) for b in range(256))


class WordIds:
    """Ids of texts by the tokenizers library, run by run.

    The tokenizer must never join what stands on both sides of a space, a tab or a line feed,
    as is the case where its pattern drops white space. Where it cuts and maps words as ``LAYOUT`` says, words of
    plain characters are lower-cased and cut into runs of letters, digits and runs of signs here, by arrays, and
    the library's model has to see a run once. All other words are runs of their own, which go through the
    whole library. Runs that come again are looked up.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.kind = np.dtype("<u2" if self.size <= 1 << 16 else "<u4")
        self.model = Tokenizer(self.tokenizer.model)  # nothing but the model
        self.added = [token.content for token in self.tokenizer.get_added_tokens_decoder().values()]
        parts = json.loads(self.tokenizer.to_str())
        vocabulary, parts["end"] = self.tokenizer.get_vocab(with_added_tokens=False), parts["model"].get("end_of_word_suffix")
        self.plain = {name: parts[name] for name in LAYOUT} == LAYOUT
        self.plain &= all(x in vocabulary and x + END in vocabulary for x in BYTE_LETTERS)
        # a word that has an added token in it must not look like a run
        self.plain &= not any(t.isalnum() or not any(c.isalnum() for c in t) for t in self.added)
        self.closing = np.zeros(self.size, bool)  # whether a token ends a run, as no run has END in it
        self.closing[[k for token, k in vocabulary.items() if token.endswith(END)]] = True
        self.forget()

    def forget(self) -> None:
        """Start anew with no ids kept."""
        self.places: dict[bytes, int] = {}  # of the runs whose ids are kept
        self.ids, self.ends = np.zeros(0, self.kind), np.zeros(1, np.int64)

    def _others(self, data: np.ndarray, offsets: np.ndarray, kinds: np.ndarray) -> np.ndarray:
        """Places of the bytes of all words that are not plain."""
        if not self.plain:
            return np.flatnonzero(kinds)
        odd = [np.flatnonzero(kinds == OTHER)]
        for token in self.added:
            found = re.finditer(re.escape(token.encode()), data.data)
            odd.append(np.array([match.start() for match in found], np.int64))
        odd = np.concatenate(odd)
        if not len(odd):
            return odd
        inside = kinds != GAP
        begins, ends = inside.copy(), inside.copy()
        begins[1:] &= ~inside[:-1]
        ends[:-1] &= ~inside[1:]
        cuts = offsets[(offsets > 0) & (offsets < len(data))]
        begins[cuts] = inside[cuts]
        ends[cuts - 1] = inside[cuts - 1]
        begins, ends = np.flatnonzero(begins), np.flatnonzero(ends) + 1
        words = np.unique(np.searchsorted(begins, odd, "right") - 1)
        sizes = ends[words] - begins[words]
        return np.repeat(begins[words] - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())

    def runs(self, data: np.ndarray, offsets: np.ndarray) -> tuple[pa.DictionaryArray, np.ndarray, np.ndarray]:
        """(runs of all texts, which of the different ones are words that are not plain, runs before each text)."""
        kinds, low = (np.frombuffer(bytearray(data).translate(table), np.uint8) for table in (KINDS, LOWER))
        lead = np.flatnonzero(data[:-1] == LATIN)
        second = data[lead + 1]
        letters = (second >> 6 == 2) & (second != TIMES) & (second != DIVIDED)
        lead, second = lead[letters], second[letters]
        kinds[lead] = kinds[lead + 1] = LETTER
        low[lead + 1] = np.where(second < 0x9F, second + CASE, second)
        others = self._others(data, offsets, kinds)
        kinds[others], low[others] = OTHER, data[others]
        begins = kinds == DIGIT
        begins[1:] |= kinds[1:] != kinds[:-1]
        begins[offsets[:-1][offsets[:-1] < len(data)]] = True
        inside = kinds != GAP
        ends = inside.copy()
        ends[:-1] &= begins[1:] | ~inside[1:]
        begins &= inside
        starts = np.flatnonzero(begins)
        bounds = np.concatenate([[0], np.cumsum(np.flatnonzero(ends) + 1 - starts)])
        buffers = [None, pa.py_buffer(bounds), pa.py_buffer(bytearray(low).translate(None, GAPS))]
        found = pa.Array.from_buffers(pa.large_binary(), len(starts), buffers).dictionary_encode()
        whole = np.zeros(len(found.dictionary), bool)
        if len(others):
            whole[found.indices.to_numpy()[kinds[starts] == OTHER]] = True
        return found, whole, np.searchsorted(starts, offsets)

    def learn(self, fresh: list[bytes], whole: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, how many each has) of new runs."""
        sizes = np.zeros(len(fresh), np.int64)
        words, plain = np.flatnonzero(whole), np.flatnonzero(~whole)
        texts = [fresh[k].decode() for k in words.tolist()]
        found = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        sizes[words] = [len(own) for own in found]
        word_ids = np.array([x for own in found for x in own], self.kind)
        if not len(plain):
            return word_ids, sizes
        letters = charmap_decode(b" ".join([fresh[k] for k in plain.tolist()]), "strict", BYTE_LETTERS)[0]
        (found,) = self.model.encode_batch_fast(
            [letters.split(BYTE_LETTERS[0x20])], is_pretokenized=True, add_special_tokens=False
        )
        run_ids = np.array(found.ids, self.kind)
        sizes[plain] = np.diff(np.flatnonzero(self.closing[run_ids]) + 1, prepend=0)
        ids, own = np.empty(len(word_ids) + len(run_ids), self.kind), np.repeat(whole, sizes)
        ids[own], ids[~own] = word_ids, run_ids
        return ids, sizes

    def __call__(self, texts: list[str]) -> list[bytes]:
        """The ids of every text as little-endian numbers."""
        ids, ends = self.column(pa.array(texts, pa.large_string()))
        return [own.tobytes() for own in np.split(ids, ends[:-1])] if texts else []

    def column(self, texts: pa.Array, end: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, place after each text), each with the id ``end`` behind it. Null is empty."""
        ids, ends = [np.zeros(0, self.kind)], [np.zeros(0, np.int64)]
        upto = 0
        for _, _, own, places in self.pieces(texts, end):
            ids.append(own)
            ends.append(places + upto)
            upto += len(own)
        return np.concatenate(ids), np.concatenate(ends)

    def pieces(self, texts: pa.Array, end: int | None = None) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """(first text, last text + 1, ids of these texts, place after each) of texts of about ``PIECE`` bytes."""
        for first, last, data, offsets in chunks(texts, PIECE):
            if len(self.places) > KEPT_RUNS:
                self.forget()
            found, whole, bounds = self.runs(data, offsets)
            names = found.dictionary.to_numpy(zero_copy_only=False).tolist()
            places = np.fromiter(map(self.places.get, names, repeat(-1)), np.int64, len(names))
            ids, ends = self.ids, self.ends
            new = np.flatnonzero(places < 0)
            if len(new):
                lengths = pc.binary_length(found.dictionary).to_numpy()[new]
                new = new[np.argsort(lengths > KEPT_LENGTH, kind="stable")]  # long ones are last and not kept
                fresh = [names[k] for k in new.tolist()]
                got, sizes = self.learn(fresh, whole[new])
                places[new] = np.arange(len(ends) - 1, len(ends) - 1 + len(new))
                ids, ends = np.concatenate([ids, got]), np.concatenate([ends, ends[-1] + np.cumsum(sizes)])
                keep = int((lengths <= KEPT_LENGTH).sum())
                self.places.update(zip(fresh[:keep], range(len(self.ends) - 1, len(self.ends) - 1 + keep)))
                self.ends = ends[: len(self.ends) + keep]
                self.ids = ids[: self.ends[-1]]
            run = places[found.indices.to_numpy()]
            many = ends[run + 1] - ends[run]
            upto = np.concatenate([[0], np.cumsum(many)])
            ids = ids[np.repeat(ends[run] - upto[:-1], many) + np.arange(upto[-1])]
            ends = upto[bounds[1:]]
            if end is not None:
                ends = ends + np.arange(1, len(ends) + 1)
                out = np.full(len(ids) + len(ends), end, self.kind)
                own = np.ones(len(out), bool)
                own[ends - 1] = False
                out[own] = ids
                ids = out
            yield first, last, ids, ends


@lru_cache(maxsize=2)
def _word_ids(path: str) -> WordIds:
    """One per worker process, for all of its tasks."""
    return WordIds(path)


def _coded(path: str, end: int):
    """(doc_id, row, n, ids) of (doc_id, text), the end id included."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, number = _word_ids(path), TaskContext.get().partitionId() << 33
        for batch in batches:
            for first, last, ids, ends in words.pieces(batch.column(1), end):
                bounds = np.concatenate([[0], ends * ids.itemsize])
                buffers = [None, pa.py_buffer(bounds), pa.py_buffer(ids)]
                columns = [
                    batch.column(0).slice(first, last - first),
                    pa.array(np.arange(number, number + len(ends))),
                    pa.array(np.diff(ends, prepend=0)),
                    pa.Array.from_buffers(pa.large_binary(), len(ends), buffers).cast(pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "row", "n", "ids"])
                number += len(ends)

    return run


def record(size: int, file: int, place: int, docs: list[tuple[int | None, int]], ids: np.ndarray) -> bytes:
    """The bytes of one record."""
    block = encode_block(ids, size)
    table = b"".join(struct.pack("<?qq", doc is not None, doc or 0, n) for doc, n in docs)
    body = struct.pack(HEAD, MAGIC, size, file, place, len(docs), len(block)) + table + block
    return body + struct.pack("<I", zlib.crc32(body))


def records(content: bytes) -> Iterator[tuple[int, list[tuple[int | None, int]], np.ndarray]]:
    """(file, documents that begin here, ids) of every record of a file; ValueError if one is damaged."""
    at, expected = 0, 0
    while at < len(content):
        if len(content) - at < HEAD_SIZE:
            raise ValueError("a file of token ids ends inside a record")
        magic, size, file, place, count, length = struct.unpack_from(HEAD, content, at)
        body = content[at : at + HEAD_SIZE + 17 * count + length]
        close = content[at + len(body) : at + len(body) + 5]
        if magic != MAGIC or place != expected or close != struct.pack("<I", zlib.crc32(body)) + b"\n":
            raise ValueError("a record of token ids is damaged or out of place")
        table = struct.iter_unpack("<?qq", body[HEAD_SIZE : HEAD_SIZE + 17 * count])
        docs = [(doc if known else None, n) for known, doc, n in table]
        yield file, docs, decode_block(body[HEAD_SIZE + 17 * count :], size)
        at, expected = at + len(body) + 5, expected + 1


def _packed(size: int, block: int):
    """Records of the documents of a task, in their order."""
    kind = np.dtype("<u2" if size <= 1 << 16 else "<u4")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file, place = TaskContext.get().partitionId(), 0
        docs: list[tuple[int, int | None, int]] = []  # (where it begins, id, tokens)
        held: list[np.ndarray] = []
        count = 0

        def flush(least: int):
            nonlocal held, count, docs, place
            ids = np.concatenate(held) if held else np.zeros(0, kind)
            at = 0
            while len(ids) - at >= least and at < len(ids):
                stop = min(at + block, len(ids))
                own = [(doc, n) for begin, doc, n in docs if begin < stop]
                docs = docs[len(own) :]
                made = record(size, file, place, own, ids[at:stop])
                yield pa.RecordBatch.from_arrays([pa.array([made], pa.binary())], names=["record"])
                at, place = stop, place + 1
            docs = [(begin - at, doc, n) for begin, doc, n in docs]
            held, count = [ids[at:]], len(ids) - at

        for batch in batches:
            for doc, raw in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = np.frombuffer(raw.as_buffer(), kind)
                docs.append((count, doc, len(ids)))
                held.append(ids)
                count += len(ids)
                if count >= block:
                    yield from flush(block)
        yield from flush(1)

    return run


def write_token_files(
    docs: DataFrame,
    tokenizer_path: str,
    folder: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    end: int = 1,
    block: int = BLOCK,
    file_ids: int = FILE_IDS,
) -> None:
    """Write the token ids of every text and an end id, in ascending order of document ids.

    Null and empty texts have the end alone; a null id comes before all others; of repeated ids the
    order follows from a hash of their tokens. A text of any length is written whole, over as
    many blocks as it takes. An empty table gives a folder without records. ``file_ids`` is about
    how many ids a file has at the most, but for one long document. Other columns are ignored.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    slim = docs.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text")
    )
    schema = "doc_id long, row long, n long, ids binary"
    coded = stored(slim.mapInArrow(_coded(tokenizer_path, end), schema), "token-ids")
    total = coded.agg(F.sum("n")).first()[0] or 0
    order = ["doc_id", F.xxhash64("ids"), "row"]
    files = max(tasks_for(spark), -(-total // file_ids))
    ranged = coded.repartitionByRange(files, *order).sortWithinPartitions(*order).select("doc_id", "ids")
    made = ranged.mapInArrow(_packed(WordIds(tokenizer_path).size, block), "record binary")
    made.select(F.col("record").cast("string").alias("value")).write.text(folder)


def _documents(spelled: bool):
    """(file, doc_id, place, n_tokens, ids_crc32, ids) of the documents of every file."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                out: list[tuple] = []
                open_: list = []  # of the document that is being read: id, tokens, left, check sum, ids
                place, place_file = 0, 0
                for file, docs, ids in records(content.as_py()):
                    place_file, at, waiting = file, 0, iter(docs)
                    while at < len(ids):
                        if not open_:
                            doc, n = next(waiting)
                            open_ = [doc, n, n, 0, []]
                        own = ids[at : at + open_[2]]
                        open_[2] -= len(own)
                        open_[3] = zlib.crc32(own.tobytes(), open_[3])
                        if spelled:
                            open_[4].append(own)
                        at += len(own)
                        if not open_[2]:
                            doc, n, _, check, parts = open_
                            got = np.concatenate(parts).astype(np.int32) if spelled else None
                            out.append((file, doc, place, n, check, got))
                            place, open_ = place + n, []
                    if len(out) > 20_000 or spelled:
                        yield rows(out)
                        out = []
                if open_:
                    raise ValueError(f"file {place_file} of token ids ends inside a document")
                yield rows(out)

    def rows(out) -> pa.RecordBatch:
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32()))
        columns = list(zip(*out)) or [()] * 6
        names = ["file", "doc_id", "place", "n_tokens", "ids_crc32", "ids"]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    return run


def read_token_files(spark: SparkSession, folder: str, ids: bool = False) -> DataFrame:
    """Per document of a folder: ``doc_id``, ``start``, ``n_tokens``, ``ids_crc32`` and, if asked for, ``ids``.

    ``start`` is how many ids all documents before it have, in the order of the files; the check
    sum is that of the ids as little-endian 32-bit numbers. A damaged record fails the job.
    """
    bounded_batches(spark)
    files = spark.read.format("binaryFile").load(folder).select("content")
    schema = "file long, doc_id long, place long, n_tokens long, ids_crc32 long, ids array<int>"
    docs = stored(files.mapInArrow(_documents(ids), schema), "token-documents")
    totals = docs.groupBy("file").agg(F.sum("n_tokens").alias("n"))  # a row for every file
    before = F.sum("n").over(Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1))
    starts = totals.select("file", F.coalesce(before, F.lit(0).cast("long")).alias("first"))
    found = docs.join(starts, "file").withColumn("start", F.col("first") + F.col("place"))
    return found.select("doc_id", "start", "n_tokens", "ids_crc32", *(["ids"] if ids else []))
