"""Byte-pair encoding with forced boundaries, and decoding.

A pair of neighbouring bytes that occurs inside no vocabulary token can never be merged over, so
every such pair marks a certain cut. A word is split there, its fragments are merged one by one,
and their ids are put after one another. The vocabulary file is a parameter.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import unicodedata
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.llm.common import bounded_batches

CACHE = 150_000


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in byte-level vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters, free = [""] * 256, 256
    for b in range(256):
        if b in shown:
            letters[b] = chr(b)
        else:
            letters[b] = chr(free)
            free += 1
    return letters


def newer_letters() -> list[tuple[int, int]]:
    """Ranges of letters and numbers that the regex module knows and Python's own table does not."""
    points = regex.finditer(r"[\p{L}\p{N}]+", "".join(map(chr, range(0xD800))) + "".join(map(chr, range(0xE000, 0x110000))))
    ranges: list[tuple[int, int]] = []
    for c in (ord(c) for found in points for c in found.group()):
        if unicodedata.category(chr(c)) == "Cn":
            if ranges and ranges[-1][1] == c - 1:
                ranges[-1] = ranges[-1][0], c
            else:
                ranges.append((c, c))
    return ranges


def read_vocabulary(path: str) -> dict:
    """The parts of a tokenizer file that the encoder uses, checked to be of the kind it handles."""
    spec = json.loads(Path(path).read_text(encoding="utf-8"))
    model = spec["model"]
    steps = spec["normalizer"]["normalizers"]
    before, level = spec["pre_tokenizer"]["pretokenizers"]
    fit = (
        model["type"] == "BPE"
        and not any(model.get(k) for k in ("dropout", "unk_token", "byte_fallback", "ignore_merges", "continuing_subword_prefix"))
        and [s["type"] for s in steps] == ["NFC", "Replace", "Lowercase"]
        and (steps[1]["pattern"], steps[1]["content"]) == ({"Regex": r"\s+"}, " ")
        and (before["type"], before["behavior"], before["invert"]) == ("Split", "Removed", True)
        and (level["type"], level["add_prefix_space"], level["use_regex"]) == ("ByteLevel", False, False)
        and not any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in spec["added_tokens"])
        and spec["decoder"] is None
    )
    if not fit:
        raise ValueError(f"{path}: a tokenizer of another kind")
    return {
        "vocab": model["vocab"],
        "merges": [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]],
        "end": model["end_of_word_suffix"] or "",
        "word": before["pattern"]["Regex"],
        "newer": newer_letters(),
        "added": {t["content"]: t["id"] for t in spec["added_tokens"]},
    }


class Encoder:
    """Encodes texts to pieces: (ids, the ids as text, the tokens as text) for every word."""

    def __init__(self, parts: dict, cache: int = CACHE):
        vocab, end = parts["vocab"], parts["end"]
        names = vocab | parts["added"]
        self.names = {i: t for t, i in names.items()}
        self.added = {t: ((i,), str(i), t) for t, i in parts["added"].items()}
        self.joined = {}
        for rank, (left, right) in enumerate(parts["merges"]):
            if left in vocab and right in vocab and left + right in vocab:
                self.joined.setdefault((vocab[left], vocab[right]), (rank, vocab[left + right]))
        letters = byte_letters()
        self.first = [vocab.get(x) for x in letters]
        self.last = [vocab.get(x + end) for x in letters]
        self.inside = set()
        for token in vocab:
            body = token[: -len(end)] if end and token.endswith(end) and len(token) > len(end) else token
            symbols = [vocab.get(x) for x in body]
            if body != token:
                symbols[-1] = vocab.get(body[-1] + end)
            self.inside.update(zip(symbols, symbols[1:]))
        self.word = regex.compile(parts["word"])
        # Letters of Unicode versions that the tokenizer does not know are no letters to it.
        newer = "".join(f"{regex.escape(chr(a))}-{regex.escape(chr(b))}" for a, b in parts["newer"])
        known = parts["word"]
        for kind in (r"\p{L}", r"\p{N}"):
            known = known.replace(f"[{kind}]", kind).replace(kind, f"[{kind}--[{newer}]]" if newer else kind)
        self.careful = regex.compile(known, regex.V1)
        self.high = re.compile(f"[{chr(parts['newer'][0][0])}-\U0010ffff]") if newer else re.compile(r"(?!)")
        marks = sorted(self.added, key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, marks)) or r"(?!)")
        self.openers = {m[0] for m in marks}
        self.known, self.older, self.most = {}, {}, cache

    def fragments(self, symbols: list[int]) -> Iterator[list[int]]:
        """The symbols cut wherever a pair occurs inside no token."""
        inside, first = self.inside, 0
        for k, pair in enumerate(zip(symbols, symbols[1:]), 1):
            if pair not in inside:
                yield symbols[first:k]
                first = k
        yield symbols[first:] if first else symbols

    def merged(self, symbols: list[int]) -> list[int]:
        """Join the pair of the least rank, leftmost first, until no pair has a rank."""
        if len(symbols) > 64:
            return self._merged_long(symbols)
        joined = self.joined.get
        none = (1 << 40, 0)
        pairs = [joined(pair, none) for pair in zip(symbols, symbols[1:])]
        while pairs:
            best = min(pairs)
            if best is none:
                break
            k = pairs.index(best)
            symbols[k : k + 2] = [best[1]]
            del pairs[k]
            if k < len(pairs):
                pairs[k] = joined((symbols[k], symbols[k + 1]), none)
            if k:
                pairs[k - 1] = joined((symbols[k - 1], symbols[k]), none)
        return symbols

    def _merged_long(self, symbols: list[int]) -> list[int]:
        """The same with a heap over a linked list, for fragments of any length."""
        joined, size = self.joined, len(symbols)
        symbols, after, before = list(symbols), [*range(1, size), -1], [-1, *range(size - 1)]
        heap: list = []

        def push(k: int, n: int) -> None:
            found = joined.get((symbols[k], symbols[n]))
            if found:
                heapq.heappush(heap, (found[0], k, symbols[k], symbols[n], found[1]))

        for k in range(size - 1):
            push(k, k + 1)
        while heap:
            _, k, left, right, whole = heapq.heappop(heap)
            n = after[k]
            if symbols[k] != left or n < 0 or symbols[n] != right:
                continue
            symbols[k], symbols[n] = whole, None
            after[k] = m = after[n]
            if m >= 0:
                before[m] = k
                push(k, m)
            if before[k] >= 0:
                push(before[k], k)
        return [s for s in symbols if s is not None]

    def piece(self, word: str) -> tuple[tuple[int, ...], str, str]:
        """A word's ids. Words of up to 64 letters are remembered, the latest of them only."""
        found = self.older.get(word)
        if found is None:
            data = word.encode()
            symbols = [self.first[b] for b in data[:-1]]
            symbols.append(self.last[data[-1]])
            ids = [i for part in self.fragments(symbols) for i in self.merged(part)]
            found = tuple(ids), " ".join(map(str, ids)), " ".join([self.names[i] for i in ids])
        if len(word) <= 64:
            if len(self.known) >= self.most:
                self.known, self.older = {}, self.known
            self.known[word] = found
        return found

    def _plain(self, text: str) -> list:
        text = nfc(text)  # white space is in no word, so it need not be made one space
        # letter by letter where a whole text's lower case depends on where a letter stands
        text = text.lower() if "\u03a3" not in text else "".join(map(str.lower, text))
        words = (self.careful if self.high.search(text) else self.word).findall(text)
        return [self.known.get(word) or self.piece(word) for word in words]

    def pieces(self, text: str) -> list:
        if not any(opener in text for opener in self.openers):
            return self._plain(text)
        out, at = [], 0
        for found in self.special.finditer(text):
            out += self._plain(text[at : found.start()])
            out.append(self.added[found.group()])
            at = found.end()
        return out + self._plain(text[at:])

    def encode(self, text: str) -> list[int]:
        return [i for piece in self.pieces(text) for i in piece[0]]

    def decode(self, ids: list[int]) -> str:
        """The tokens of the ids with a space between, as a file without a decoder asks for."""
        names = self.names
        return " ".join([names[i] for i in ids])


def nfc(text: str) -> str:
    if text.isascii() or unicodedata.is_normalized("NFC", text):
        return text
    return unicodedata.normalize("NFC", text)


def _encode(parts, text_name: str, keep_ids: bool, digests: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # kept beside the vocabulary, a worker's later tasks find the words it has met
        encoder = parts.value.setdefault("encoder", None) or Encoder(parts.value)
        parts.value["encoder"] = encoder
        for batch in batches:
            column = pc.fill_null(batch.column(text_name), "")
            counts, lists, id_sums, text_sums = [], [], [], []
            for first in range(0, len(column), 256):
                for text in column.slice(first, 256).to_pylist():
                    pieces = encoder.pieces(text)
                    counts.append(sum([len(p[0]) for p in pieces]))
                    if keep_ids:
                        lists.append(pa.array([i for p in pieces for i in p[0]], pa.int32()))
                    if digests:
                        ids, decoded = " ".join([p[1] for p in pieces]), " ".join([p[2] for p in pieces])
                        id_sums.append(hashlib.sha256(ids.encode()).hexdigest())
                        text_sums.append(hashlib.sha256(decoded.encode()).hexdigest())
            more, names = [pa.array(counts, pa.int64())], ["n_tokens"]
            if keep_ids:
                ends = pa.array([0, *counts], pa.int32()).to_numpy().cumsum()
                flat = pa.concat_arrays([pa.array([], pa.int32()), *lists])
                more.append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat))
                names.append("ids")
            if digests:
                more += [pa.array(id_sums, pa.string()), pa.array(text_sums, pa.string())]
                names += ["ids_sha256", "decoded_sha256"]
            yield pa.RecordBatch.from_arrays([*batch.columns, *more], names=[*batch.schema.names, *names])

    return run


def encode_texts(
    docs: DataFrame, path: str, text_col: str = "text", ids: bool = True, digests: bool = False
) -> DataFrame:
    """``docs`` with ``n_tokens`` and, on request, ``ids`` and the two digests added.

    Ids equal those of the tokenizer file at ``path`` without special tokens put around the text,
    truncation or padding; strings of special tokens in a text become their ids. A null or empty
    text has no tokens. Columns of the added names are replaced. The digests are SHA-256 of the
    ids joined by spaces and of the decoded text. An empty table stays empty.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    added = {"n_tokens": "long"}
    added |= {"ids": "array<int>"} if ids else {}
    added |= {"ids_sha256": "string", "decoded_sha256": "string"} if digests else {}
    rows = docs.select(*(f"`{c}`" for c in docs.columns if c not in added))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    schema += "".join(f", {k} {v}" for k, v in added.items())
    parts = spark.sparkContext.broadcast(read_vocabulary(path))
    return rows.mapInArrow(_encode(parts, text_col, ids, digests), schema)


def decode_ids(docs: DataFrame, path: str, ids_col: str = "ids") -> DataFrame:
    """``docs`` with ``decoded`` added: the tokens of the ids, joined by spaces; null for null."""
    spark = docs.sparkSession
    parts = spark.sparkContext.broadcast(read_vocabulary(path))

    def run(batches):
        encoder = Encoder(parts.value)
        for batch in batches:
            texts = [None if x is None else encoder.decode(x) for x in batch.column(ids_col).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(texts, pa.string())], names=[*batch.schema.names, "decoded"]
            )

    rows = docs.drop("decoded")
    return rows.mapInArrow(run, T.StructType([*rows.schema, T.StructField("decoded", T.StringType())]))
