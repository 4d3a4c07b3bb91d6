"""Alignment, token files and spelling variants against plain versions of their rules."""

import hashlib
import os
import re
import sys
import zlib
from collections import Counter, defaultdict
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tablewright.llm import alignment, queries, range_coder, spelling, token_files

LEFT, RIGHT, WORDS = (queries.tokenizer(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model", "word_bpe_49k.json"))
ODD = [
    "One two  three", " led by a space", "a\nb\tc ", "café naïve \U0001f600\U0001f468‍\U0001f469 €5 你好 世界", "x<s>y <0x41> <|endoftext|>",
    "joined▁word", "▁", " ", "", None, "é ́x   nbsp　wide", "word " * 3000, "z" * 5000, "It's 12345 o'clock!!!",
    "tab\x00nul \x1c sep", "<|startoftext|>mid<|endoftext|> end",
]


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls in every column, odd and long texts, repeated rows and ids, names used inside operators."""
    rows = [(k, text, "x", k) for k, text in enumerate(ODD)] + [(None, "One two  three", None, None), (3, ODD[3], "x", 3)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, N_A string, file int").withColumn("n", F.lit("n"))


def plain_alignment(texts):
    import sentencepiece
    from tokenizers import Tokenizer

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    both = alignment.Aligner(LEFT, RIGHT)
    left, right = Tokenizer.from_file(LEFT), sentencepiece.SentencePieceProcessor(model_file=RIGHT)
    left.encode_special_tokens = True
    out, links, count = [], [], Counter()
    for text in texts:
        a = left.encode(" " + text, add_special_tokens=False).ids if text else []
        b = right.encode(text) if text else []
        a_bytes, b_bytes = [both.left_bytes[k] for k in a], [both.right_bytes[k] for k in b]
        if not text or not b"".join(a_bytes) == b"".join(b_bytes) == (" " + text).encode():
            a, b, a_bytes, b_bytes = [], [], [], []
        a_ends, b_ends = np.cumsum([len(x) for x in a_bytes]).tolist(), np.cumsum([len(x) for x in b_bytes]).tolist()
        cuts, groups, low = sorted(set(a_ends) & set(b_ends)), [], (0, 0)
        links.append([])
        for cut in cuts:
            upto = a_ends.index(cut, low[0]) + 1, b_ends.index(cut, low[1]) + 1
            groups.append(",".join(map(str, a[low[0] : upto[0]])) + "|" + ",".join(map(str, b[low[1] : upto[1]])))
            links[-1].append((a[upto[0] - 1], b[upto[1] - 1]))
            low = upto
        count.update(links[-1])
        written = ";".join(groups)
        out.append([len(a), len(b), len(groups), len(cuts), hashlib.sha256(written.encode()).hexdigest() if a else "", written])
    best = defaultdict(int)
    for (_, b), c in count.items():
        best[b] = max(best[b], c)
    sums = [(sum(count[x] == best[x[1]] for x in own), sum(count[x] for x in own)) for own in links]
    return [(*x[:4], *y, *x[4:]) for x, y in zip(out, sums)]


@pytest.mark.parametrize("share", [alignment.HEAD_SHARE, 0.01, 2.0])
def test_alignment_equals_plain(odd, share):
    """However many pairs are sent out, none of them or all."""
    rows = odd.collect()
    want = Counter((r["doc_id"], r["file"], *x) for r, x in zip(rows, plain_alignment([r["text"] for r in rows])))
    made = alignment.align_texts(odd, LEFT, RIGHT, spelled=True, head_share=share)
    assert made.columns == ["doc_id", "file", "n", *alignment.ADDED]  # N_A is replaced by n_a
    assert Counter(tuple(r) for r in made.drop("n").collect()) == want


def test_alignment_of_parts_equals_that_of_whole_texts():
    cut, whole = alignment.Aligner(LEFT, RIGHT), alignment.Aligner(LEFT, RIGHT)
    whole.cuts = False
    texts = [text for text in ODD if text]
    for x, y in zip(cut.texts(texts), whole.texts(texts)):
        assert x[:4] == y[:4] and np.array_equal(x[4], y[4])


def test_alignment_of_nothing(odd):
    assert alignment.align_texts(odd.limit(0), LEFT, RIGHT).isEmpty()


def test_spans_are_refined_inside_characters():
    spans = np.array([(0, 2), (2, 6), (2, 6), (6, 7)])
    assert alignment.refined(spans, np.array([2, 3, 1, 1])).tolist() == [2, 5, 6, 7]


# range coder and token files


@settings(max_examples=25, deadline=None)
@given(st.lists(st.integers(0, 299), max_size=900), st.integers(300, 70000))
def test_blocks_come_back(ids, size):
    ids = np.array([*ids, size - 1, 0, size - 1], np.uint32)
    assert np.array_equal(range_coder.decode_block(range_coder.encode_block(ids, size), size), ids)


@pytest.mark.parametrize("ids", [np.zeros(70_000), np.arange(49_408), np.random.default_rng(3).integers(0, 49_408, 70_000), np.tile([5, 6, 7, 49_407], 9_000)])
def test_even_and_uneven_ids_come_back(ids):
    ids = ids.astype(np.uint32)
    block = range_coder.encode_block(ids, 49_408)
    assert np.array_equal(range_coder.decode_block(block, 49_408), ids)
    if len(np.unique(ids)) < 5:
        assert len(block) < len(ids) / 4


def test_damage_is_seen():
    block = range_coder.encode_block(np.arange(500), 600)
    for at in (0, 5, 20, len(block) // 2, len(block) - 1):
        with pytest.raises(ValueError):
            range_coder.decode_block(block[:at] + bytes([block[at] ^ 1]) + block[at + 1 :], 600)
    with pytest.raises(ValueError):
        range_coder.decode_block(block[:-1], 600)
    content = b"".join(token_files.record(600, 4, k, [(k, 100)], np.arange(100)) + b"\n" for k in range(3))
    assert [(f, d) for f, d, _ in token_files.records(content)] == [(4, [(k, 100)]) for k in range(3)]
    for broken in (content[:-1], content[5:], content[: len(content) // 2], content[: len(content) // 3] * 2):
        with pytest.raises(ValueError):
            list(token_files.records(broken))


def test_words_have_the_ids_of_whole_texts():
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(WORDS)
    texts = [text or "" for text in ODD]
    found = token_files.WordIds(WORDS)(texts)
    assert [np.frombuffer(x, "<u2").tolist() for x in found] == [whole.encode(t, add_special_tokens=False).ids for t in texts]


def test_plain_words_need_the_model_only():
    """Cut here, a new word of plain characters is not handed to the library's whole pipeline, and has its ids."""
    from tokenizers import Tokenizer

    class Closed:
        def encode_batch_fast(self, words, **_):
            assert not words
            return []

    whole, words = Tokenizer.from_file(WORDS), token_files.WordIds(WORDS)
    letters = [chr(c) for c in range(0xC0, 0x100) if c not in (0xD7, 0xF7)]
    texts = ["Hello, (WORLD)! x9y12.", "".join(letters), " ".join(f"a{c}B." for c in letters), "ab<|cd|> ##--12", ""]
    words.tokenizer = Closed()
    found = words(texts)
    assert [np.frombuffer(x, "<u2").tolist() for x in found] == [whole.encode(t, add_special_tokens=False).ids for t in texts]
    others = ["don't 'start' s's9", "e\u0301 >\u0338 \u00b5\u00aa \u00d7\u00f7", "a<|endoftext|>b", "\u03a3\u0391\u03a3 \u0130 \u1e9e"]
    words = token_files.WordIds(WORDS)
    ids, ends = words.column(pa.array([*others, None]), end=1)
    expected = [whole.encode(t, add_special_tokens=False).ids + [1] for t in [*others, ""]]
    assert [x.tolist() for x in np.split(ids, ends[:-1])] == expected


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(st.sampled_from("aBz \u00c9\u00e9\u00df\u00ff\u00d7\u00f7'\u2019 \t\n\r\x0b\x00\u00a01\u00b2<|>-_\u0301\u0130"), max_size=12) | st.just("<|endoftext|>B")))
def test_runs_of_any_characters_have_the_ids_of_whole_texts(texts):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(WORDS)
    found = word_ids()(texts)
    assert [np.frombuffer(x, "<u2").tolist() for x in found] == [whole.encode(t, add_special_tokens=False).ids for t in texts]


@lru_cache
def word_ids():
    return token_files.WordIds(WORDS)


def test_new_words_of_known_runs_cost_no_calls():
    """Words are cut by arrays: thousands of new ones, all of a few runs, make no calls for each of them."""
    names = [a + b for a in "bcdfghjklm" for b in "aeiouy"]
    texts = pa.array([" ".join(f"{a}-{b}" for a in names for b in names)])
    words, calls = token_files.WordIds(WORDS), 0

    def count(frame, event, of):
        nonlocal calls
        calls += event in ("call", "c_call")

    sys.setprofile(count)
    try:
        ids, ends = words.column(texts)
    finally:
        sys.setprofile(None)
    assert ends.tolist() == [len(ids)] and len(ids) >= 3 * len(names) ** 2
    assert calls < len(names) ** 2 / 4


def test_few_kept_runs_give_the_same_ids(monkeypatch):
    """Long runs are not kept, and others are forgotten from time to time."""
    texts = [text or "" for text in ODD] * 3
    expected = token_files.WordIds(WORDS)(texts)
    for name, value in (("KEPT_RUNS", 5), ("KEPT_LENGTH", 3), ("PIECE", 20)):
        monkeypatch.setattr(token_files, name, value)
    assert token_files.WordIds(WORDS)(texts) == expected


def test_sums_of_frequencies_are_not_renewed_in_each_step(monkeypatch):
    """Blocks come back, hardly longer than their ids' entropy, with a sum over the vocabulary in few of the steps."""
    share = 1 / np.arange(1, 5001)
    share /= share.sum()
    ids = np.random.default_rng(5).choice(5000, 300_000, p=share).astype(np.uint32)
    sums, cumsum = [], np.cumsum
    monkeypatch.setattr(np, "cumsum", lambda a, *args, **kw: sums.append(len(a)) or cumsum(a, *args, **kw))
    block = range_coder.encode_block(ids, 49_408)
    assert sums.count(49_408) < range_coder.LANE / 3
    assert np.array_equal(range_coder.decode_block(block, 49_408), ids)
    assert 8 * len(block) < 1.08 * len(ids) * -(share * np.log2(share)).sum()


@pytest.mark.parametrize("block, file_ids", [(range_coder.BLOCK, token_files.FILE_IDS), (100, 500)])
def test_token_files_come_back(spark, odd, tmp_path, block, file_ids):
    """Documents over many blocks, files of many documents, and empty files."""
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(WORDS)
    folder = str(tmp_path / "files")
    token_files.write_token_files(odd, WORDS, folder, block=block, file_ids=file_ids)
    got = sorted(token_files.read_token_files(spark, folder, ids=True).collect(), key=lambda r: r["start"])
    rows = {r["doc_id"]: r["text"] or "" for r in odd.collect()}
    assert [r["doc_id"] for r in got] == [None, 0, 1, 2, 3, 3, *range(4, len(ODD))]
    start = 0
    for r in got:
        ids = whole.encode(rows[r["doc_id"]], add_special_tokens=False).ids + [1]
        assert (r["start"], r["n_tokens"], r["ids"]) == (start, len(ids), ids)
        assert r["ids_crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)


def test_token_files_of_nothing(spark, odd, tmp_path):
    folder = str(tmp_path / "files")
    token_files.write_token_files(odd.limit(0), WORDS, folder)
    assert token_files.read_token_files(spark, folder).isEmpty()


# spelling


def plain_variants(rows, least, shortest, ratio, drop_every):
    count = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.encode().lower().decode()
            h = zlib.crc32(f"{'null' if doc is None else doc}:{run}".encode())
            if drop_every and h % drop_every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            count[run] += 1
    count = {w: n for w, n in count.items() if len(w) >= shortest and n >= least}
    gaps = defaultdict(set)
    for w in count:
        for i in range(len(w)):
            gaps[w[:i], w[i + 1 :]].add(w)
    near = defaultdict(set)
    for w in count:
        for i in range(len(w)):
            near[w] |= gaps[w[:i], w[i + 1 :]] - {w}
            if (less := w[:i] + w[i + 1 :]) in count:
                near[w].add(less)
                near[less].add(w)
    form = {}
    for w in count:
        best = min(near[w], key=lambda v: (-count[v], v), default=None)
        form[w] = best if best and count[best] >= ratio * count[w] else None
    out = set()
    for w in count:
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, count[w], len(near[w]), count.get(form[w])))
    return out


@pytest.mark.parametrize("drop_every", [0, 3])
def test_variants_equal_plain(spark, drop_every):
    """Short words over few letters: shared prefixes over range bounds, runs of a letter, ties."""
    rng = np.random.default_rng(11)
    words = ["".join(rng.choice(list("abé"), rng.integers(1, 8))) for _ in range(4000)]
    rows = [(int(k), " ".join(words[40 * k : 40 * k + 40])) for k in range(100)]
    rows += [(None, "aab AAB aabb"), (7, None), (8, ""), (9, "Éaab éaab"), (10, "q" * 3000 + " " + "q" * 2999), (10, "q" * 3000)]
    docs = spark.createDataFrame([(d, t, "x") for d, t in rows], "doc_id bigint, text string, number string")
    got = spelling.spelling_variants(docs, least=1, shortest=2, drop_every=drop_every)
    assert {tuple(r) for r in got.collect()} == plain_variants(rows, 1, 2, 2, drop_every)


def test_nodes_are_equal_for_equal_prefixes_only(spark):
    rng = np.random.default_rng(2)
    words = sorted({"x" * int(rng.integers(0, 30)) + "".join(rng.choice(list("ab"), 4)) for _ in range(600)})
    frame = spark.createDataFrame([(w,) for w in words], "word string").repartition(7)
    seen, numbers = defaultdict(set), []
    for r in spelling.trie_nodes(frame, "word", "test").collect():
        numbers.append((r["number"], r["key"]))
        for size, node in enumerate(r["nodes"]):
            seen[r["key"][:size]].add(node)
    assert all(len(nodes) == 1 for nodes in seen.values())
    assert len({next(iter(nodes)) for nodes in seen.values()}) == len(seen)
    assert [w for _, w in sorted(numbers)] == words


def test_variants_of_nothing(odd):
    assert spelling.spelling_variants(odd.limit(0)).isEmpty()
    with pytest.raises(ValueError):
        spelling.spelling_variants(odd, ratio=1)


def test_contract_columns(spark, small):
    """The registered queries against the plain versions, over all documents."""
    rows = [tuple(r) for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()]
    got = {tuple(r) for r in queries.op13_spelling_variants(spark, small).collect()}
    assert got == plain_variants(rows, 3, 5, 2, 97)
    want = {(d, *x[:7]) for (d, _), x in zip(rows, plain_alignment([t for _, t in rows]))}
    assert {tuple(r) for r in queries.op11_tokenizer_alignment(spark, small).collect()} == want
