"""Set-similarity self-join on word shingles by universe partition, with exact verification.

Let r be the smaller and s the larger of two sets whose Jaccard similarity reaches p per cent.
Then |s| <= |r| * 100 / p, and at most H = |r| * (100 - p) / p tokens lie in one set only. The
universe of token hashes is cut into m = H + 1 segments, H taken for the size band of r, so some
segment of the two sets is equal. Each set is indexed by the hash of every segment's subset.

Cost-based allocation. A subset made of heavy tokens only (those in many documents; the empty
subset is one of these) has a long list, so it is skipped, and skipping is paid for elsewhere. A
set with k skipped segments also indexes one-deletion neighbourhoods (the subset less any one
token) on its leading segments, as many as hold k subsets with two or more tokens that are not
heavy. If r and s agree on c skipped segments and on no other, the other m - c segments hold at
most m - 1 differences, so fewer than c of them hold two or more; c <= k for either set, so among
the leading segments of the set whose lead is shorter, one differs by a single token, and its
shorter form is in both indexes. A set with too few such subsets indexes every subset and every
neighbourhood; two such sets meet on the subsets that the others skip.

Verification. A bucket is never expanded into all pairs: its members are verified against its
best connected member. Buckets that still hold more than one component are split by the rarest
tokens of their members (``open_pairs``), and only what meets there is paired, where sizes and parity
sketches still allow the similarity. All pairs are verified on whole sets, so components are exact.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablewright.llm.common import WordHasher, ascii_space, bounded_batches, chunks, mix, stored
from tablewright.operators.graph import connected_components

WIDEN = 1.5  # size ratio of a band; wider bands mean more segments, narrower ones more lookups
HEAVY_SHARE = 0.002  # a token in more than this share of the documents is heavy
SKETCH = 256  # bits of the parity sketch
PART_BITS = 40  # of an entry that the first count looks at
CLASS = 1.05  # size ratio of a class in which rare tokens are compared


class Shingles:
    """The set of shingle hashes of every text in an Arrow column."""

    def __init__(self, width: int):
        self.width = width
        self.words = WordHasher(~ascii_space())
        places = mix(np.arange(1, width + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        self.factors = places | np.uint64(1)

    def __call__(self, column: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
        """(row, sorted distinct hashes); a text of fewer words is one shingle, none are none."""
        for first, _, data, offsets in chunks(column):
            words, rows = self.words(data, offsets)
            size = len(words) - self.width + 1
            hashes = np.zeros(max(size, 0), np.uint64)
            for k, factor in enumerate(self.factors if size > 0 else ()):
                hashes += words[k : k + size] * factor
            hashes = mix(hashes)
            for k, (a, b) in enumerate(zip(rows[:-1].tolist(), rows[1:].tolist())):
                if b - a >= self.width:
                    own = np.sort(hashes[a : b - self.width + 1])
                    keep = np.empty(len(own), bool)
                    keep[0] = True
                    np.not_equal(own[1:], own[:-1], out=keep[1:])
                    yield first + k, own[keep]
                elif b > a:
                    whole = (words[a:b] * self.factors[: b - a]).sum(dtype=np.uint64)
                    yield first + k, mix(np.array([whole + np.uint64(b - a)], np.uint64))
                else:
                    yield first + k, np.zeros(0, np.uint64)


def bands(percent: int, largest: int) -> list[tuple[int, int, int]]:
    """(least size, greatest size, segments) of the bands up to ``largest``.

    Sets below the first band have only equal partners. A partner is in the same band as the
    smaller set or in the next one.
    """
    out, low = [], -(-percent // (100 - percent))
    while low <= largest:
        follow = max(low * 100 // percent + 1, int(low * WIDEN) + 1)
        out.append((low, follow - 1, (follow - 1) * (100 - percent) // percent + 1))
        low = follow
    return out


def allocation(tokens: np.ndarray, light: np.ndarray, band: int, segments: int) -> np.ndarray:
    """The index entries of one set (sorted hashes; ``light``: not heavy) in one band."""
    codes = mix(tokens ^ np.uint64(0x5851F42D4C957F2D))
    place = ((tokens >> np.uint64(32)) * np.uint64(segments)) >> np.uint64(32)
    cuts = np.searchsorted(place, np.arange(segments + 1, dtype=np.uint64))
    sums = np.zeros(len(tokens) + 1, np.uint64)
    np.cumsum(codes, out=sums[1:])
    lights = np.zeros(len(tokens) + 1, np.int64)
    np.cumsum(light, out=lights[1:])
    subset = sums[cuts[1:]] - sums[cuts[:-1]]
    salt = mix(np.arange(segments, dtype=np.uint64) + np.uint64((band + 1) << 32))
    count = lights[cuts[1:]] - lights[cuts[:-1]]
    skipped = count == 0
    entries = subset + salt
    k = int(skipped.sum())
    if not k:
        return mix(entries)
    wide = count >= 2
    reach = np.cumsum(wide)
    enough = reach[-1] >= k
    if enough:
        wide &= np.arange(segments) <= np.searchsorted(reach, k)
    segment = np.repeat(np.arange(segments), np.diff(cuts))
    near = (entries[segment] - codes)[wide[segment]]
    return mix(np.concatenate([entries[~skipped] if enough else entries, near]))


def signed(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64))


def sketch(tokens: np.ndarray) -> np.ndarray:
    """Parity of the number of tokens in each of 256 classes, as four numbers."""
    parity = np.bincount((tokens & np.uint64(SKETCH - 1)).astype(np.int64), minlength=SKETCH) & 1
    return np.packbits(parity.astype(np.uint8)).view(np.uint64)


def _profiles(width: int):
    """Per row: id, set size, set key, sketch. Per batch: the tokens that are frequent in it."""
    names = ("doc_id", "n", "k0", "k1", "s0", "s1", "s2", "s3", "token", "seen")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingles(width)
        for batch in batches:
            sizes, keys, sketches, held = [], [], [], []
            for _, tokens in shingles(batch.column(1)):
                codes = mix(tokens)
                sizes.append(len(tokens))
                keys.append((codes.sum(dtype=np.uint64), np.bitwise_xor.reduce(mix(codes + np.uint64(7)))))
                sketches.append(sketch(tokens))
                held.append(tokens)
            if not sizes:
                continue
            keys, sketches = np.array(keys, np.uint64), np.array(sketches, np.uint64)
            nothing = pa.nulls(len(sizes), pa.int64())
            columns = [batch.column(0), pa.array(sizes, pa.int64()), *map(signed, keys.T), *map(signed, sketches.T)]
            yield pa.RecordBatch.from_arrays([*columns, nothing, nothing], names=list(names))
            tokens, seen = np.unique(np.concatenate(held), return_counts=True)
            often = seen > max(3, HEAVY_SHARE * len(sizes))
            nothing = pa.nulls(int(often.sum()), pa.int64())
            found = [signed(tokens[often]), pa.array(seen[often], pa.int64())]
            yield pa.RecordBatch.from_arrays([*[nothing] * 8, *found], names=list(names))

    return run, ", ".join(f"{n} long" for n in names)


def _entries(width: int, percent: int, heavy):
    """(entry, id) of every set with a size at which it can have an unequal partner."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingles(width)
        known = np.frombuffer(heavy.value, np.uint64)
        levels = bands(percent, 1 << 30)
        lows = np.array([low for low, _, _ in levels])
        for batch in batches:
            ids = batch.column(0).to_pylist()
            out, owners, sizes, held = [], [], [], 0
            for row, tokens in shingles(batch.column(1)):
                at = int(np.searchsorted(lows, len(tokens), "right")) - 1
                if at < 0 or ids[row] is None:
                    continue
                light = np.ones(len(tokens), bool)
                if len(known):
                    near = np.minimum(np.searchsorted(known, tokens), len(known) - 1)
                    light = known[near] != tokens
                for band in (at, at - 1):
                    if band == at or band >= 0 and len(tokens) <= levels[band][1] * 100 // percent:
                        found = allocation(tokens, light, band, levels[band][2])
                        out.append(found)
                        owners.append(ids[row])
                        sizes.append(len(found))
                        held += len(found)
                if held > 200_000:
                    yield _rows(out, owners, sizes)
                    out, owners, sizes, held = [], [], [], 0
            if out:
                yield _rows(out, owners, sizes)

    return run


def _rows(out, owners, sizes) -> pa.RecordBatch:
    ids = np.repeat(np.array(owners, np.int64), sizes)
    return pa.RecordBatch.from_arrays([signed(np.concatenate(out)), pa.array(ids)], names=["entry", "doc_id"])


def _verified(width: int, percent: int):
    """Of (a, text a, b, text b) the pairs whose whole sets reach the similarity."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingles(width)
        for batch in batches:
            for first in range(0, batch.num_rows, 512):
                part = batch.slice(first, 512)
                left = [t for _, t in shingles(part.column(1))]
                right = [t for _, t in shingles(part.column(3))]
                keep = []
                for x, y in zip(left, right):
                    both = len(np.intersect1d(x, y, assume_unique=True))
                    keep.append(both > 0 and 100 * both >= percent * (len(x) + len(y) - both))
                yield part.select([0, 2]).filter(pa.array(keep, pa.bool_()))

    return run


def possible(percent: int) -> Column:
    """True where sizes and sketches of ``x`` and ``y`` leave the similarity possible."""
    apart = [F.bit_count(F.col(f"x.s{k}").bitwiseXOR(F.col(f"y.s{k}"))) for k in range(4)]
    small, large = F.least("x.n", "y.n"), F.greatest("x.n", "y.n")
    differ = reduce(lambda a, b: a + b, apart)
    return (large * percent <= small * 100) & (
        differ * (100 + percent) <= (small + large) * (100 - percent)
    )


def shingle_components(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    width: int = 5,
    percent: int = 80,
) -> DataFrame:
    """One row per input row: ``doc_id``, ``n_shingles``, ``component_id``.

    Words are runs of bytes other than ASCII white space, A-Z lower-cased. A text's set is its
    distinct ``width``-word shingles; with fewer words, the whole sequence is one shingle. Sets
    link when 100 * intersection >= ``percent`` * union; ``component_id`` is the smallest id
    reachable over links. Null texts and texts without words are empty and linked with nothing.
    Rows of one id count as one document; a null id is linked with nothing and has a null
    component. An empty table gives no rows. Other columns are ignored. Shingles are compared by
    64-bit hashes.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    make, schema = _profiles(width)
    profiles = stored(slim.mapInArrow(make, schema), "jaccard-profiles")
    heavy = heavy_tokens(profiles)
    members = stored(represented(profiles.filter("n IS NOT NULL")), "jaccard-members")
    sets = members.filter("n > 0 AND doc_id IS NOT NULL")

    entries = slim.mapInArrow(
        _entries(width, percent, spark.sparkContext.broadcast(heavy)), "entry long, doc_id long"
    )
    # Each table of keys is written before it is joined, so that hot keys of the other side split.
    # The first count is of the entries' leading bits, which take less room in the shuffle; an entry that only
    # shares these with others is alone in its bucket and goes with the degrees below.
    shared = stored(
        entries.groupBy(leading_bits(F.col("entry")).alias("part"))
        .agg(F.count(F.lit(1)).alias("c"))
        .filter("c > 1")
        .select("part"),
        "jaccard-shared",
    )
    often = entries.join(shared, leading_bits(F.col("entry")) == F.col("part"))
    index = stored(
        often.join(sets.select("doc_id", "rep"), "doc_id").select("entry", "rep").distinct(), "jaccard-index"
    )
    sets = sets.filter("doc_id = rep").select("rep", "n", "s0", "s1", "s2", "s3").distinct()
    degree = index.groupBy("entry").agg(F.count(F.lit(1)).alias("c")).filter("c > 1")
    index = stored(index.join(stored(degree, "jaccard-degree"), "entry"), "jaccard-index")
    weight = index.groupBy("rep").agg(F.sum("c").alias("w"))
    hubs = stored(
        index.join(weight, "rep")
        .groupBy("entry")
        .agg(F.max(F.struct("w", -F.col("rep"))).alias("best"))
        .select("entry", (-F.col("best.col2")).alias("hub")),
        "jaccard-hubs",
    )
    stars = index.join(hubs, "entry").filter("rep <> hub").select(F.col("rep").alias("b"), F.col("hub").alias("a"))
    links = stored(verify(stars.distinct(), sets, slim, width, percent), "jaccard-links")

    first = stored(connected_components(links.toDF("src", "dst")), "jaccard-components")
    missed = stored(
        verify(open_pairs(index, first, sets, slim, width, percent), sets, slim, width, percent), "jaccard-links"
    )
    found = first if missed.isEmpty() else connected_components(links.union(missed).toDF("src", "dst"))
    found = stored(found.toDF("rep", "component_id"), "jaccard-components")
    return members.join(found, "rep", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "rep").alias("component_id")
    )


def leading_bits(entry: Column) -> Column:
    """The first ``PART_BITS`` of an entry."""
    return F.shiftrightunsigned(entry, 64 - PART_BITS)


def represented(members: DataFrame) -> DataFrame:
    """Each row with ``rep``, the least id of the documents that have its set; empty sets stand alone."""
    key = ["n", "k0", "k1"]
    reps = stored(
        members.filter("n > 0").groupBy(*key).agg(F.min("doc_id").alias("__rep")), "jaccard-classes"
    )
    rep = F.when(F.col("doc_id").isNotNull(), F.coalesce("__rep", "doc_id")).alias("rep")
    return members.join(reps, key, "left").select("doc_id", "n", "s0", "s1", "s2", "s3", rep)


def heavy_tokens(profiles: DataFrame) -> bytes:
    """The tokens in more than a share of all documents, as sorted 64-bit numbers.

    Counted over all documents, batch by batch. There can be no more of them than the average
    set has tokens, divided by the share, however many documents there are.
    """
    count = profiles.filter("n IS NOT NULL").count()
    rows = (
        profiles.filter("token IS NOT NULL")
        .groupBy("token")
        .agg(F.sum("seen").alias("seen"))
        .filter(F.col("seen") > max(3.0, HEAVY_SHARE * count))
        .select("token")
        .toArrow()
    )
    return np.sort(rows["token"].to_numpy().view(np.uint64)).tobytes()


def verify(pairs: DataFrame, sets: DataFrame, docs: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose whole texts reach the similarity."""
    texts = docs.select("doc_id", "text")
    near = (
        pairs.alias("p")
        .join(sets.alias("x"), F.col("p.a") == F.col("x.rep"))
        .join(sets.alias("y"), F.col("p.b") == F.col("y.rep"))
        .filter(possible(percent))
        .select("p.a", "p.b")
    )
    other = near.join(texts, near.b == texts.doc_id).select("a", "b", F.col("text").alias("text_b"))
    both = other.join(texts, other.a == texts.doc_id).select("a", "text", "b", "text_b")
    return both.mapInArrow(_verified(width, percent), "a long, b long")


def _hashes(width: int):
    """(rep, token) of whole sets, from (doc_id, text) rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingles(width)
        for batch in batches:
            ids = batch.column(0).to_pylist()
            out, owners, sizes, held = [], [], [], 0
            for row, tokens in shingles(batch.column(1)):
                out.append(tokens)
                owners.append(ids[row])
                sizes.append(len(tokens))
                held += len(tokens)
                if held > 200_000:
                    yield _rows(out, owners, sizes)
                    out, owners, sizes, held = [], [], [], 0
            if out:
                yield _rows(out, owners, sizes)

    return run


def size_class(n: Column) -> Column:
    return F.floor(F.log(n.cast("double")) / F.lit(math.log(CLASS)))


def mixed_members(index: DataFrame, components: DataFrame) -> DataFrame:
    """(rep, component) of the members of buckets that hold more than one component."""
    known = components.select(F.col("id").alias("rep"), "component")
    placed = index.select("entry", "rep").join(known, "rep", "left")
    placed = placed.select("entry", "rep", F.coalesce("component", "rep").alias("component"))
    mixed = (
        placed.groupBy("entry")
        .agg(F.min("component").alias("low"), F.max("component").alias("high"))
        .filter("low <> high")
        .select("entry")
    )
    return placed.join(stored(mixed, "jaccard-mixed"), "entry", "left_semi").select("rep", "component").distinct()


def open_pairs(
    index: DataFrame, components: DataFrame, sets: DataFrame, docs: DataFrame, width: int, percent: int
) -> DataFrame:
    """Pairs that share a bucket and no component, as far as their rarest tokens let them be similar.

    Mixed buckets are split before any pair is made. Their members' tokens are ordered by how many
    members hold them. Sets of sizes a <= b are similar only if they share at least
    o = percent * (a + b) / (100 + percent) tokens, so the first a - o + 1 of the one and the first
    b - o + 1 of the other have one in common. A set is listed under these rare tokens, by the size class
    of the smaller set, and only sets that meet there are paired. Sets that share much but not
    enough, such as changed copies of one text, have rare tokens of their own and do not meet.
    """
    hard = stored(mixed_members(index, components).join(sets, "rep"), "jaccard-hard")
    texts = docs.join(hard.select(F.col("rep").alias("doc_id")), "doc_id", "left_semi").dropDuplicates(["doc_id"])
    tokens = stored(
        texts.mapInArrow(_hashes(width), "entry long, doc_id long").toDF("token", "rep"), "jaccard-tokens"
    )
    # Tokens that one member holds come first and are joined with nothing: they only take up places.
    counts = stored(
        tokens.groupBy("token").agg(F.count(F.lit(1)).alias("c")).filter("c > 1"), "jaccard-token-counts"
    )
    often = tokens.join(counts, "token")
    several = often.groupBy("rep").agg(F.count(F.lit(1)).alias("several"))
    sized = often.join(several, "rep").join(hard.select("rep", "n", "component"), "rep")
    place = F.row_number().over(Window.partitionBy("rep").orderBy("c", "token")) + F.col("n") - F.col("several")

    def first(other: Column) -> Column:
        """How many of the rarest tokens count beside a set of that size."""
        share = F.ceil((F.col("n") + other) * F.lit(percent) / F.lit(100 + percent))
        return F.col("n") - share + 1

    least = F.ceil(F.col("n") * F.lit(percent) / F.lit(100))
    placed = sized.withColumn("place", place).filter(F.col("place") <= first(least))
    placed = stored(placed.select("token", "rep", "n", "component", "place"), "jaccard-rare")
    small = placed.filter(F.col("place") <= first(F.col("n"))).withColumn("class", size_class(F.col("n")))
    classes = F.sequence(size_class(least), size_class(F.col("n")))
    large = placed.withColumn("class", F.explode(classes))
    # one below the smallest size of the class: rounding must never shorten a prefix
    lower = F.greatest(least, F.floor(F.pow(F.lit(CLASS), F.col("class"))) - 1)
    large = large.filter(F.col("place") <= first(lower))
    names = ("token", "class", "rep", "n", "component")
    role = F.lit(0).alias("role"), F.lit(1).alias("role")
    listed = stored(small.select(*names, role[0]).unionByName(large.select(*names, role[1])), "jaccard-listed")
    # As before, the largest component of a list is only compared with what stands outside it.
    largest = stored(
        listed.groupBy("token", "class", "component")
        .agg(F.count(F.lit(1)).alias("c"))
        .groupBy("token", "class")
        .agg(F.max(F.struct("c", "component")).alias("top"), F.count(F.lit(1)).alias("parts"))
        .filter("parts > 1")
        .select("token", "class", F.col("top.component").alias("major")),
        "jaccard-largest",
    )
    listed = listed.join(largest, ["token", "class"])
    outside = F.col("component") != F.col("major")
    small, large = listed.filter("role = 0"), listed.filter("role = 1")
    pairs = None
    for one, other in ((small.filter(outside), large), (small.filter(~outside), large.filter(outside))):
        x, y = one.alias("x"), other.alias("y")
        met = x.join(y, (F.col("x.token") == F.col("y.token")) & (F.col("x.class") == F.col("y.class"))).filter(
            "x.component <> y.component AND (x.n < y.n OR x.n = y.n AND x.rep < y.rep)"
        )
        met = met.select(F.col("x.rep").alias("a"), F.col("y.rep").alias("b"))
        pairs = met if pairs is None else pairs.unionByName(met)
    return pairs.distinct()
