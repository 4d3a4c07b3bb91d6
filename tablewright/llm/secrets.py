"""Secrets in texts: named patterns, and strings of high entropy. DataFrame functions only.

Places of matches come from the pieces between them: the lengths of pieces and matches, added up,
are the starts. Candidate strings are scored by the Shannon entropy of a window that slides over
them; counts per character and the sum of n log n are carried from place to place and change by
the character that enters and the one that leaves. Strings on the allow-list are suppressed.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
KINDS = ("assign", "access", "hex", "entropy")

WINDOW = 20
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
#: (characters of the class, least entropy in bits of some window)
CLASSES = (
    (r"^[0-9A-F-]+$|^[0-9a-f-]+$", 3.0),
    (r"^[0-9]+$", 9.9),
    (r"^[A-Za-z0-9+/_=-]+$", 3.7),
)
#: Strings that are no secrets however mixed they look: words, numbers, dashes, paths, UUIDs.
ALLOWED = (
    r"^[A-Za-z]+$",
    r"^[0-9+/_=-]+$",
    r"^[A-Za-z]{0,14}([+/_=-][A-Za-z]{0,14})+$",
    r"^[a-z0-9]{1,12}([/_-][a-z]{1,14}){2,}[a-z0-9]*$",
    r"^[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$",
)
#: Letters and digits that name a sample; what stands apart from them in a string is judged by itself.
SAMPLE = r"(?i)example|sample|dummy|placeholder|x{6}"
SAMPLE_PART = r"(?i)(?<![a-z0-9])[a-z0-9]*(?:example|sample|dummy|placeholder|x{6})[a-z0-9]*"
SPAN = "array<struct<start:bigint,kind:int,end:bigint,found:string>>"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, computed once."""
    return F.transform(F.array(value), body)[0]


def located(text: Column, pattern: str, kind: int) -> Column:
    """Start, kind, end and string of every leftmost match, in characters."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    between = F.split(text, pattern, -1)
    nothing = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(SPAN).alias("out"))

    def add(done: Column, step: Column) -> Column:
        start = done["at"] + F.length(step["before"])
        end = start + F.length(step["found"])
        span = F.struct(
            start.alias("start"), F.lit(kind).alias("kind"), end.alias("end"), step["found"].alias("found")
        )
        return F.struct(end.alias("at"), F.concat(done["out"], F.array(span)).alias("out"))

    steps = F.arrays_zip(between.alias("before"), found.alias("found"))
    steps = F.filter(steps, lambda s: s["found"].isNotNull())
    return F.aggregate(steps, nothing, add, lambda done: done["out"])


def window_entropy(text: Column, window: int = WINDOW) -> Column:
    """The greatest entropy in bits of any ``window`` neighbouring characters of a string."""
    weights = F.array(*(F.lit(n * math.log2(n) if n else 0.0) for n in range(window + 2)))

    def weight(n: Column) -> Column:
        return F.element_at(weights, n + 1)

    def slide(letters: Column, places: Column) -> Column:
        gone = F.concat(F.array_repeat(F.lit(0), window), places)
        steps = F.filter(
            F.arrays_zip(places.alias("new"), gone.alias("old")), lambda s: s["new"].isNotNull()
        )
        start = F.struct(
            F.array_repeat(F.lit(0), F.size(letters)).alias("counts"),
            F.lit(0).alias("seen"),
            F.lit(0.0).alias("total"),
            F.lit(0.0).alias("best"),
        )

        def enter(state: Column, step: Column) -> Column:
            new, old = step["new"], step["old"]
            many = F.element_at(state["counts"], new)
            grown = state["total"] + weight(many + 1) - weight(many)
            left = F.when(old > 0, F.element_at(state["counts"], F.greatest(old, F.lit(1)))).otherwise(0)
            left = left + F.when(old == new, 1).otherwise(0)
            total = F.when(old > 0, grown + weight(F.greatest(left - 1, F.lit(0))) - weight(left)).otherwise(grown)
            counts = F.transform(
                state["counts"],
                lambda n, i: n + F.when(i + 1 == new, 1).otherwise(0) - F.when(i + 1 == old, 1).otherwise(0),
            )
            return let(
                total,
                lambda t: F.struct(
                    counts.alias("counts"),
                    (state["seen"] + 1).alias("seen"),
                    t.alias("total"),
                    F.when(state["seen"] + 1 >= window, F.greatest(state["best"], F.lit(math.log2(window)) - t / window))
                    .otherwise(state["best"])
                    .alias("best"),
                ),
            )

        return F.aggregate(steps, start, enter, lambda state: state["best"])

    def over(characters: Column) -> Column:
        return let(
            F.array_distinct(characters),
            lambda letters: let(
                F.transform(characters, lambda c: F.array_position(letters, c).cast("int")),
                lambda places: slide(letters, places),
            ),
        )

    return let(F.slice(F.split(text, ""), 1, F.length(text)), over)


def suspicious(text: Column) -> Column:
    """Some stretch without a sample's name is not on the allow-list, and of high entropy."""
    parts = F.transform(F.split(text, SAMPLE_PART, -1), lambda part: F.btrim(part, F.lit("+/_=-")))
    parts = F.filter(parts, lambda part: F.length(part) >= WINDOW)
    return F.exists(F.when(text.rlike(SAMPLE), parts).otherwise(F.array(text)), _mixed)


def _mixed(text: Column) -> Column:
    """Not on the allow-list, and some window reaches the least entropy of the string's class."""
    allowed = F.lit(False)
    for pattern in ALLOWED:
        allowed = allowed | text.rlike(pattern)
    least = F.lit(99.0)
    for pattern, bits in reversed(CLASSES):
        least = F.when(text.rlike(pattern), bits).otherwise(least)
    return ~allowed & (window_entropy(text) >= least)


def find_secrets(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with ``base`` and ``extra`` added: arrays of (start, kind, end, found).

    ``base`` has the pattern matches, leftmost and not overlapping within a kind; ``extra`` the
    candidate strings of high entropy that touch none of them. Starts and ends count characters,
    ends exclusive; kinds are places in ``KINDS``. Null counts as empty and gives empty arrays.
    Columns of these names are replaced, repeated rows stay, and no row needs another.
    """
    kept = [c for c in docs.columns if c not in ("base", "extra")]
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    rows = docs.select(*(f"`{c}`" for c in kept), text.alias("__se_text"))
    text, small = F.col("__se_text"), F.lower("__se_text")
    words = small.contains("passw") | small.contains("secret") | small.contains("token") | small.contains("api")
    none = F.array().cast(SPAN)
    assign = F.filter(
        located(text, ASSIGN, 0), lambda s: F.length(F.regexp_extract(s["found"], ASSIGN, 2)) >= 6
    )
    rows = rows.withColumns(
        {
            "__se_assign": F.when(words, assign).otherwise(none),
            "__se_access": F.when(text.contains("AKIA"), located(text, ACCESS, 1)).otherwise(none),
            "__se_hex": F.when(text.rlike("(?<![0-9a-f])[0-9a-f]{24}"), located(text, HEX, 2)).otherwise(none),
            "__se_long": F.when(
                text.rlike("(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20}"), located(text, CANDIDATE, 3)
            ).otherwise(none),
        }
    )
    rows = rows.withColumn("base", F.array_sort(F.concat("__se_assign", "__se_access", "__se_hex")))
    extra = F.filter(
        "__se_long",
        lambda s: ~F.exists("base", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])) & suspicious(s["found"]),
    )
    return rows.withColumn("extra", F.when(F.size("__se_long") > 0, extra).otherwise(none)).select(
        *(f"`{c}`" for c in kept), "base", "extra"
    )


def written(spans: Column) -> Column:
    """``kind:start:end`` of sorted spans, joined by commas."""
    kinds = F.array(*map(F.lit, KINDS))
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(
                ":", F.element_at(kinds, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string")
            ),
        ),
        ",",
    )


def count_kind(spans: Column, kind: int) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")
