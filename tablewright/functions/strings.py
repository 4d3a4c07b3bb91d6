"""String columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The English month names, in order; each is also known by its first three letters.
MONTHS = (
    "january", "february", "march", "april", "may", "june",
    "july", "august", "september", "october", "november", "december",
)
ABSENT = "∅"


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def row_hash(columns: Sequence[str]) -> Column:
    """MD5 of the columns joined by ``|``; a NULL differs from an empty text."""
    return F.md5(F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit(ABSENT)) for c in columns]))


def month_number(name: Column | str) -> Column:
    """1-12 from a month's whole name or its first three letters; NULL if it is neither."""
    key = F.lower(F.trim(_col(name)))
    places = [F.array_position(F.array(*map(F.lit, known)), key) for known in (MONTHS, [m[:3] for m in MONTHS])]
    return F.nullif(F.greatest(*places), F.lit(0).cast("bigint")).cast("int")


def nth_index(text: Column | str, part: str, n: int) -> Column:
    """1-based place of the n-th occurrence of ``part``; 0 when there are fewer."""
    pieces = F.split(_col(text), _literal(part))
    before = F.array_join(F.slice(pieces, 1, n), part)
    return F.when(F.size(pieces) > n, F.char_length(before) + 1).otherwise(0)


def codes_in(text: Column | str, codes: Sequence[str]) -> Column:
    """All occurrences of the listed codes, in order of place (longest code first)."""
    ordered = sorted(codes, key=len, reverse=True)
    return F.regexp_extract_all(_col(text), F.lit("(" + "|".join(map(_literal, ordered)) + ")"), F.lit(1))


def letter_signature(word: Column | str) -> Column:
    """The letters of a word in sorted order: equal for anagrams."""
    return F.array_join(F.sort_array(F.split(_col(word), "")), "")


def _literal(part: str) -> str:
    return "".join("\\" + c if c in r"\^$.|?*+()[]{}-" else c for c in part)
