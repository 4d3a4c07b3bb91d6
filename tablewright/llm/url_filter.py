"""URL rules by a sort-merge sweep over reversed hosts.

``www.example.org`` becomes ``org.example.www.``, so a rule's host with all its subdomains is one
interval of keys, and a rule's path with all longer paths is an interval inside it. Every task
sorts its own URLs by key and walks them next to the sorted rules, with a stack of the rules
whose interval it is in. URLs are never shuffled.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import bounded_batches, lower_ascii

BLOCK = 100_000


def url_host(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?`` or ``#``, A-Z lower-cased; else empty."""
    return lower_ascii(F.coalesce(F.regexp_extract(url, "://([^/?#]*)", 1), F.lit("")))


def url_path(url: Column) -> Column:
    """What follows the host up to ``?`` or ``#``; else empty."""
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


def host_key(host: Column) -> Column:
    """The labels of a host in reverse order, each closed by a dot."""
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit("."))


def reversed_host(host: str) -> str:
    return "".join(f"{label}." for label in reversed(host.split(".")))


class PathRules:
    """The rules of one host by path, each with the one that most closely encloses it."""

    def __init__(self, rules: Sequence[tuple[str, object]]):
        rules = sorted(rules, key=lambda r: r[0])
        self.paths = [path for path, _ in rules]
        self.payloads = [payload for _, payload in rules]
        self.above: list[int] = []
        stack: list[int] = []
        for k, path in enumerate(self.paths):
            while stack and not path.startswith(self.paths[stack[-1]]):
                stack.pop()
            self.above.append(stack[-1] if stack else -1)
            stack.append(k)

    def fitting(self, path: str) -> Iterator[object]:
        """Payloads of all rules that ``path`` begins with, the longest first.

        Whatever stands between a rule and a path that begins with it begins with it as well, so these rules
        enclose the last one that is not behind the path.
        """
        k = bisect_right(self.paths, path) - 1
        while k >= 0 and not path.startswith(self.paths[k]):
            k = self.above[k]
        while k >= 0:
            yield self.payloads[k]
            k = self.above[k]


def sweep(
    keys: Iterator[tuple[str, str]], rules: Sequence[tuple[str, str, object]]
) -> Iterator[list[object]]:
    """For each (host key, path) in sorted order, the payloads of all rules that fit.

    ``rules`` are (host key, path prefix, payload) in sorted order. The stack holds rule hosts whose
    interval the sweep is in; the paths of a host's rules are nested intervals too, sorted
    once, and a path finds the innermost one by bisection.
    """
    by_host: dict[str, list] = {}
    for key, path, payload in rules:
        by_host.setdefault(key, []).append((path, payload))
    order = list(by_host)
    nested = {key: PathRules(own) for key, own in by_host.items()}
    at, hosts, last = 0, [], None
    for key, path in keys:
        if key != last:
            while hosts and not key.startswith(hosts[-1]):
                hosts.pop()
            while at < len(order) and order[at] <= key:
                if key.startswith(order[at]):
                    hosts.append(order[at])
                at += 1
            last = key
        yield [payload for host in hosts for payload in nested[host].fitting(path)]


def _judge(rules, place: int):
    """Append the best rule of this block to each row: (text, verdict), by length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = rules.value
        # the sweep is one pass over the task's sorted rows, so batches are fed to it lazily
        feed: list[pa.RecordBatch] = []

        def keys():
            for batch in (b for b in batches if b.num_rows):
                feed.append(batch)
                yield from zip(batch.column("__uf_key").to_pylist(), batch.column("__uf_path").to_pylist())

        best = []
        for found in sweep(keys(), known):
            best.append(max(found, default=None))
            if len(best) == feed[0].num_rows:
                yield from _closed(feed.pop(0), best)
                best = []

    def _closed(batch, best):
        names = [f"__uf_size{place}", f"__uf_rule{place}", f"__uf_verdict{place}"]
        yield pa.RecordBatch.from_arrays(
            [
                *batch.columns,
                pa.array([b and b[0] for b in best], pa.int64()),
                pa.array([b and b[2] for b in best], pa.string()),
                pa.array([b and b[3] for b in best], pa.string()),
            ],
            names=[*batch.schema.names, *names],
        )

    return run


def judge_urls(
    urls: DataFrame,
    rules: Sequence[tuple[str, str, str]],
    url_col: str = "url",
    default: str = "allow",
    block: int = BLOCK,
) -> DataFrame:
    """``urls`` with ``host``, ``path``, ``rule`` and ``verdict`` added (replacing such columns).

    ``rules`` are (verdict, host, path). A rule fits its host and all subdomains when the URL's
    path starts with the rule's; of those that fit, the one with the longest host and path
    together wins, then the longer host, then the greater verdict. Without a rule that fits,
    ``rule`` is null and ``verdict`` the ``default``. A null URL or one without ``://`` has an
    empty host and path, which no rule fits. Repeated rows stay. Rules go out in blocks of at most
    ``block``, which bounds what is broadcast; each block is one more pass inside the same stage.
    """
    spark = urls.sparkSession
    bounded_batches(spark)
    listed = sorted(
        (reversed_host(host), path, (len(host) + len(path), len(host), host + path, verdict))
        for verdict, host, path in {(v, h.translate(FOLD), p) for v, h, p in rules}
    )
    kept = [c for c in urls.columns if c not in ("host", "path", "rule", "verdict")]
    url = F.col(f"`{url_col}`")
    rows = urls.withColumns({"__uf_host": url_host(url), "__uf_path": url_path(url)})
    rows = rows.withColumn("__uf_key", host_key(F.col("__uf_host")))
    rows = rows.select(*(f"`{c}`" for c in kept), "__uf_host", "__uf_path", "__uf_key")
    rows = rows.sortWithinPartitions("__uf_key", "__uf_path")
    pieces = range(0, max(len(listed), 1), block)
    for place, first in enumerate(pieces):
        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
        schema += f", __uf_size{place} long, __uf_rule{place} string, __uf_verdict{place} string"
        part = spark.sparkContext.broadcast(listed[first : first + block])
        rows = rows.mapInArrow(_judge(part, place), schema)
    found = [
        F.struct(*(F.col(f"__uf_{name}{place}").alias(name) for name in ("size", "rule", "verdict")))
        for place in range(len(pieces))
    ]
    best = F.greatest(*found) if len(found) > 1 else found[0]
    return rows.select(
        *(f"`{c}`" for c in kept),
        F.col("__uf_host").alias("host"),
        F.col("__uf_path").alias("path"),
        best["rule"].alias("rule"),
        F.coalesce(best["verdict"], F.lit(default)).alias("verdict"),
    )


FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
