"""Main text of web pages by a tree-structured graphical model on the DOM.

Block elements and their texts are nodes with a hidden label, content or not. A parent's label
and a child's are tied by a potential; each node's tag, names, length and link share have
potentials of their own. Potentials are counts over the pages whose markup names their article,
so learning is one aggregation. For a page, messages pass from the leaves up and from the root
down (sum-product), which gives the exact marginal of every node; texts likelier to be content
than not are kept.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import bounded_batches, stored

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = frozenset("script style template noscript head title svg math iframe object textarea select button canvas audio video".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q ruby s samp "
    "small span strike strong sub sup time tt u var".split()
)
#: What an opening tag ends when it is still open.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
#: What can stand in a head; any other element ends it.
IN_HEAD = frozenset("base basefont bgsound link meta noframes noscript script style template title".split())
#: Names that mark a part of a page as content or as something else, as log potentials.
CONTENT_NAMES = frozenset("article main content post entry story body text".split())
OTHER_NAMES = frozenset(
    "ad ads advert advertisement aside banner breadcrumb breadcrumbs comment comments cookie cookies "
    "consent disqus footer form header login masthead menu modal nav navbar navigation newsletter "
    "notice pager pagination popup promo related reply replies respond search share sharing sidebar "
    "signup social sponsor sponsored subscribe tags toolbar widget".split()
)
OTHER_TAGS = frozenset("nav aside footer header form dialog menu fieldset".split())
STRONG, WEAK = 9.0, 6.0
FREE = [[0.5, 0.5], [0.5, 0.5]]

PARTS = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>script|style|textarea|title|noscript|template)\b[^>]*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<rest>(?:\"[^\"]*\"|'[^']*'|[^'\"<>])*)(?:>|\Z)"
    r"|</?[a-zA-Z][^<>]*(?:>|\Z)"
    r"|(?P<text>[^<]+|<)",
    re.S | re.I,
)
NAMES = re.compile(r"(?:class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)", re.I)
SPACE = re.compile(r"\s+")


def named(features) -> bool:
    """True for nodes whose tag or names tell what they are; their label is not tied to the parent's."""
    kinds = [f.split(" ") for f in features]
    return any(
        (kind == "name" and value in OTHER_NAMES)
        or (kind == "tag" and (value in OTHER_TAGS or value in ("article", "main")))
        for kind, value in kinds
    )


class Tree:
    """Nodes in page order: parent, tag, features, and for texts the text itself."""

    def __init__(self, page: str):
        self.parent, self.tags, self.features, self.text = [], [], [], []
        self.open: list[tuple[str, int]] = []  # inline elements carry their block's number
        self.times: Counter = Counter()  # how often each tag is open
        self.parts, self.linked, self.links, self.hidden = [], 0, 0, 0
        self._node(-1, "root", ())
        for found in PARTS.finditer(page):
            if found["text"] is not None:
                if found["text"].strip() and self.open and self.open[-1][0] == "head":
                    self._pop()  # text ends a head as well
                if not self.hidden:
                    self.parts.append(found["text"])
                    self.linked += len(found["text"]) if self.links else 0
            elif found["tag"]:
                tag = found["tag"].lower()
                if found["end"]:
                    self._close(tag)
                else:
                    self._open(tag, found["rest"])
        self._flush()

    def _node(self, parent: int, tag: str, features, text: str | None = None) -> int:
        self.parent.append(parent)
        self.tags.append(tag)
        self.features.append(features)
        self.text.append(text)
        return len(self.parent) - 1

    def _block(self) -> int:
        return self.open[-1][1] if self.open else 0

    def _flush(self) -> None:
        """What has been read since the last block edge becomes a text node."""
        raw = "".join(self.parts)
        text = SPACE.sub(" ", html.unescape(raw)).strip()
        if text:
            share = min(self.linked / max(len(raw), 1), 1.0)
            seen = (f"size {int(math.log2(len(text)))}", f"links {int(4 * share)}", f"stop {text[-1] in '.!?:;'}")
            self._node(self._block(), "#text", seen, text)
        self.parts, self.linked = [], 0

    def _open(self, tag: str, rest: str) -> None:
        if tag not in IN_HEAD and self.open and self.open[-1][0] == "head":
            self._pop()  # its end tag may be left out
        if tag in VOID:
            if tag == "hr":
                self._flush()
            self.parts.append(" ")
            return
        if tag in HIDDEN:
            if not rest.endswith("/"):
                self._push(tag, self._block())
                self.hidden += 1
            return
        if tag in INLINE:
            self._push(tag, self._block())
            self.links += tag == "a"
            return
        self._flush()
        if self.times["p"]:
            self._close("p")
        ends = ENDS.get(tag)
        while ends and self.open and (self.open[-1][0] in ends or self.open[-1][0] in INLINE):
            self._pop()
        names = {n for m in NAMES.findall(rest) for n in re.split(r"[^a-z]+", m.lower()) if n}
        seen = (f"tag {tag}", *(f"name {n}" for n in sorted(names)))
        self._push(tag, self._node(self._block(), tag, seen))

    def _push(self, tag: str, block: int) -> None:
        self.open.append((tag, block))
        self.times[tag] += 1

    def _pop(self) -> None:
        tag, _ = self.open.pop()
        self.times[tag] -= 1
        self.links -= tag == "a"
        self.hidden -= tag in HIDDEN

    def _close(self, tag: str) -> None:
        if not self.times[tag]:
            return
        if tag not in INLINE and tag not in HIDDEN:
            self._flush()
        while self.open:
            last = self.open[-1][0]
            self._pop()
            if last == tag:
                return

    def labels(self) -> list[int] | None:
        """1 for nodes inside the named article, 0 for all others; None where none is named."""
        if not any(t in ("article", "main") for t in self.tags):
            return None
        out = []
        for parent, tag, features in zip(self.parent, self.tags, self.features):
            above = out[parent] if parent >= 0 else 0
            other = tag in OTHER_TAGS or any(f[5:] in OTHER_NAMES for f in features if f.startswith("name "))
            out.append(int((above or tag in ("article", "main")) and not other))
        return out


def _learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of (what, label, label above) over pages with a named article."""
    counts: Counter = Counter()
    for batch in batches:
        for page in batch.column(0).to_pylist():
            tree = Tree(page or "")
            labels = tree.labels()
            if labels is None:
                continue
            counts["pages", 0, 0] += 1
            for k, own in enumerate(labels):
                if k and not named(tree.features[k]):
                    counts["edge", own, labels[tree.parent[k]]] += 1
                counts["nodes", own, 0] += 1
                for feature in tree.features[k]:
                    counts[feature, own, 0] += 1
        if len(counts) > 100_000:
            yield _counted(counts)
            counts.clear()
    yield _counted(counts)


def _counted(counts: Counter) -> pa.RecordBatch:
    keys = list(counts)
    return pa.RecordBatch.from_arrays(
        [
            pa.array([k[0] for k in keys], pa.string()),
            pa.array([k[1] for k in keys], pa.int32()),
            pa.array([k[2] for k in keys], pa.int32()),
            pa.array(list(counts.values()), pa.int64()),
        ],
        names=["what", "label", "above", "n"],
    )


def learn_pages(pages: DataFrame, html_col: str = "html", least_share: float = 1e-4) -> dict:
    """The model's potentials, counted over all pages that name their article.

    Features seen in fewer than ``least_share`` of these are left out, which bounds the model;
    without such pages it rests on the names that are known beforehand.
    """
    bounded_batches(pages.sparkSession)
    rows = pages.select(F.col(html_col)).mapInArrow(_learn, "what string, label int, above int, n long")
    rows = stored(rows.groupBy("what", "label", "above").agg(F.sum("n").alias("n")), "page-counts")
    total = rows.filter("what = 'pages'").agg(F.sum("n")).first()[0] or 0
    got = rows.filter(F.col("n") >= max(1.0, least_share * total)).collect()
    return model_of({(r["what"], r["label"], r["above"]): r["n"] for r in got})


def model_of(counts: dict[tuple[str, int, int], int]) -> dict:
    """Log potentials from (what, label, label above) -> count.

    A child's label given its parent's, with a small share of all cases left open; a feature's
    share among the nodes of a label and a hundredth, at half weight as the features of a node
    are not independent;
    and what is known beforehand about tags and names.
    """
    model = {"edge": [], "seen": {}}
    for above in (0, 1):
        row = [counts.get(("edge", own, above), 0) + 1.0 for own in (0, 1)]
        row = [x + (0.02, 0.005)[above] * sum(row) for x in row]
        model["edge"].append([math.log(x / sum(row)) for x in row])
    nodes = [1.0 + counts.get(("nodes", own, 0), 0) for own in (0, 1)]
    seen: dict[str, list[float]] = {}
    for (what, label, _), n in counts.items():
        if what not in ("edge", "nodes", "pages"):
            seen.setdefault(what, [0.0, 0.0])[label] += n
    for what, pair in seen.items():
        model["seen"][what] = [0.5 * math.log(pair[k] / nodes[k] + 0.01) for k in (0, 1)]
    known = [(f"name {n}", 0, STRONG) for n in OTHER_NAMES] + [(f"tag {t}", 0, STRONG) for t in OTHER_TAGS]
    known += [(f"name {n}", 1, WEAK) for n in CONTENT_NAMES] + [(f"tag {t}", 1, STRONG) for t in ("article", "main")]
    for what, label, weight in known:
        model["seen"].setdefault(what, [0.0, 0.0])[label] += weight
    return model


def marginals(tree: Tree, model: dict) -> list[float]:
    """The probability of content for every node, by messages up and down the tree."""
    size, seen = len(tree.parent), model["seen"]
    tied = [[math.exp(x) for x in row] for row in model["edge"]]
    edges = [FREE if named(f) else tied for f in tree.features]
    own = []
    for features in tree.features:
        a = b = 0.0
        for feature in features:
            pair = seen.get(feature)
            if pair:
                a += pair[0]
                b += pair[1]
        top = max(a, b)
        own.append((math.exp(max(a - top, -300)), math.exp(max(b - top, -300))))
    up, sent = list(own), [(1.0, 1.0)] * size
    for k in range(size - 1, 0, -1):  # children come after their parents
        x, y = up[k]
        edge = edges[k]
        message = edge[0][0] * x + edge[0][1] * y, edge[1][0] * x + edge[1][1] * y
        whole = message[0] + message[1]
        sent[k] = message[0] / whole, message[1] / whole
        x, y = up[tree.parent[k]]
        x, y = x * sent[k][0], y * sent[k][1]
        up[tree.parent[k]] = (x / (x + y), y / (x + y))
    belief = [(1.0, 0.0)] * size  # the root is no content
    for k in range(1, size):
        x, y = belief[tree.parent[k]]
        x, y = x / max(sent[k][0], 1e-300), y / max(sent[k][1], 1e-300)
        whole = x + y
        x, y = x / whole, y / whole
        edge = edges[k]
        a = up[k][0] * (x * edge[0][0] + y * edge[1][0])
        b = up[k][1] * (x * edge[0][1] + y * edge[1][1])
        belief[k] = (a / (a + b), b / (a + b)) if a + b > 0 else (0.5, 0.5)
    return [b for _, b in belief]


def main_text(page: str, model: dict) -> str:
    tree = Tree(page)
    content = marginals(tree, model)
    return "\n\n".join(t for t, p in zip(tree.text, content) if t is not None and p > 0.5)


def extract_text(pages: DataFrame, model: dict, html_col: str = "html") -> DataFrame:
    """``pages`` without ``html``, with ``text`` and ``n_chars`` added.

    Each kept block is one line with its white space made single spaces, blocks are joined by an
    empty line in page order, and character references are decoded. A null or empty page, and one
    without content, has an empty text. Columns of these names are replaced; repeated rows stay.
    """
    spark = pages.sparkSession
    bounded_batches(spark)
    kept = [c for c in pages.columns if c not in ("text", "n_chars", html_col)]
    rows = pages.select(F.col(html_col).alias("__he_html"), *(f"`{c}`" for c in kept))
    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in rows.schema.fields[1:])
    sent = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [main_text(page or "", sent.value) for page in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], pa.array(found, pa.string()), pa.array(map(len, found), pa.int64())],
                names=[*batch.schema.names[1:], "text", "n_chars"],
            )

    return rows.mapInArrow(run, f"{schema}text string, n_chars long")
