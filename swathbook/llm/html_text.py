"""Main text of HTML pages: a linear-chain conditional random field over the leaf blocks of the DOM.

A page is a sequence of blocks. Each block has features of its ancestors' tags and names, of its own element and of its
text; each step from a block to the next has weights by the two labels and by how the two blocks lie in the tree. The
model is trained on labelled pages by maximum likelihood (forward-backward, L-BFGS) and decoded by Viterbi.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from swathbook.llm.html_blocks import Block, Node, parse
from swathbook.llm.html_layouts import laid_out, marked, texts_of
from swathbook.llm.shared import ship_package

#: Labelled pages taken from a table, the longest of them in characters, and layouts made of each.
PAGES, PAGE_CHARS, LAYOUTS = 300, 200_000, 6
#: A longer page is cut into sequences of so many blocks for training; features seen in fewer blocks are left out.
SEQUENCE, SEEN = 200, 5
#: Weight of the squared norm of all weights, and most steps of the optimiser.
PENALTY, STEPS = 0.2, 120

WORD_STEPS = (1, 3, 6, 12, 25, 50, 100)
ENDS = tuple(".!?…:;\"'”’»)]")
SIGNS = {"©": "copyright", "|": "bar", "·": "dot", "»": "quote", "›": "quote", "@": "at", "✕": "close", "×": "close"}


def text_features(block: Block, index: int, count: int, title: str) -> list[str]:
    """Features of a block's whole text, its links and its place on the page."""
    text = block.text
    words = text.count(" ") + 1
    out = ["w:%d" % sum(words > s for s in WORD_STEPS)]
    out.append("l:none" if not block.links else "l:some" if block.links < 0.3 else "l:most" if block.links < 0.9 else "l:all")
    out.append("end" if text.endswith(ENDS) else "no end")
    out.append("commas:%d" % min(2, text.count(",")))
    out += ["s:" + name for sign, name in SIGNS.items() if sign in text]
    if index == 0:
        out.append("first")
    if index == count - 1:
        out.append("last")
    if title and (text.startswith(title) or title.startswith(text)):
        out.append("title")
    return out


def node_features(node: Node) -> list[str]:
    """Features of all ancestors (``a:``), of the block's own element (``o:``) and of the one around it (``p:``)."""
    leaf = node.block
    out = ["a:" + f for f in leaf.features]
    out += ["o:" + f for f in leaf.names] or ["o:none"]
    if leaf.parent is not None:
        out += ["p:" + f for f in leaf.parent.names] or ["p:none"]
    return out


def step_kind(before: Node, node: Node) -> int:
    """0: children of one element, 1: one lies an element deeper than the other, 2: further apart."""
    a, b = before.block.parent, node.block.parent
    if a is b:
        return 0
    up = lambda x: None if x is None else x.parent
    return 1 if (up(a) is b and b is not None) or (up(b) is a and a is not None) else 2


@dataclass
class Extractor:
    """Weights of features for the label main text (the other label's are zero), and of steps by kind and labels."""

    weights: dict[str, float]
    steps: np.ndarray  # kind x label before x label
    known: frozenset[str] = field(default_factory=frozenset)

    def scores(self, blocks: list[Block], title: str) -> list[float]:
        get = self.weights.get
        out = []
        for i, block in enumerate(blocks):
            leaf = block.node.block
            if leaf.score is None:
                leaf.score = sum(get(f, 0.0) for f in node_features(leaf))
            out.append(leaf.score + sum(get(f, 0.0) for f in text_features(block, i, len(blocks), title)))
        return out

    def decode(self, blocks: list[Block], title: str) -> list[bool]:
        """The most likely labels of a page's blocks (Viterbi); ties go to other text."""
        if not blocks:
            return []
        scores = self.scores(blocks, title)
        steps = self.steps.tolist()
        other, main, back = 0.0, scores[0], []
        for i in range(1, len(blocks)):
            s = steps[step_kind(blocks[i - 1].node, blocks[i].node)]
            o0, o1, m0, m1 = other + s[0][0], main + s[1][0], other + s[0][1], main + s[1][1]
            back.append((o1 > o0, m1 > m0))
            other, main = max(o0, o1), max(m0, m1) + scores[i]
        label = main > other
        out = [label]
        for from_other, from_main in reversed(back):
            label = from_main if label else from_other
            out.append(label)
        return out[::-1]

    def text(self, page: str | None) -> str:
        """Main text of a page: its main blocks in order, joined by one line feed."""
        blocks, title = parse(page, self.known)
        return "\n".join(b.text for b, main in zip(blocks, self.decode(blocks, title), strict=True) if main)


def minimise(f, x: np.ndarray, steps: int, memory: int = 10) -> np.ndarray:
    """L-BFGS with a halving line search; ``f`` gives value and gradient."""
    value, slope = f(x)
    pairs: list[tuple[np.ndarray, np.ndarray, float]] = []
    for _ in range(steps):
        direction, alphas = -slope, []
        for s, y, rho in reversed(pairs):
            a = rho * (s @ direction)
            alphas.append(a)
            direction = direction - a * y
        if pairs:
            s, y, rho = pairs[-1]
            direction = direction / (rho * (y @ y))
        else:
            direction = direction / max(1.0, np.linalg.norm(slope))
        for (s, y, rho), a in zip(pairs, reversed(alphas), strict=True):
            direction = direction + (a - rho * (y @ direction)) * s
        fall, size = slope @ direction, 1.0
        while size > 1e-10:
            there, its_slope = f(x + size * direction)
            if there <= value + 1e-4 * size * fall:
                break
            size /= 2
        else:
            break
        s, y = size * direction, its_slope - slope
        if s @ y > 1e-12:
            pairs = [*pairs[-(memory - 1) :], (s, y, 1 / (s @ y))]
        small = value - there < 1e-7 * max(1.0, abs(value))
        x, value, slope = x + s, there, its_slope
        if small:
            break
    return x


def chain_likelihood(unary: np.ndarray, kinds: np.ndarray, real: np.ndarray, labels: np.ndarray, steps: np.ndarray):
    """Log-likelihood of all labels, and expected minus observed label and step counts.

    ``unary``, ``kinds``, ``real`` and ``labels`` are sequences x places; ``kinds[:, t]`` is the step into place t, and
    places where ``real`` is false follow a sequence's end.
    """
    rows, places = unary.shape
    label_score = np.stack([np.zeros_like(unary), unary], 2)
    forward = np.zeros((rows, places, 2))
    forward[:, 0] = label_score[:, 0]
    for t in range(1, places):
        into = np.logaddexp(*(forward[:, t - 1, k, None] + steps[kinds[:, t], k] for k in (0, 1)))
        forward[:, t] = np.where(real[:, t, None], into + label_score[:, t], forward[:, t - 1])
    total = np.logaddexp(forward[:, -1, 0], forward[:, -1, 1])
    backward = np.zeros((rows, 2))
    label_gap, step_gap = np.zeros_like(unary), np.zeros_like(steps)
    for t in range(places - 1, -1, -1):
        label_gap[:, t] = np.where(real[:, t], np.exp(forward[:, t, 1] + backward[:, 1] - total) - labels[:, t], 0.0)
        if t:
            inner = label_score[:, t] + backward
            both = forward[:, t - 1, :, None] + steps[kinds[:, t]] + inner[:, None, :]
            share = np.where(real[:, t, None, None], np.exp(both - total[:, None, None]), 0.0)
            np.add.at(step_gap, kinds[:, t], share)
            seen = real[:, t]
            np.add.at(step_gap, (kinds[seen, t], labels[seen, t - 1], labels[seen, t]), -1.0)
            new = np.stack([np.logaddexp(steps[kinds[:, t], k, 0] + inner[:, 0], steps[kinds[:, t], k, 1] + inner[:, 1]) for k in (0, 1)], 1)
            backward = np.where(real[:, t, None], new, backward)
    picked = np.where(real, np.where(labels == 1, unary, 0.0), 0.0).sum()
    moves = real[:, 1:]
    picked += steps[kinds[:, 1:][moves], labels[:, :-1][moves], labels[:, 1:][moves]].sum()
    return picked - total.sum(), label_gap, step_gap


def _padded(sequences: list, number: dict[str, int]) -> tuple[np.ndarray, ...]:
    """Sequences of (features, label, step kind) as arrays, and the places and numbers of all their features."""
    shape = (len(sequences), max(map(len, sequences)))
    real, labels, kinds = np.zeros(shape, bool), np.zeros(shape, int), np.zeros(shape, int)
    place, feature = [], []
    for i, s in enumerate(sequences):
        for t, (names, label, kind) in enumerate(s):
            real[i, t], labels[i, t], kinds[i, t] = True, label, kind
            ids = [number[f] for f in names if f in number]
            place += [i * shape[1] + t] * len(ids)
            feature += ids
    return real, labels, kinds, np.array(place, int), np.array(feature, int)


def fit_pages(pages: list[str]) -> Extractor | None:
    """The model of labelled pages: blocks below an element with the attribute ``data-main`` are main text (``data-other`` below it: not).

    None if there is no block.
    """
    sequences = []
    for page in pages:
        blocks, title = parse(page)
        rows = [(node_features(b.node.block) + text_features(b, i, len(blocks), title), int(b.node.main), step_kind(blocks[i - 1].node, b.node) if i else 0) for i, b in enumerate(blocks)]
        sequences += [rows[i : i + SEQUENCE] for i in range(0, len(rows), SEQUENCE)]
    if not sequences:
        return None
    seen = Counter(f for s in sequences for fs, _, _ in s for f in fs)
    names = sorted(f for f, n in seen.items() if n >= SEEN)
    number = {f: i for i, f in enumerate(names)}
    # sequences of similar length are padded together
    groups: dict[int, list] = {}
    for s in sequences:
        groups.setdefault(len(s).bit_length(), []).append(s)
    packed = [_padded(group, number) for group in groups.values()]

    def loss(x: np.ndarray):
        weights, steps = x[: len(names)], x[len(names) :].reshape(3, 2, 2)
        value, slope = PENALTY * (x @ x) / 2, PENALTY * x
        for real, labels, kinds, place, feature in packed:
            unary = np.bincount(place, weights[feature], minlength=real.size).reshape(real.shape)
            likely, label_gap, step_gap = chain_likelihood(unary, kinds, real, labels, steps)
            value = value - likely
            slope = slope + np.concatenate([np.bincount(feature, label_gap.ravel()[place], minlength=len(names)), step_gap.ravel()])
        return value, slope

    x = minimise(loss, np.zeros(len(names) + 12), STEPS)
    weights = dict(zip(names, x[: len(names)].tolist(), strict=True))
    known = frozenset(f[2:] for f in names if f[:2] in ("a:", "o:", "p:"))
    return Extractor(weights, x[len(names) :].reshape(3, 2, 2), known)


def _fit_task(layouts: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pages = sorted(p for batch in batches for p in batch.column(0).to_pylist())
        labelled = []
        for i, page in enumerate(pages):
            prose, short = texts_of(page)
            if "data-main" in page:
                labelled.append(page)
            elif prose and marked(page) != page:
                labelled.append(marked(page))
            labelled += [laid_out(prose, short, i * layouts + j) for j in range(layouts)] if prose else []
        model = fit_pages(labelled)
        if model:
            names = list(model.weights)
            rows = [("", *model.steps.ravel().tolist())] + [(n, model.weights[n], *[0.0] * 11) for n in names]
            columns = list(zip(*rows, strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(columns[0]), pa.array(np.array(columns[1:]).T.tolist(), pa.list_(pa.float64()))], ["name", "value"])

    return run


def fit_extractor(df: DataFrame, html: str = "html", pages: int = PAGES, layouts: int = LAYOUTS) -> Extractor | None:
    """A model fitted on ``pages`` rows at most, those of the smallest hash, in one executor task.

    Labelled pages come first: pages with elements marked by the attribute ``data-main``, else pages with an ``article`` element, whose
    first one is taken as main text. The texts of each sampled page are also laid out anew ``layouts`` times, main text
    and other parts under the names that sites use, so that the model does not hang on one layout. Pages
    beyond ``PAGE_CHARS`` characters are not fitted on. None if the table has no text.
    """
    ship_package(df.sparkSession)
    text = F.col(html)
    rank = F.when(text.contains("data-main"), 0).when(text.rlike(r"(?i)<article[\s/>]"), 1).otherwise(2)
    fit = df.select(text.alias("html")).where((F.length(text) > 0) & (F.length(text) <= PAGE_CHARS))
    sample = fit.orderBy(rank, F.xxhash64("html"), "html").limit(pages)
    rows = sample.repartition(1).mapInArrow(_fit_task(layouts), "name string, value array<double>").collect()
    if not rows:
        return None
    steps = next(np.array(r["value"]).reshape(3, 2, 2) for r in rows if r["name"] == "")
    weights = {r["name"]: r["value"][0] for r in rows if r["name"]}
    return Extractor(weights, steps, frozenset(f[2:] for f in weights if f[:2] in ("a:", "o:", "p:")))


def extract_text(df: DataFrame, model: Extractor | None, html: str = "html") -> DataFrame:
    """``df`` with the column main_text (replaced if there is one): main blocks of each whole page, joined by line feeds.

    Character references are decoded and white space inside a block is one space. A null or empty page, and one without main text, gives
    the empty text. Without a model every block counts as main text. All rows and columns are kept; rows of equal
    pages have equal texts.
    """
    ship_package(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(model)

    def texts(pages: pa.Array) -> pa.Array:
        held = shared.value
        whole = lambda page: "\n".join(b.text for b in parse(page)[0])
        text = held.text if held else whole
        return pa.array([text(p.as_py()) for p in pages], pa.string())

    return df.withColumn("main_text", F.arrow_udf(texts, "string")(F.col(html)))
