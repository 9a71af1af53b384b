"""Quality rules: gradient-boosted trees over document statistics.

Statistics of every whole text are computed per Arrow batch; a small boosted-tree model
(logistic loss, histogram splits, monotonic constraints on chosen statistics) is trained
in numpy on a bounded sample of labelled rows, flattened into node arrays and applied
to all rows of a batch at once. Fixed base rules come first.

Training uses at most ``sample_rows`` labelled documents (in hash order of their ids);
only their statistics reach the driver. A fifth of them sets the threshold, such that
at most ``lost_good`` of the good rows that pass the base rules are turned away.

Results for odd input: a null or empty text has no words and fails the base rules; without
labelled rows of both classes the base rules alone decide, however few they are else; of
texts that share a labelled id one is learned from; repeated rows get equal verdicts.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import hash_sample, release, small_batches

WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
SPACES = b" \t\n\x0b\x0c\r"
SYMBOLS = b"#*$%&|<>"
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
FEATURES = ["log_words", "word_length", "symbol_rate", "dup_line_rate", "repeat_rate", "line_words", "digit_rate", "upper_rate", "distinct_rate", "stop_rate", "comma_rate", "bracket_rate"]
#: +1: quality may only rise with the statistic; -1: only fall; 0: free.
MONOTONE = [0, 0, -1, -1, -1, 0, 0, 0, 0, 0, 0, 0]


def repeated_words(ids: np.ndarray, window: int = WINDOW) -> int:
    """Words inside a window of words that occurs at least twice."""
    n = len(ids) - window + 1
    if n < 2:
        return 0
    v = (ids.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    v ^= v >> np.uint64(29)
    v *= np.uint64(0xBF58476D1CE4E5B9)
    v ^= v >> np.uint64(32)
    h = np.zeros(n, np.uint64)
    for k in range(window):
        h = h * np.uint64(0x100000001B3) + v[k : k + n]
    order = np.argsort(h, kind="stable")
    same = h[order][1:] == h[order][:-1]
    if not same.any():
        return 0
    hit = np.zeros(n, bool)
    hit[order[1:][same]] = True
    hit[order[:-1][same]] = True
    cover = np.zeros(n + window, np.int64)
    at = np.flatnonzero(hit)
    cover[at] += 1
    cover[at + window] -= 1
    return int((np.cumsum(cover)[: len(ids)] > 0).sum())


def statistics(text: str | None) -> tuple[list[int], list[float]]:
    """The base counts (:data:`BASE`) and the model's statistics of one whole text."""
    text = text or ""
    raw = text.encode("utf-8", "replace")
    words = raw.split()  # cuts bytes at exactly the six ASCII white-space characters
    n = len(words)
    word_chars = len(text) - (len(raw) - len(raw.translate(None, SPACES)))
    n_symbols = len(raw) - len(raw.translate(None, SYMBOLS))
    seen: set[bytes] = set()
    lines = dup = 0
    for line in raw.split(b"\n"):
        if line.strip():
            lines += 1
            if line in seen:
                dup += 1
            else:
                seen.add(line)
    number: dict[bytes, int] = {}
    ids = np.fromiter([number.setdefault(w, len(number)) for w in words], np.int64, n)
    repeat = repeated_words(ids)
    chars = max(1, word_chars)

    def rate(of: bytes) -> float:
        return (len(raw) - len(raw.translate(None, of))) / chars

    top = np.sort(np.bincount(ids))[-10:].sum() / n if n else 0.0
    features = [
        np.log1p(n), word_chars / max(1, n), n_symbols / chars, dup / max(1, lines), repeat / max(1, n), n / max(1, lines),
        rate(b"0123456789"), rate(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"), len(number) / max(1, n), top, rate(b",;:.!?"), rate(b"()[]{}=/_@\\"),
    ]
    return [n, word_chars, n_symbols, dup, repeat], features


def base_failed(base: np.ndarray) -> np.ndarray:
    n, repeat = base[:, 0], base[:, 4]
    return (n < MIN_WORDS) | (100 * repeat > MAX_REPEAT_PERCENT * n)


@dataclass
class Trees:
    """All trees as flat node arrays; a leaf points at itself."""

    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    depth: int
    bias: float
    threshold: float

    def probability(self, x: np.ndarray) -> np.ndarray:
        at = np.broadcast_to(self.roots, (len(x), len(self.roots)))
        rows = np.arange(len(x))[:, None]
        for _ in range(self.depth):
            at = np.where(x[rows, self.feature[at]] <= self.cut[at], self.left[at], self.right[at])
        return 1 / (1 + np.exp(-(self.bias + self.value[at].sum(axis=1))))


def boost(x: np.ndarray, y: np.ndarray, monotone: list[int], trees: int = 60, depth: int = 3, rate: float = 0.15, bins: int = 32, leaf: float = 1.0) -> Trees:
    """Fit boosted trees; a split that breaks a monotonic constraint is not taken, and
    both sides are bounded by the middle of their values further down."""
    mean = min(max(y.mean(), 1e-3), 1 - 1e-3)
    bias = float(np.log(mean / (1 - mean)))
    edges = [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1])) for c in x.T]
    coded = np.stack([np.searchsorted(e, c, side="left") for e, c in zip(edges, x.T)], axis=1)
    nodes: list[list[float]] = []  # feature, cut, left, right, value
    roots, score = [], np.full(len(y), bias)

    def weight(g: float, h: float) -> float:
        return -g / (h + leaf)

    def grow(rows: np.ndarray, left_depth: int, lo: float, hi: float, g: np.ndarray, h: np.ndarray) -> int:
        me = len(nodes)
        total_g, total_h = g[rows].sum(), h[rows].sum()
        own = min(max(weight(total_g, total_h), lo), hi)
        nodes.append([0, np.inf, me, me, rate * own])
        best = (1e-3, None)
        if left_depth and len(rows) >= 20:
            for f, e in enumerate(edges):
                if not len(e):
                    continue
                cg = np.cumsum(np.bincount(coded[rows, f], g[rows], len(e) + 1))[:-1]
                ch = np.cumsum(np.bincount(coded[rows, f], h[rows], len(e) + 1))[:-1]
                wl = np.clip(-cg / (ch + leaf), lo, hi)
                wr = np.clip(-(total_g - cg) / (total_h - ch + leaf), lo, hi)
                gain = -(cg * wl + 0.5 * (ch + leaf) * wl**2) - ((total_g - cg) * wr + 0.5 * (total_h - ch + leaf) * wr**2)
                gain += total_g * own + 0.5 * (total_h + leaf) * own**2
                gain[(ch < 1) | (total_h - ch < 1)] = 0
                if monotone[f]:
                    gain[monotone[f] * (wr - wl) < 0] = 0
                k = int(gain.argmax())
                if gain[k] > best[0]:
                    best = (gain[k], (f, k, wl[k], wr[k]))
        if best[1]:
            f, k, wl, wr = best[1]
            goes = coded[rows, f] <= k
            bounds = [(lo, hi), (lo, hi)]
            if monotone[f]:
                mid = (wl + wr) / 2
                bounds = [(lo, mid), (mid, hi)] if monotone[f] > 0 else [(mid, hi), (lo, mid)]
            nodes[me][:2] = [f, edges[f][k]]
            nodes[me][2] = grow(rows[goes], left_depth - 1, *bounds[0], g, h)
            nodes[me][3] = grow(rows[~goes], left_depth - 1, *bounds[1], g, h)
        return me

    for _ in range(trees):
        p = 1 / (1 + np.exp(-score))
        roots.append(grow(np.arange(len(y)), depth, -np.inf, np.inf, p - y, p * (1 - p)))
        f, cut, left, right, value = (np.array(c) for c in zip(*nodes))
        one = Trees(f.astype(np.int64), cut, left.astype(np.int64), right.astype(np.int64), value, np.array(roots[-1:]), depth, 0.0, 0.0)
        at = np.full((len(y), 1), roots[-1])
        for _ in range(depth):
            at = np.where(x[np.arange(len(y))[:, None], one.feature[at]] <= one.cut[at], one.left[at], one.right[at])
        score = score + one.value[at[:, 0]]
    if not roots:
        nodes.append([0, np.inf, 0, 0, 0.0])
        roots.append(0)
    f, cut, left, right, value = (np.array(c, float) for c in zip(*nodes))
    return Trees(f.astype(np.int64), cut, left.astype(np.int64), right.astype(np.int64), value, np.array(roots), depth, bias, 0.0)


def fit(x: np.ndarray, y: np.ndarray, lost_good: float = 0.005) -> Trees | None:
    """Model and threshold; None when the sample has one class or no rows. Every fifth row of a
    class sets the threshold (all rows of label 1 where fewer than five have it)."""
    if not len(y) or y.min() == y.max():
        return None
    held = np.zeros(len(y), bool)
    for c in (0, 1):
        held[np.flatnonzero(y == c)[4::5]] = True
    model = boost(x[~held], y[~held], MONOTONE)
    good = model.probability(x[held & (y == 1)] if (held & (y == 1)).any() else x[y == 1])
    model.threshold = float(min(0.5, np.quantile(good, lost_good))) if len(good) else 0.0
    return model


def _measured(docs: DataFrame, model: Trees | None, extra: bool) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        release()
        trees = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            got = [statistics(t.as_py()) for t in batch.column(1)]
            base = np.array([b for b, _ in got], np.int64)
            x = np.array([f for _, f in got], float)
            failed = base_failed(base)
            cols = [batch.column(0), *(pa.array(c) for c in base.T), pa.array(failed)]
            names = ["doc_id", *BASE, "base_failed"]
            if extra:
                cols.append(pa.array([*x], pa.list_(pa.float64())))
                names.append("features")
            else:
                p = trees.probability(x) if trees else np.ones(len(x))
                cols += [pa.array(~failed & (p >= (trees.threshold if trees else 0))), pa.array(p)]
                names += ["kept", "probability"]
            yield pa.RecordBatch.from_arrays(cols, names=names)

    kind = docs.schema["doc_id"].dataType.simpleString()
    tail = "features array<double>" if extra else "kept boolean, probability double"
    return docs.transform(small_batches).mapInArrow(run, f"doc_id {kind}, " + "".join(f"{c} bigint, " for c in BASE) + f"base_failed boolean, {tail}")


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = 8000, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> Trees | None:
    """Fit on at most ``sample_rows`` labelled documents."""
    known = labels.filter(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
    sample = hash_sample(known.select(F.col(id_col).alias("l_id"), F.col(label_col).cast("int").alias("l_y")), sample_rows, "l_id", "l_y")
    picked = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).join(
        F.broadcast(sample), F.col("doc_id") == F.col("l_id")
    )
    measured = _measured(picked.select("doc_id", "text"), None, True).filter("not base_failed")
    measured = measured.groupBy("doc_id").agg(F.min("features").alias("features"))
    rows = (
        measured.join(F.broadcast(sample), F.col("doc_id") == F.col("l_id"))
        .orderBy(F.xxhash64("doc_id"), "doc_id", "l_y").limit(sample_rows).select("features", "l_y").collect()
    )
    if not rows:
        return None
    return fit(np.array([r["features"] for r in rows]), np.array([r["l_y"] for r in rows]))


def judge(docs: DataFrame, model: Trees | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Base counts, ``base_failed``, ``kept`` and the model's probability of every row."""
    return _measured(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), model, False)


def keep(docs: DataFrame, model: Trees | None, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` (all their columns) that pass the rules."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)

    def run(batches):
        release()
        trees = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            got = [statistics(t.as_py()) for t in batch.column(at)]
            ok = ~base_failed(np.array([b for b, _ in got], np.int64))
            if trees:
                ok &= trees.probability(np.array([f for _, f in got], float)) >= trees.threshold
            yield batch.filter(pa.array(ok))

    return docs.transform(small_batches).mapInArrow(run, docs.schema)
