"""Ranked search against scores computed one by one."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import types as T

from tessera.llm import ranked

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, k):
    """``(item_id, score, doc_id)`` of the k best, best first."""
    bags = [Counter(terms(t)) for _, t in docs]
    n, total = sum(bool(b) for b in bags), sum(sum(b.values()) for b in bags)
    df = Counter(t for b in bags for t in b)
    out = []
    for item, text in items:
        scored = []
        for (d, _), b in zip(docs, bags):
            size = sum(b.values())
            m = 25 + 75 * size * n // total if total else 0
            s = sum(c * math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * b[t] // (1000 * b[t] + 8 * m)) for t, c in Counter(terms(text)).items() if b[t])
            if s > 0:
                scored.append((s, d))
        out += [(item, i + 1, d, s) for i, (s, d) in enumerate(sorted(scored, key=lambda r: (-r[0], r[1] is None, r[1] or 0))[:k])]
    return out


def test_terms_of_odd_texts():
    for text in ("", "\x00a\x7fb", "Ärger ÄB a-b_c`d{e~ ſ K 9z x", "a@b[c]^d", None):
        assert [t.decode() for t in ranked.terms_of(text.encode() if text is not None else None)] == terms(text)


@pytest.mark.parametrize("stride", [1, 3, 128])
def test_nra_equals_full_scores(monkeypatch, stride):
    monkeypatch.setattr(ranked, "STRIDE", stride)
    rng = np.random.default_rng(2)
    for _ in range(150):
        n, k = int(rng.integers(1, 60)), int(rng.integers(1, 8))
        lists, full = [], np.zeros(n, np.int64)
        for _ in range(int(rng.integers(1, 6))):
            at = rng.permutation(n)[: int(rng.integers(1, n + 1))]
            impact = np.sort(rng.integers(1, int(rng.choice([3, 50])), len(at)))[::-1]
            lists.append((at, impact))
            full[at] += impact
        bar = int(rng.integers(1, 20))
        at, score = ranked.nra(lists, n, k, bar)
        assert (full[at] == score).all()
        wanted = sorted(((s, d) for d, s in enumerate(full.tolist()) if s >= bar), key=lambda r: (-r[0], r[1]))[:k]
        assert sorted(zip(score.tolist(), at.tolist()), key=lambda r: (-r[0], r[1]))[: len(wanted)] == wanted


def test_nra_stops_before_the_lists_end(monkeypatch):
    """A document far above the others in every list settles the search early."""
    monkeypatch.setattr(ranked, "STRIDE", 4)
    reads = []

    class Counted(np.ndarray):
        def __getitem__(self, key):
            if isinstance(key, slice) and key.stop:
                reads.append(key.stop)
            return super().__getitem__(key)

    n = 10_000
    lists = [(np.arange(n), np.concatenate([[10**6], np.ones(n - 1, np.int64)]).view(Counted)) for _ in range(3)]
    at, score = ranked.nra(lists, n, 1, 1)
    assert at.tolist() == [0] and score.tolist() == [3 * 10**6]
    assert max(reads) < n // 10


KIND = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("item", T.StringType()), T.StructField("score", T.StringType())])
ITEMS = T.StructType([T.StructField("item_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("doc_id", T.StringType())])


@pytest.mark.parametrize("tight", [False, True])
def test_search_equals_brute_force(spark, monkeypatch, tight):
    if tight:  # many small blocks, several blocks of items
        monkeypatch.setattr(ranked, "BLOCK_DOCS", 7)
        monkeypatch.setattr(ranked, "ITEM_BLOCK_BYTES", 400)
    rng = random.Random(8)
    words = [f"w{i}" for i in range(30)] + ["Ünter", "ſo", "Don't", "a-b"]
    docs = [(i, " ".join(rng.choice(words) for _ in range(rng.randrange(0, 40)))) for i in range(120)]
    docs += [(200 + i, "w1 w2 w2 W3") for i in range(30)]  # ties
    docs += [(200, "w1 w2 w2 W3"), (7, "w4"), (None, "w1 w2 w2 W3"), (300, None), (301, ""), (302, "-- !"), (303, "w5 " * 30_000)]
    items = [(i, " ".join(rng.choice(words) for _ in range(rng.randrange(1, 12)))) for i in range(30)]
    items += [(50, "w1 w2 w2 w3"), (51, "nowhere"), (52, ""), (53, None), (54, "w1 w1 w1"), (55, "w5")]
    got = ranked.rank(spark.createDataFrame([(*d, "x", "y") for d in docs], KIND), spark.createDataFrame([(*i, "z") for i in items], ITEMS), 10)
    assert sorted(map(tuple, got.collect()), key=lambda r: r[:2]) == brute(docs, [i for i in items if i[1]], 10)


def test_empty_tables(spark):
    docs, items = spark.createDataFrame([], KIND), spark.createDataFrame([(1, "w1", "z")], ITEMS)
    assert ranked.rank(docs, items).count() == 0
    assert ranked.rank(spark.createDataFrame([(1, "w1", "x", "y")], KIND), spark.createDataFrame([], ITEMS)).count() == 0
    twice = ranked.rank(spark.createDataFrame([(1, "w1", "x", "y"), (2, "w2", "x", "y")], KIND), items.union(items))
    assert sorted(map(tuple, twice.collect())) == [(1, 1, 1, brute([(1, "w1"), (2, "w2")], [(1, "w1")], 1)[0][3])] * 2
