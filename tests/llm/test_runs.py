"""Periodic runs against a brute-force search, and the contract's digests."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import types as T

from tessera.llm import catalog, runs

SMALL = "/root/testdata/sf0.001"


def brute_runs(words):
    """``start, length, period`` of every run, from the definition."""
    n, out = len(words), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i < n - q:
            s = i
            while i < n - q and words[i] == words[i + q]:
                i += 1
            e = i + q
            if i > s and e - s >= max(6, 4 * q) and not any(all(words[j] == words[j + p] for j in range(s, e - p)) for p in range(1, q)):
                out.append((s, e - s, q))
            i += i == s
    return sorted(out, key=lambda r: (r[0], r[2]))


def brute_row(doc_id, text):
    words = (text or "").encode().split()
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = brute_runs(words)
    gone = {i for s, size, q in found for i in range(s + q, s + size)}
    top = min(found, key=lambda r: (-r[1], r[0], r[2])) if found else (None,) * 3
    listed = "".join(f"{s},{size},{q}\n" for s, size, q in found)
    return (
        doc_id, len(found), *top, 1000 * top[1] // top[2] if found else None, hashlib.sha256(listed.encode()).hexdigest(),
        hashlib.sha256(b" ".join(w for i, w in enumerate(words) if i not in gone)).hexdigest(),
    )


def odd_words(rng):
    size, kinds = rng.randrange(0, 100), rng.choice([1, 2, 2, 3, 5, 50])
    if rng.random() < 0.3:
        return [rng.randrange(kinds) for _ in range(size)]
    words = []
    while len(words) < size:
        part = [rng.randrange(kinds) for _ in range(rng.randrange(1, rng.choice([3, 8, 20, 30])))]
        words += part * rng.choice([1, 3, 4, 5, 9])
        if rng.random() < 0.4:
            words.append(rng.randrange(100))
        if rng.random() < 0.3:
            words = words[: -rng.randrange(1, 3)]
    return words * rng.choice([1, 1, 1, 4, 5])


def listed(texts):
    return [[*zip(s.tolist(), (e - s).tolist(), q.tolist())] for _, s, e, q in runs.batch_runs([" ".join(map(str, t)).encode() for t in texts])]


def test_runs_equal_brute_force():
    rng = random.Random(3)
    for _ in range(250):
        texts = [odd_words(rng) for _ in range(rng.randrange(1, 5))]
        assert listed(texts) == [brute_runs(t) for t in texts]


def test_a_hash_that_lies_is_found_out(monkeypatch):
    """With few hash values most stretches look equal; the words themselves decide."""
    monkeypatch.setattr(runs, "scrambled", lambda x: x.astype(np.uint64) & np.uint64(1))
    rng = random.Random(5)
    for _ in range(60):
        texts = [odd_words(rng)[:60] for _ in range(2)]
        for got, words in zip(listed(texts), texts):
            assert all(words[i] == words[i + q] for s, n, q in got for i in range(s, s + n - q))


def test_grammar_derives_the_texts():
    rng = random.Random(4)
    for _ in range(50):
        texts = [odd_words(rng) for _ in range(3)]
        ids, text = [], []
        for t, words in enumerate(texts):
            ids += [101 * t + w for w in words]
            text += [t] * len(words)
        g = runs.Grammar(np.array(ids, np.int64), np.array(text, np.int64))

        def words_of(symbol):
            if symbol < g.terminals:
                return [symbol]
            return words_of(g.left[symbol - g.terminals]) + words_of(g.right[symbol - g.terminals])

        assert [w for s in g.row for w in words_of(s)] == ids
        pairs = [(a, b) for a, b, p, q in zip(g.row, g.row[1:], g.start, g.start[1:]) if text[p] == text[q]]
        left_over = {p: [i for i, x in enumerate(pairs) if x == p] for p in set(pairs)}
        assert all(len(at) == 1 for at in left_over.values())
        for rule, at in enumerate(g.at):
            size = g.size[g.terminals + rule]
            assert ids[at : at + size] == words_of(g.terminals + rule)


def test_long_periodic_texts_shrink():
    for words in (["a"] * 300_000, [f"w{i}" for i in range(30_000)] * 10, ["a", "b", "c"] * 50_000 + ["z"]):
        ((_, s, e, q),) = runs.batch_runs([" ".join(words).encode()])
        period = len(dict.fromkeys(words[:-1]))
        assert list(zip(s, e, q)) == [(0, len(words) - (words[-1] == "z"), 1 if words[0] == words[1] else period if words[-1] != "z" else 3)]
        ids = np.unique(words, return_inverse=True)[1].astype(np.int64)
        if period < 10:
            assert len(runs.Grammar(ids, np.zeros(len(ids), np.int64)).row) < 60


def test_digests_equal_brute_force(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    got = {r["doc_id"]: tuple(r) for r in catalog.QUERIES["op13_runs"](spark, SMALL).collect()}
    want = {r["doc_id"]: brute_row(r["doc_id"], r["text"]) for r in docs.collect() if len(r["text"] or "") < 12_000}
    assert len(got) == docs.count()
    assert {d: got[d] for d in want} == want
    assert any(r[1] for r in want.values())


@pytest.mark.parametrize("rows", [[], [(1, None), (2, ""), (3, " \n\t"), (None, "a " * 20), (5, "a " * 20), (5, "a " * 20), (30, "x y " * 9 + "z")]])
def test_odd_rows(spark, rows):
    kind = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("h", T.StringType()), T.StructField("runs", T.StringType())])
    docs = spark.createDataFrame([(*r, "clash", None) for r in rows], kind)
    got = sorted((tuple(r) for r in runs.run_digests(docs).collect()), key=lambda r: (r[0] is None, r[0]))
    want = sorted((brute_row(i, t) if i is not None else (None, *brute_row(1, t)[1:]) for i, t in rows), key=lambda r: (r[0] is None, r[0]))
    assert got == want
    plain = {(r["doc_id"], len(r["runs"]), r["collapsed"]) for r in runs.find_runs(docs).collect()}
    assert not rows or {(5, 1, "a"), (30, 1, "x y z"), (1, 0, "")} <= plain
