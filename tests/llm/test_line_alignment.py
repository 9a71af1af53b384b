"""The alignment of passages: against the definition, and what it alone finds."""

import random

import numpy as np
import pytest

from tessera.llm import line_dedup as L


def brute(later, earlier, n):
    """Words of ``later`` in a run of n words that ``earlier`` has."""
    there = {tuple(earlier[i : i + n]) for i in range(len(earlier) - n + 1)}
    out = [False] * len(later)
    for i in range(len(later) - n + 1):
        if tuple(later[i : i + n]) in there:
            out[i : i + n] = [True] * n
    return out


def document(rng, parts):
    words = []
    for _ in range(rng.randrange(1, 8)):
        part = rng.choice(parts)
        a = rng.randrange(0, max(1, len(part) - 5))
        words += part[a : a + rng.choice([10, 30, 45, 50, 51, 52, 80, 300])]
        words += [f"own{rng.randrange(10**6)}" for _ in range(rng.choice([0, 1, 5]))]
    return words


@pytest.mark.parametrize("passes", [1, 8])
def test_alignment_of_a_pair_equals_the_definition(monkeypatch, passes):
    monkeypatch.setattr(L, "PASSES", passes)
    rng = random.Random(passes)
    for k in range(150):
        parts = [[f"p{k}.{i}" for i in range(200)], [f"q{i % 7}" for i in range(120)], ["a"] * 90, [f"r{rng.randrange(40)}" for _ in range(150)]]
        later, earlier = document(rng, parts), document(rng, parts)
        a, b = (L.Words("\n".join(w), 30, 22) for w in (later, earlier))
        covered, left = L.aligned_words(a, b, 30, 51)
        assert covered.tolist() == brute(later, earlier, 51)
        assert set(left) <= set(a.keys.tolist()) & set(b.keys.tolist())


def test_runs_of_every_length(spark):
    """From 51 words on a shared run goes, whatever its hashes are; shorter ones stay."""
    rng = random.Random(2)
    rows, want = [], {}
    for size in (30, 40, 49, 50, 51, 52, 70):
        for _ in range(25):
            run = [f"s{rng.randrange(10**9)}" for _ in range(size)]
            d = len(rows)
            own = lambda: [f"o{rng.randrange(10**9)}" for _ in range(rng.randrange(0, 40))]
            rows += [(d, " ".join(own() + run + own())), (d + 1, " ".join(own() + run + own()))]
            want |= {d: 0, d + 1: size if size > 50 else 0}
    got = L.dedup_lines(spark.createDataFrame(rows, "doc_id bigint, text string"), passage=51).collect()
    assert {r["doc_id"]: r["removed_words"] for r in got} == want


def test_a_passage_whose_key_an_earlier_document_holds_in_part(spark):
    """The first holder has 40 words of it only, so the pair with it leaves the key open."""
    p = [f"s{i}" for i in range(70)]
    rows = []
    for at in range(0, 31, 5):
        q = [f"{w}.{at}" for w in p]
        rows += [(10 * at + 1, " ".join(["x", *q[at : at + 40], "y"])), (10 * at + 2, " ".join(["z", *q, "u"])), (10 * at + 3, " ".join(["v", *q, "w"]))]
    got = {r["doc_id"]: r["text"] for r in L.dedup_lines(spark.createDataFrame(rows, "doc_id bigint, text string"), passage=51).collect()}
    assert all(got[d] == t for d, t in rows if d % 10 < 3)
    assert all(got[d] == "v w" for d, _ in rows if d % 10 == 3)


def test_nothing_goes_without_the_alignment(spark, monkeypatch):
    p = " ".join(f"s{i}" for i in range(60))
    docs = spark.createDataFrame([(1, f"a {p} b"), (2, f"c {p} d")], "doc_id bigint, text string")
    assert sum(r["removed_words"] for r in L.dedup_lines(docs, passage=51).collect()) == 60
    pairs = spark.createDataFrame([], "d bigint, th bigint, spans array<int>, open array<bigint>")
    monkeypatch.setattr(L, "aligned", lambda *args: pairs)
    assert sum(r["removed_words"] for r in L.dedup_lines(docs, passage=51).collect()) == 0


def test_a_hot_passage_is_paired_with_its_first_holder_only(spark, monkeypatch):
    for hot in (2000, 3):  # below and above the broadcast of first holders
        monkeypatch.setattr(L, "HOT_KEY", hot)
        p = " ".join(f"s{i}" for i in range(55))
        docs = spark.createDataFrame([(i, f"own{i} {p} end{i}") for i in range(40)] + [(None, p), (50, None), (51, ""), (7, f"own7 {p} end7")], "doc_id bigint, text string")
        got = L.dedup_lines(docs, passage=51).collect()
        assert sorted(r["removed_words"] for r in got) == [0] * 4 + [55] * 40
        keyed = spark.createDataFrame([(1, i, 0) for i in range(40)], "k bigint, d bigint, th bigint")
        assert {tuple(r) for r in L.first_pairs(keyed, "t").collect()} == {(i, 0, 0, 0) for i in range(1, 40)}


def test_moved_passages_in_any_order():
    rng = random.Random(5)
    parts = [[f"{i}.{j}" for j in range(60)] for i in range(40)]
    order = parts[::-1]
    rng.shuffle(order)
    a, b = (L.Words(" ".join(w for p in x for w in p), 30, 22) for x in (order, parts))
    assert L.aligned_words(a, b, 30, 51)[0].all()
    assert not L.aligned_words(L.Words("", 30, 22), b, 30, 51)[0].any() and not L.aligned_words(a, L.Words("", 30, 22), 30, 51)[0].any()


def test_repeated_words_are_compared_in_linear_time():
    a, b = L.Words("a " * 50 + "b " + "a " * 50, 30, 22), L.Words("c " + "a " * 200_000, 30, 22)
    assert not L.aligned_words(a, b, 30, 51)[0].any()
    assert L.aligned_words(L.Words("a " * 100_000, 30, 22), b, 30, 51)[0].all()


def test_spans():
    assert L.spans_of(np.array([True, True, False, True])) == [0, 2, 3, 4] and L.spans_of(np.zeros(0, bool)) == []
    assert L.cut_text("a b\nc d", [], [1, 3]) == ("a\nd", [], 2)
