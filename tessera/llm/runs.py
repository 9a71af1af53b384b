"""Periodic run detection on grammar-compressed texts.

A run is a stretch of consecutive words with smallest period ``q`` and at least
``max(6, 4 q)`` words that no neighbouring word extends keeping that period.

1. Recursive pairing (Re-Pair) of each text's word ids, in rounds that take the texts of an
   Arrow batch side by side: of the pairs that occur more than once in their text, every
   occurrence of a pair that is more frequent than the pairs next to it becomes a
   nonterminal. Rounds go on until no pair repeats. The rules are those pairs; each text is
   left with a row of symbols. A periodic stretch of ``n`` words shrinks to a few symbols in
   ``log n`` rounds.
2. Runs that cross the boundary of a nonterminal's two halves are computed once, within its
   expansion; those that cross the boundary of two symbols of a text's row, within the text.
   Every run lies whole in the lowest node of the derivation that holds it and crosses that
   node's boundary, so none is missed. On one side of the boundary a run has ``2 q`` words
   at least, so the words at the boundary come again ``q`` words on (or back): periods
   below 8 are tried directly, longer ones are the distances of equal fingerprints of ``2**k``
   words for ``q`` in ``[2**k, 2**(k + 1))``. How far a period holds is found by bisection over a
   prefix hash, and proved by comparing the words.
3. A nonterminal's runs are translated to every position that derives it, from the texts'
   rows downwards, and only through nonterminals that have a run below them.
4. Stretches of one text and period that overlap by the period are merged; of equal
   stretches the smallest period stays.

Everything is numpy over a batch of a few MB; a text is never cut, so memory follows the
longest text. No shuffle: each row's result depends on its text (and id) alone.

Results for odd input: a null, empty or blank text has no words, no run and the digests of
nothing; a null id alters nothing; repeated rows get equal results; other columns are not
read.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import release, small_batches

#: Shortest run, and how many periods it has at least.
MIN_LENGTH, EXPONENT = 6, 4
#: Periods tried directly at every boundary; longer ones come from fingerprints.
DIRECT = 8
BASE = np.uint64(0x9E3779B97F4A7C15)


def scrambled(x: np.ndarray) -> np.ndarray:
    x = (x.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


class Grammar:
    """Recursive pairing of the words of some texts, each with symbols of its own.

    ``size[s]`` is the length of symbol ``s``; rule ``r`` is the symbol ``terminals + r`` with
    halves ``left[r]``, ``right[r]`` and derives the words from ``at[r]`` on, among others.
    ``row`` and ``start`` are the symbols left over and their first words; ``repeats`` tells of
    each word whether it and the next one come again together. Input: the word ids of all
    texts (no two texts share one) and the text of each word (ascending).
    """

    def __init__(self, words: np.ndarray, text: np.ndarray):
        self.words, self.text = words, text
        self.terminals = int(words.max()) + 1 if len(words) else 0
        self.size = np.ones(self.terminals, np.int64)
        self.left = self.right = self.at = np.zeros(0, np.int64)
        self.row, self.start = words.astype(np.int64), np.arange(len(words))
        self.live = np.arange(max(0, len(words) - 1))  # places of ``row`` whose pair may come again
        self.repeats: np.ndarray | None = None
        while self._round():
            pass

    def _round(self) -> bool:
        row, known, live = self.row, len(self.size), self.live
        pair = row[live] * known + row[live + 1]
        order = np.argsort(pair, kind="stable")
        ranked = pair[order]
        begins = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]])) if len(ranked) else np.zeros(0, np.int64)
        count = np.diff(np.concatenate([begins, [len(ranked)]]))
        kind = np.empty(len(live), np.int64)
        kind[order] = np.repeat(np.arange(len(count)), count)
        if self.repeats is None:
            self.repeats = np.concatenate([count[kind] > 1, [False]])[: len(row)]
        # a pair that comes once never comes again
        again = count[kind] > 1
        live, kind = live[again], kind[again]
        if not len(live):
            return False
        # more frequent first, a hash of the pair next: the same choice wherever the neighbours are the same
        by_rank = np.lexsort((scrambled(ranked[begins]), count))
        place = np.empty(len(count), np.int64)
        place[by_rank] = np.arange(len(count))
        rank = np.full(len(row) + 1, -1)  # of the pair after each place, -1 for none
        rank[live + 1] = place[kind]
        # a stretch of equal pairs (a a a ...) is taken if it is above the pairs beside it: every second pair
        same = np.concatenate([[False], (live[1:] == live[:-1] + 1) & (kind[1:] == kind[:-1])])
        low = np.flatnonzero(~same)
        high = np.concatenate([low[1:], [len(live)]]) - 1
        mine = place[kind[low]]
        after = np.where(live[high] + 2 < len(rank), rank[np.minimum(live[high] + 2, len(rank) - 1)], -1)
        wins = (mine > rank[live[low]]) & (mine > after)
        stretch = np.cumsum(~same) - 1
        take = wins[stretch] & ((np.arange(len(live)) - low[stretch]) % 2 == 0)
        spots = live[take]
        _, lead, number = np.unique(kind[take], return_index=True, return_inverse=True)
        lead = spots[lead]
        self.left = np.concatenate([self.left, row[lead]])
        self.right = np.concatenate([self.right, row[lead + 1]])
        self.at = np.concatenate([self.at, self.start[lead]])
        self.size = np.concatenate([self.size, self.size[row[lead]] + self.size[row[lead + 1]]])
        row[spots] = known + number
        stay = np.ones(len(row), bool)
        stay[spots + 1] = False
        check = np.zeros(len(row), bool)  # pairs that came again, and those beside a new symbol
        check[live] = True
        check[spots] = True
        check[np.maximum(spots - 1, 0)] = True
        check = check[stay]
        self.row, self.start = row[stay], self.start[stay]
        self.live = np.flatnonzero(check[:-1])
        return True

    def boundaries(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """``lo, c, hi, rule``: the boundary before word ``c`` within words ``lo`` to ``hi``, of every
        rule, and of every two neighbours left in a text (rule -1)."""
        middle = self.at + self.size[self.left]
        c = self.start[1:][self.text[self.start[1:]] == self.text[self.start[:-1]]]
        edges = np.flatnonzero(np.concatenate([[True], self.text[1:] != self.text[:-1], [True]]))
        lo = edges[np.searchsorted(edges, c, "right") - 1]
        hi = edges[np.searchsorted(edges, c, "right")]
        rules = np.arange(len(self.at))
        return (
            np.concatenate([self.at, lo]), np.concatenate([middle, c]), np.concatenate([self.at + self.size[self.terminals :], hi]),
            np.concatenate([rules, np.full(len(c), -1)]),
        )

    def derivations(self, rules: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``rule, first word`` of every place where one of ``rules`` is derived."""
        bears = np.zeros(len(self.size), bool)
        bears[self.terminals + rules] = True
        below = bears.copy()
        while True:  # as many passes as the grammar is deep
            more = below[self.left] | below[self.right]
            if not (more & ~below[self.terminals :]).any():
                break
            below[self.terminals :] |= more
        symbol, place = self.row[below[self.row]], self.start[below[self.row]]
        found: list[tuple[np.ndarray, np.ndarray]] = []
        while len(symbol):
            hit = bears[symbol]
            found.append((symbol[hit] - self.terminals, place[hit]))
            symbol, place = symbol[symbol >= self.terminals], place[symbol >= self.terminals]
            left, right = self.left[symbol - self.terminals], self.right[symbol - self.terminals]
            symbol, place = np.concatenate([left, right]), np.concatenate([place, place + self.size[left]])
            symbol, place = symbol[below[symbol]], place[below[symbol]]
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return tuple(np.concatenate(c) for c in zip(*found))


class Prefix:
    """Hashes of stretches of words from one prefix hash (modulo 2**64, odd base)."""

    def __init__(self, words: np.ndarray):
        n = len(words)
        inverse = np.uint64(pow(int(BASE), -1, 1 << 64))
        self.power = np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, BASE)]), dtype=np.uint64)
        self.back = np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, inverse)]), dtype=np.uint64)
        self.sum = np.concatenate([[np.uint64(0)], np.cumsum(scrambled(words) * self.power[:-1], dtype=np.uint64)])

    def of(self, start: np.ndarray, size) -> np.ndarray:
        return (self.sum[start + size] - self.sum[start]) * self.back[start]

    def equal(self, start: np.ndarray, shift: np.ndarray, size) -> np.ndarray:
        """Whether ``size`` words from ``start`` equal those ``shift`` further on."""
        return (self.sum[start + size] - self.sum[start]) * self.power[shift] == self.sum[start + shift + size] - self.sum[start + shift]


def held(test, most: np.ndarray) -> np.ndarray:
    """Largest ``x`` in ``[0, most]`` for which ``test`` holds (it holds at 0, and below every ``x`` for which it does)."""
    low, high = np.zeros_like(most), most.copy()
    while (low < high).any():
        middle = (low + high + 1) // 2
        good = test(middle)
        low, high = np.where(good, middle, low), np.where(good, high, middle - 1)
    return low


def candidates(
    words: np.ndarray, repeats: np.ndarray, prefix: Prefix, lo: np.ndarray, c: np.ndarray, hi: np.ndarray, known: np.ndarray
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """``node, q, i``: a boundary, a period and the first of ``q + 1`` words that equal those ``q`` further on, for all
    runs that cross the boundary (and for stretches that turn out too short), by ascending period.

    ``known`` is the longest run (start, end, period) found for each boundary so far, kept by the caller: ``2 q + 1``
    words within a run of period ``q`` or less are no new run, so they are passed over.
    """

    def news(node: np.ndarray, q: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        new = (first < known[0, node]) | (first + 2 * q + 1 > known[1, node]) | (q < known[2, node])
        node, q, first = node[new], q[new], first[new]
        good = prefix.equal(first, q, q + 1)
        return node[good], q[good], first[good]

    for q in range(1, DIRECT):
        if len(words) <= q:
            break
        same = words[:-q] == words[q:]
        for first, ok in ((c - 1, c + 2 * q <= hi), (c - 2 * q, c - 2 * q >= lo)):  # q + 1 words hold, after or before the boundary
            node = np.flatnonzero(ok & (hi - lo >= max(MIN_LENGTH, EXPONENT * q)))
            for j in range(min(q + 1, 3)):
                node = node[same[first[node] + j]]
            yield news(node, np.full(len(node), q), first[node])
    # longer periods: positions whose 2**k words come again, level by level
    size = DIRECT
    alone = np.cumsum(np.concatenate([[0], ~repeats]))
    spots = np.arange(max(0, len(words) - size + 1))
    spots = spots[alone[spots + size - 1] == alone[spots]]  # all pairs in the stretch come again
    nodes = np.flatnonzero(hi - lo >= EXPONENT * size)
    while len(nodes):
        spots = spots[spots + size <= len(words)]
        if not len(spots):
            break
        # positions by (fingerprint, position); those that come once go (texts share no word)
        name = prefix.of(spots, size)
        order = np.argsort(name, kind="stable")
        spots, name = spots[order], name[order]
        again = np.concatenate([[False], name[1:] == name[:-1]])
        again |= np.concatenate([again[1:], [False]])
        spots, name = spots[again], name[again]
        if not len(spots):
            break
        group = np.cumsum(np.concatenate([[True], name[1:] != name[:-1]])) - 1
        span = len(words) + 1
        ranked = group * span + spots
        group_of = np.full(len(words), -1)
        group_of[spots] = group
        for side in (1, -1):  # the words after the boundary come again further on; those before it, further back
            x = np.maximum(c[nodes] - 1, 0) if side > 0 else np.maximum(c[nodes] - size + 1, 0)
            room = hi[nodes] - c[nodes] if side > 0 else c[nodes] - lo[nodes]
            far = np.minimum(2 * size - 1, room // 2)
            edge = (c[nodes] - 1, c[nodes] + 2 * far) if side > 0 else (c[nodes] - 2 * far, c[nodes] + 1)
            good = (far >= size) & (group_of[x] >= 0) & ((edge[0] < known[0, nodes]) | (edge[1] > known[1, nodes]) | (size < known[2, nodes]))
            node, x, far = nodes[good], x[good], far[good]
            near, end = (x + size, x + far) if side > 0 else (x - far, x - size)
            base = group_of[x] * span
            a = np.searchsorted(ranked, base + np.maximum(near, 0), "left")
            b = np.searchsorted(ranked, base + np.minimum(np.maximum(end, -1), span - 1), "right")
            many = np.maximum(b - a, 0)
            which = np.repeat(np.arange(len(many)), many)
            hits = spots[np.arange(len(which)) - np.repeat(np.cumsum(many) - many, many) + np.repeat(a, many)]
            q = np.abs(hits - x[which])
            at = node[which]
            yield news(at, q, c[at] - 1 if side > 0 else c[at] - 2 * q)
        spots = np.sort(spots)
        size *= 2
        nodes = nodes[hi[nodes] - lo[nodes] >= EXPONENT * size]


def crossing_runs(words: np.ndarray, repeats: np.ndarray, lo: np.ndarray, c: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, ...]:
    """``node, start, end, q`` of the stretches with enough words of smallest period ``q`` that cross a boundary."""
    prefix = Prefix(words)
    known = np.stack([np.full(len(c), len(words)), np.zeros(len(c), np.int64), np.zeros(len(c), np.int64)])
    parts = [(np.zeros(0, np.int64),) * 5]
    for node, q, i in candidates(words, repeats, prefix, lo, c, hi, known):
        # from word i on, and before it, the words equal those q further on: as far as possible
        ahead = held(lambda size: prefix.equal(i, q, size), hi[node] - q - i)
        behind = held(lambda size: prefix.equal(i - size, q, size), i - lo[node])
        start, end = i - behind, i + ahead + q
        good = end - start >= np.maximum(MIN_LENGTH, EXPONENT * q)
        parts.append((node[good], start[good], end[good], q[good], i[good]))
        best = np.stack([start[good], end[good], q[good]])
        order = np.argsort(best[1] - best[0], kind="stable")  # the longest last
        best, node = best[:, order], node[good][order]
        longer = best[1] - best[0] > known[1, node] - known[0, node]
        known[:, node[longer]] = best[:, longer]
    node, start, end, q, i = (np.concatenate(p) for p in zip(*parts))

    def least(*columns: np.ndarray) -> tuple[np.ndarray, ...]:  # of equal stretches the smallest period
        order = np.lexsort((columns[3], columns[2], columns[1], columns[0]))
        node, start, end, *_ = columns = [x[order] for x in columns]
        new = np.concatenate([[True], (node[1:] != node[:-1]) | (start[1:] != start[:-1]) | (end[1:] != end[:-1])])
        return tuple(x[new[: len(node)]] for x in columns)

    found = least(node, start, end, q)
    proved = all(np.array_equal(words[s : e - p], words[s + p : e]) for s, e, p in zip(*(x.tolist() for x in found[1:])))
    if not proved:  # two stretches share a hash: the plain comparison of every candidate
        for k in range(len(q)):
            p, low, high = int(q[k]), int(lo[node[k]]), int(hi[node[k]])
            wrong = np.flatnonzero(words[low : high - p] != words[low + p : high]) + low
            start[k] = int(wrong[wrong < i[k]].max(initial=low - 1)) + 1
            end[k] = int(wrong[wrong >= i[k]].min(initial=high - p)) + p
        good = end - start >= np.maximum(MIN_LENGTH, EXPONENT * q)
        found = least(node[good], start[good], end[good], q[good])
    return found


def runs_of(words: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``start, end, q`` of all runs of all texts, by start and period. ``words`` are word ids from 0
    (no two texts share one), ``text`` the (ascending) number of each word's text."""
    grammar = Grammar(words, text)
    lo, c, hi, rule = grammar.boundaries()
    node, start, end, q = crossing_runs(words, grammar.repeats, lo, c, hi)
    whole = rule[node] < 0
    parts = [(start[whole], end[whole], q[whole])]
    node, start, end, q = node[~whole], start[~whole], end[~whole], q[~whole]
    if len(node):
        used, place = grammar.derivations(np.unique(rule[node]))
        order = np.argsort(rule[node], kind="stable")
        held_by = rule[node][order]
        a, b = np.searchsorted(held_by, used, "left"), np.searchsorted(held_by, used, "right")
        which = np.repeat(np.arange(len(used)), b - a)
        run = order[np.arange(len(which)) - np.repeat(np.cumsum(b - a) - (b - a), b - a) + np.repeat(a, b - a)]
        move = place[which] - grammar.at[used[which]]
        parts.append((start[run] + move, end[run] + move, q[run]))
    start, end, q = (np.concatenate(p) for p in zip(*parts))
    if not len(start):
        return start, end, q
    # merge by text and period (words of one period that overlap by it are one run)
    order = np.lexsort((end, start, q, text[start]))
    start, end, q = start[order], end[order], q[order]
    key = text[start] * (int(q.max()) + 1) + q
    fresh = np.concatenate([[True], key[1:] != key[:-1]])
    part = np.cumsum(fresh) - 1
    reach = np.maximum.accumulate(end + part * (len(words) + 1)) - part * (len(words) + 1)  # furthest end so far, within the key
    fresh[1:] |= start[1:] > reach[:-1] - q[1:]
    first = np.flatnonzero(fresh)
    start, q, end = start[first], q[first], np.maximum.reduceat(end, first)
    # of equal stretches the smallest period
    order = np.lexsort((q, end, start))
    start, end, q = start[order], end[order], q[order]
    least = np.concatenate([[True], (start[1:] != start[:-1]) | (end[1:] != end[:-1])])
    start, end, q = start[least], end[least], q[least]
    order = np.lexsort((q, start))
    return start[order], end[order], q[order]


def altered(n: int, h: int) -> np.ndarray | None:
    """The contract's altered order of ``n`` words: from word ``a`` on they repeat with period ``p``."""
    g = h // 10
    if h % 10 or not n:
        return None
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    i = np.arange(n)
    return np.where(i < a, i, a + (i - a) % p)


def batch_runs(texts: list[bytes], orders: list | None = None) -> Iterator[tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray]]:
    """Words, and ``start, end, q`` of the runs, of each text (words taken in ``orders`` where given)."""
    split, ids, sizes, known = [], [], [], 0
    for t, raw in enumerate(texts):
        words = raw.split()  # cuts bytes at exactly the six ASCII white-space characters
        number = {w: i for i, w in enumerate(dict.fromkeys(words), known)}
        known += len(number)
        coded = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
        order = orders[t](len(words)) if orders else None
        if order is not None:
            words, coded = [words[i] for i in order.tolist()], coded[order]
        split.append(words)
        ids.append(coded)
        sizes.append(len(words))
    words = np.concatenate(ids) if ids else np.zeros(0, np.int64)
    begin = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    start, end, q = runs_of(words, np.repeat(np.arange(len(texts)), sizes))
    cut = np.searchsorted(start, begin)
    for t, s in enumerate(split):
        own = slice(cut[t], cut[t + 1])
        yield s, start[own] - begin[t], end[own] - begin[t], q[own]


def kept_words(words: list[bytes], start: np.ndarray, end: np.ndarray, q: np.ndarray) -> list[bytes]:
    """The words without those of a run beyond its first period."""
    if not len(start):
        return words
    step = np.zeros(len(words) + 1, np.int64)
    np.add.at(step, start + q, 1)
    np.add.at(step, end, -1)
    return [words[i] for i in np.flatnonzero(np.cumsum(step)[:-1] == 0).tolist()]


def _described(words: list[bytes], start: np.ndarray, end: np.ndarray, q: np.ndarray) -> tuple:
    size = end - start
    best = (None,) * 4
    if len(start):
        k = int(np.lexsort((q, start, -size))[0])
        best = (int(start[k]), int(size[k]), int(q[k]), 1000 * int(size[k]) // int(q[k]))
    listed = "".join(f"{s},{n},{p}\n" for s, n, p in zip(start.tolist(), size.tolist(), q.tolist()))
    left = b" ".join(kept_words(words, start, end, q))
    return len(start), *best, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(left).hexdigest()


def _raw(column: pa.Array) -> list[bytes]:
    return [b"" if t is None else t for t in column.cast(pa.binary()).to_pylist()]


def find_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, ``runs`` (array of start, length, period) and ``collapsed`` (the kept words joined by
    a blank) of every whole text."""

    def run(batches):
        release()
        for batch in batches:
            out = [([{"start": s, "length": e - s, "period": p} for s, e, p in zip(a.tolist(), b.tolist(), c.tolist())], b" ".join(kept_words(w, a, b, c)))
                   for w, a, b, c in batch_runs(_raw(batch.column(1)))]
            kind = pa.list_(pa.struct([(n, pa.int64()) for n in ("start", "length", "period")]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([r for r, _ in out], kind), pa.array([t.decode("utf-8", "replace") for _, t in out], pa.string())],
                names=[id_col, "runs", "collapsed"],
            )

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).transform(small_batches).mapInArrow(
        run, f"`{id_col}` {kind}, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string"
    )


def run_digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The contract's row per document: its words altered by the id's checksum, then the number of
    runs, the longest run and digests of all runs and of the kept words."""
    checksum = F.crc32(F.col(id_col).cast("string").cast("binary"))

    def order(h):
        return lambda n: None if h is None else altered(n, h)

    def run(batches):
        release()
        for batch in batches:
            rows = [_described(*r) for r in batch_runs(_raw(batch.column(1)), [order(h) for h in batch.column(2).to_pylist()])]
            cols = list(zip(*rows)) or [()] * 7
            kinds = [pa.int64()] * 5 + [pa.string()] * 2
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, k) for c, k in zip(cols, kinds))], names=["doc_id", *DIGESTS])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), checksum.alias("h")).transform(small_batches).mapInArrow(
        run, f"doc_id {kind}, " + ", ".join(f"{c} {'string' if c.endswith('sha256') else 'bigint'}" for c in DIGESTS)
    )


DIGESTS = ["n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
