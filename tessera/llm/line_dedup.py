"""Line dedup by pairwise alignment.

Words go that are in a run of ``passage`` words (51) that an earlier document has too, line ends
aside; no other word goes. No such run is left: all of it goes if the first document with its key
has it whole (always so where two documents, or any number, share one passage), and ``min_words`` of it
at least where three documents overlap in different parts of it.

1. Rare keys. Of every ``passage - min_words + 1`` neighbouring windows of ``min_words`` words the least
   hash is a key, so any common run of ``passage`` words has one in both documents. Each key
   names the first document that has it; a document is paired with the first holders of its
   keys, so a passage in a million documents makes a million pairs at most, never all pairs.
2. Patience diff. The keys that are unique in both documents of a pair are chained in their longest common
   order; each is grown word by word to both sides, and grown blocks of at least
   ``passage`` words are deleted from the later document. Passes repeat on what is not covered
   (moved passages); keys that come several times are settled by comparing the windows of ``passage``
   words around them.
3. Keys whose common run with their first holder is shorter than a passage are left open. Documents that
   hold an open key are paired once more, by the windows of ``passage`` words around it (again
   with the first holder of each), and aligned the same way. So a passage is found in the first
   document that has it even if a still earlier one has a part of it.

Without ``passage`` whole lines only are compared: a key is the shortest run of lines of at least
``min_words`` words from or to a line, pairs are aligned by patience diff on line hashes, and the
aligned common blocks of at least ``min_words`` words are deleted from the later document; so is
every run of a key that the pair shares, wherever it was moved or repeated.

"Earlier" is by id, then by a hash of the text; documents are compared as they were, so every
deleted passage stays in the first document that has it (less what a still earlier one
has). Results for odd input: null and empty texts and rows without an id stay as they are;
rows that repeat both id and text share their fate; lines are compared without white space
at their ends; blank lines go between two deleted lines only; where words go from within a
line, its other words stay, joined by a blank.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import BROADCAST_IDS, fresh, materialize, release, small, small_batches

MIN_WORDS = 30
#: Shortest common run of words that goes, wherever it starts: over 50.
PASSAGE = 51
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")
_GAP = re.compile(rb"[\x20\x09-\x0D]")


def line_hashes(text: str) -> tuple[list[int], list[int]]:
    """Hash and word count of every line; a blank line has hash 0."""
    hashes, words = [], []
    for line in text.encode("utf-8", "replace").split(b"\n"):
        line = line.strip()
        hashes.append(xxhash.xxh64_intdigest(line) - (1 << 63) if line else 0)
        words.append(len(line.split()))
    return hashes, words


def passage_runs(hashes: list[int], words: list[int], min_words: int) -> list[tuple[int, int, int]]:
    """``(key, start, end)`` of the shortest runs with enough words from each line, and of
    those to each line; no line is blank."""
    raw = np.array(hashes, np.int64).tobytes()
    upto = np.concatenate([[0], np.cumsum(np.array(words, np.int64))])
    # first end for each start, last start for each end
    ends = np.searchsorted(upto, upto[:-1] + min_words)
    starts = np.searchsorted(upto, upto[1:] - min_words, "right") - 1
    spans = {(s, e) for s, e in enumerate(ends.tolist()) if e <= len(hashes)} | {(s, e + 1) for e, s in enumerate(starts.tolist()) if s >= 0}
    return [(xxhash.xxh64_intdigest(raw[8 * s : 8 * e]) - (1 << 63), s, e) for s, e in sorted(spans)]


def passage_keys(hashes: list[int], words: list[int], min_words: int) -> list[int]:
    """Hash of the shortest run with enough words from each line that is not blank."""
    at = [i for i, w in enumerate(words) if w]
    firsts = {s: k for k, s, _ in reversed(passage_runs([hashes[i] for i in at], [words[i] for i in at], min_words))}
    return [firsts[s] for s in sorted(firsts)]


def all_keys(hashes: list[int], words: list[int], min_words: int) -> list[int]:
    """Distinct keys of a document: shortest runs from each line and to each line."""
    at = [i for i, h in enumerate(hashes) if h]
    return list(dict.fromkeys(k for k, _, _ in passage_runs([hashes[i] for i in at], [words[i] for i in at], min_words)))


def patience(later: list[int], earlier: list[int]) -> dict[int, int]:
    """Matched lines (later index to earlier index) of one patience pass: lines unique
    in both, longest increasing chain, extended while the neighbours are equal."""
    def unique(lines: list[int]) -> dict[int, int]:
        seen: dict[int, int] = {}
        for i, h in enumerate(lines):
            if h:
                seen[h] = -1 if h in seen else i
        return {h: i for h, i in seen.items() if i >= 0}

    there = unique(earlier)
    pairs = [(i, there[h]) for h, i in unique(later).items() if h in there]
    if not pairs:  # only repeated lines are shared: pair their n-th occurrences
        spots: dict[int, list[int]] = {}
        for j, h in enumerate(earlier):
            if h:
                spots.setdefault(h, []).append(j)
        used: dict[int, int] = {}
        for i, h in enumerate(later):
            if h and used.get(h, 0) < len(spots.get(h, ())):
                pairs.append((i, spots[h][used.get(h, 0)]))
                used[h] = used.get(h, 0) + 1
    tails: list[int] = []
    last: list[int] = []
    back = [-1] * len(pairs)
    for p, (_, j) in enumerate(pairs):
        k = bisect_left(tails, j)
        back[p] = last[k - 1] if k else -1
        tails[k : k + 1] = [j]
        last[k : k + 1] = [p]
    chain, p = [], last[-1] if last else -1
    while p >= 0:
        chain.append(pairs[p])
        p = back[p]
    match: dict[int, int] = {}
    for i, j in reversed(chain):
        for step in (1, -1):
            a, b = i, j
            while 0 <= a < len(later) and 0 <= b < len(earlier) and later[a] == earlier[b] and (a == i or a not in match):
                match[a] = b
                a, b = a + step, b + step
    return match


def aligned_lines(later: list[int], words: list[int], earlier: list[int], min_words: int) -> set[int]:
    """Lines of ``later`` in aligned common blocks of at least ``min_words`` words (no
    blank lines on either side). Passes repeat on what is not deleted yet."""
    lines, gone = list(later), set()
    while True:
        match = patience(lines, earlier)
        found: set[int] = set()
        block: list[int] = []
        for i in [*sorted(match), None]:
            if block and (i is None or i != block[-1] + 1 or match[i] != match[block[-1]] + 1):
                if sum(words[b] for b in block) >= min_words:
                    found.update(block)
                block = []
            if i is not None:
                block.append(i)
        if not found:
            return gone
        gone |= found
        # a deleted line must not match, or bridge its neighbours, again
        for i in found:
            lines[i] = -(1 << 62) - i


def common_blocks(later: list[int], words: list[int], earlier: list[int], min_words: int) -> list[int]:
    """Lines of ``later`` in runs of at least ``min_words`` words that ``earlier`` has too,
    blank lines aside: the aligned blocks, and every key run of ``earlier`` (moved and
    repeated passages, whatever the alignment chose). Each line of a common run is in a
    shortest run from a start or to an end within it, so none is left."""
    at = [i for i, h in enumerate(later) if h]
    mine, n = [later[i] for i in at], [words[i] for i in at]
    theirs = [h for h in earlier if h]
    gone = aligned_lines(mine, n, theirs, min_words)
    count = dict(zip(mine, n))
    shared: set[int] = set()
    part: list[int] = []
    for h in [*theirs, None]:  # a line that only the earlier one has ends a common run
        if h in count:
            part.append(h)
        elif part:
            shared.update(k for k, _, _ in passage_runs(part, [count[x] for x in part], min_words))
            part = []
    for k, start, end in passage_runs(mine, n, min_words):
        if k in shared:
            gone.update(range(start, end))
    return sorted(line for i in gone for line in (range(at[i], at[i + 1]) if i + 1 in gone else (at[i],)))


BASE = 0x9E3779B97F4A7C15
#: Bytes hashed at once.
CHUNK = 1 << 18
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_POWERS: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the base and of its inverse (modulo 2**64)."""
    if len(_POWERS[0]) < n:
        for k, base in enumerate((BASE, pow(BASE, -1, 1 << 64))):
            _POWERS[k] = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n - 1, base, np.uint64)]), dtype=np.uint64)
    return _POWERS[0][:n], _POWERS[1][:n]


def stretch_hashes(values: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of the values from each start to each end, wherever they are."""
    up, down = powers(len(values) + 1)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values * up[:-1], dtype=np.uint64)])
    return mixed((sums[end] - sums[start]) * down[start])


def words_and_starts(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word of a UTF-8 text, and where its first byte is."""
    out, spots, at = [], [], 0
    while at < len(raw):
        to = at + CHUNK
        if to < len(raw):  # up to the next white space
            m = _GAP.search(raw, to)
            to = m.start() if m else len(raw)
        part = np.frombuffer(raw, np.uint8, min(to, len(raw)) - at, at)
        gap = np.concatenate([[True], _SPACE[part], [True]])
        edge = np.flatnonzero(gap[:-1] != gap[1:])
        start, end = edge[::2], edge[1::2]
        out.append(mixed(stretch_hashes(part.astype(np.uint64) + np.uint64(1), start, end) + (end - start).astype(np.uint64)))
        spots.append(start + at)
        at = to
    if not out:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate(out), np.concatenate(spots)


def word_hashes(text: str) -> np.ndarray:
    """Hash of every word, line ends aside."""
    return words_and_starts(text.encode("utf-8", "replace"))[0]


def hashed(texts: list[str], n: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Word hashes and hashes of ``n`` words from each word, of every text; all texts side by side."""
    raws = [t.encode("utf-8", "replace") for t in texts]
    words, start = words_and_starts(b"\n".join(raws))
    cut = np.searchsorted(start, np.cumsum([0] + [len(r) + 1 for r in raws])).tolist()
    windows = window_hashes(words, n)
    return [(words[a:b], windows[a : max(a, b - n + 1)]) for a, b in zip(cut, cut[1:])]


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


def window_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of the ``n`` words from each word."""
    start = np.arange(max(0, len(words) - n + 1))
    return stretch_hashes(words, start, start + n).view(np.int64)


def least_of(values: np.ndarray, reach: int) -> np.ndarray:
    """Least of every ``reach`` neighbouring values, by runs of 1, 2, 4, ..."""
    size = 1
    while 2 * size <= reach:
        values = np.minimum(values[:-size], values[size:])
        size *= 2
    rest = reach - size
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


def key_hashes(windows: np.ndarray, reach: int) -> np.ndarray:
    """Distinct least hashes of every ``reach`` neighbouring windows, ascending."""
    if len(windows) < reach:
        return np.zeros(0, np.int64)
    least = least_of(windows, reach)
    return np.unique(least[np.concatenate([[True], least[1:] != least[:-1]])])


class Words:
    """A text's word hashes, and where its keys are."""

    def __init__(self, text: str, n: int, reach: int, known: tuple[np.ndarray, np.ndarray] | None = None):
        self.words, windows = known or hashed([text], n)[0]
        keys = key_hashes(windows, reach)
        at = np.searchsorted(keys, windows)
        self.places = np.flatnonzero(keys[np.minimum(at, len(keys) - 1)] == windows) if len(keys) else np.zeros(0, np.int64)
        self.keys = windows[self.places]


def grown(later: np.ndarray, i: int, earlier: np.ndarray, j: int, n: int) -> tuple[int, int]:
    """The common run around the ``n`` equal words at ``i`` and ``j``, as words of ``later``."""

    def reach(a: np.ndarray, b: np.ndarray) -> int:
        at, step, most = 0, 64, min(len(a), len(b))
        while at < most:
            other = np.flatnonzero(a[at : at + step] != b[at : at + step]) if at + step <= most else np.flatnonzero(a[at:most] != b[at:most])
            if len(other):
                return at + int(other[0])
            at, step = at + step, 4 * step
        return most

    return i - reach(later[:i][::-1], earlier[:j][::-1]), i + n + reach(later[i + n :], earlier[j + n :])


def longest_chain(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """A longest part of ``pairs`` (first places ascending) whose second places ascend too."""
    tails: list[int] = []
    last: list[int] = []
    back = [-1] * len(pairs)
    for p, (_, j) in enumerate(pairs):
        k = bisect_left(tails, j)
        back[p] = last[k - 1] if k else -1
        tails[k : k + 1] = [j]
        last[k : k + 1] = [p]
    chain, p = [], last[-1] if last else -1
    while p >= 0:
        chain.append(pairs[p])
        p = back[p]
    return chain[::-1]


#: Passes of the alignment; what is still out of order then is grown one by one.
PASSES = 8


def aligned_words(later: Words, earlier: Words, n: int, passage: int) -> tuple[np.ndarray, list[int]]:
    """Which words of ``later`` are in a run of ``passage`` words that ``earlier`` has, and the shared
    keys in no such run."""
    covered = np.zeros(len(later.words), bool)
    there, first, times = np.unique(earlier.keys, return_index=True, return_counts=True)
    at = np.searchsorted(there, later.keys)
    at[at == len(there)] = 0
    shared = np.flatnonzero(there[at] == later.keys) if len(there) else np.zeros(0, np.int64)
    mine = later.keys[shared]
    _, kind, own = np.unique(mine, return_inverse=True, return_counts=True) if len(mine) else (None, np.zeros(0, np.int64), np.zeros(0, np.int64))
    unique = (own[kind] == 1) & (times[at[shared]] == 1)
    left = list(zip(later.places[shared[unique]].tolist(), earlier.places[first[at[shared[unique]]]].tolist()))
    done = 0
    while left:
        chain = longest_chain(left) if done < PASSES else left
        done += 1
        until = {}  # end of the block grown last on a diagonal
        for i, j in chain:
            if i + n <= until.get(i - j, 0):
                continue
            start, end = grown(later.words, i, earlier.words, j, n)
            until[i - j] = end
            if end - start >= passage:
                covered[start:end] = True
        used = set(chain)
        left = [p for p in left if p not in used and not covered[p[0] : p[0] + n].all()]
    whole = np.concatenate([[0], np.cumsum(covered)])

    def is_open(spots: np.ndarray) -> np.ndarray:
        return whole[spots + n] - whole[spots] < n

    twice = shared[~unique]
    twice = twice[is_open(later.places[twice])]
    if len(twice):  # windows of a passage around keys that come several times
        ours, theirs = window_hashes(later.words, passage), window_hashes(earlier.words, passage)
        if len(ours) and len(theirs):
            near = np.zeros(len(ours) + 1, np.int64)
            spots = later.places[twice]
            np.add.at(near, np.clip(spots + n - passage, 0, len(ours)), 1)
            np.add.at(near, np.clip(spots + 1, 0, len(ours)), -1)
            starts = np.flatnonzero(np.cumsum(near)[:-1])
            for s in starts[np.isin(ours[starts], theirs)].tolist():
                covered[s : s + passage] = True
        whole = np.concatenate([[0], np.cumsum(covered)])
    spots = later.places[shared]
    return covered, np.unique(later.keys[shared[is_open(spots)]]).tolist() if len(spots) else []


def spans_of(covered: np.ndarray) -> list[int]:
    """Starts and ends of the covered stretches, in turn."""
    return np.flatnonzero(np.diff(np.concatenate([[False], covered, [False]]).astype(np.int8))).tolist()


def cut_text(text: str, lines: list[int], spans: list[int]) -> tuple[str, list[int], int]:
    """``text`` without ``lines`` and without the words of ``spans`` (start, end, start, end, ...); the
    numbers of the lines that went, and how many words went."""
    rows = text.encode("utf-8", "replace").split(b"\n")
    words = [len(r.split()) for r in rows]
    first = np.concatenate([[0], np.cumsum(np.array(words, np.int64))])
    gone = np.zeros(first[-1], bool)
    for i in lines:
        gone[first[i] : first[i + 1]] = True
    for s, e in zip(spans[::2], spans[1::2]):
        gone[s:e] = True
    out: list[bytes | None] = []
    for i, row in enumerate(rows):
        lost = gone[first[i] : first[i + 1]]
        if not lost.any():
            out.append(row)
        elif lost.all():
            out.append(None)
        else:
            spans = [m.span() for m in _WORD.finditer(row)]
            kept = np.flatnonzero(~lost).tolist()
            line = row[: spans[0][0]] if kept[0] == 0 else b""
            for before, k in zip([None, *kept], kept):
                if before is not None:
                    line += row[spans[before][1] : spans[k][0]] if before == k - 1 else b" "
                line += row[spans[k][0] : spans[k][1]]
            out.append(line + (row[spans[-1][1] :] if kept[-1] == len(spans) - 1 else b""))
    whole = [i for i, w in enumerate(words) if w]
    for i, j in zip(whole, whole[1:]):  # blank lines between two deleted ones
        if out[i] is None and out[j] is None:
            out[i + 1 : j] = [None] * (j - i - 1)
    return b"\n".join(r for r in out if r is not None).decode("utf-8", "replace"), [i for i, r in enumerate(out) if r is None], int(gone.sum())


#: Documents that hold a key from which its first holder is broadcast instead of shuffled to.
HOT_KEY = 2000


def first_pairs(keyed: DataFrame, label: str) -> DataFrame:
    """``d, th, f_d, f_th``: each document with the first holders, other than itself, of its keys (``keyed``:
    ``k, d, th``). Rows of a key that many documents hold are not shuffled by it: the first holders
    of those keys (no more than rows / ``HOT_KEY``, counted) are broadcast."""
    me = F.struct("d", "th")
    first = keyed.groupBy("k").agg(F.min(me).alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    first = materialize(first.select(F.col("k").alias("f_k"), F.col("first.d").alias("f_d"), F.col("first.th").alias("f_th"), "n"), f"{label}-first")
    hot = first.filter(F.col("n") >= HOT_KEY).drop("n")
    if (many := hot.count()) > BROADCAST_IDS:
        parts = [first.drop("n")]
    else:
        parts = [first.filter(F.col("n") < HOT_KEY).drop("n")] + ([F.broadcast(hot)] if many else [])
    found = None
    for part in parts:
        later = keyed.join(part, F.col("k") == F.col("f_k")).filter((F.col("f_d") < F.col("d")) | ((F.col("f_d") == F.col("d")) & (F.col("f_th") < F.col("th"))))
        later = later.select("d", "th", "f_d", "f_th")
        found = later if found is None else found.unionByName(later)
    return materialize(found.distinct(), f"{label}-pairs")


def aligned(pairs: DataFrame, texts: DataFrame, n: int, passage: int, label: str, repeated: bool) -> DataFrame:
    """``d, th, spans, open``: what each pair's alignment deletes from the later document, and the
    shared keys it left open. ``repeated`` tells whether rows of ``texts`` share id and text."""
    kind = texts.schema["d"].dataType.simpleString()

    def of(ids: DataFrame) -> DataFrame:
        some = texts.join(small(ids.toDF("u_d").distinct()), F.col("d") == F.col("u_d"), "left_semi")
        return some.dropDuplicates(["d", "th"]) if repeated else some

    earlier = of(pairs.select("f_d")).select(F.col("d").alias("e_d"), F.col("th").alias("e_th"), F.col("text").alias("e_text"))
    later = of(pairs.select("d")).select(F.col("d").alias("l_d"), F.col("th").alias("l_th"), "text")
    both = later.join(small(pairs), (F.col("d") == F.col("l_d")) & (F.col("th") == F.col("l_th"))).join(
        earlier, (F.col("f_d") == F.col("e_d")) & (F.col("f_th") == F.col("e_th"))
    ).select("d", "th", "text", "e_text")
    reach = passage - n + 1

    def run(batches):
        release()
        for batch in batches:
            mine, other = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            texts = list(dict.fromkeys(mine + other))
            held = {t: Words(t, n, reach, known) for t, known in zip(texts, hashed(texts, n))}
            spans, open_ = [], []
            for a, b in zip(mine, other):
                covered, left = aligned_words(held[a], held[b], n, passage)
                spans.append(spans_of(covered))
                open_.append(left)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(spans, pa.list_(pa.int32())), pa.array(open_, pa.list_(pa.int64()))], names=["d", "th", "spans", "open"]
            )

    return materialize(both.transform(small_batches).mapInArrow(run, f"d {kind}, th bigint, spans array<int>, open array<bigint>"), f"{label}-aligned")


def passage_cuts(texts: DataFrame, n: int, passage: int) -> DataFrame:
    """``d, th, spans`` (several rows a document): the words in a run of ``passage`` words that an
    earlier document has."""
    kind, reach = texts.schema["d"].dataType.simpleString(), passage - n + 1

    def keys(batches):
        release()
        for batch in batches:
            found = [key_hashes(windows, reach) for _, windows in hashed(batch.column(2).to_pylist(), n)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.list_(pa.int64()))], names=["d", "th", "keys"]).filter(
                pa.array([len(k) > 0 for k in found], pa.bool_())
            )

    held = materialize(texts.transform(small_batches).mapInArrow(keys, f"d {kind}, th bigint, keys array<bigint>"), "keys")
    keyed = held.select(F.explode("keys").alias("k"), "d", "th")
    pairs = first_pairs(keyed, "line")
    repeated = held.groupBy("d", "th").count().filter("count > 1").limit(1).count() > 0
    found = aligned(pairs, texts, n, passage, "line", repeated)
    cuts = found.filter(F.size("spans") > 0).select("d", "th", "spans")
    left = materialize(found.select(F.explode("open").alias("o_k")).distinct(), "open-keys")
    if not left.limit(1).count():
        return cuts
    holders = keyed.join(small(left), F.col("k") == F.col("o_k"), "left_semi").groupBy("d", "th").agg(F.collect_set("k").alias("ks"))
    holders = materialize(holders.withColumnsRenamed({"d": "h_d", "th": "h_th"}), "holders")
    some = texts.join(small(holders.select(F.col("h_d").alias("u_d")).distinct()), F.col("d") == F.col("u_d"), "left_semi")
    some = some.join(holders, (F.col("d") == F.col("h_d")) & (F.col("th") == F.col("h_th"))).select("d", "th", "text", "ks")

    def around(batches):
        release()
        for batch in batches:
            found = []
            for text, ks in zip(batch.column(2), batch.column(3)):
                words = word_hashes(text.as_py())
                places = np.flatnonzero(np.isin(window_hashes(words, n), ks.values.to_numpy()))
                windows = window_hashes(words, passage)
                near = (places[:, None] + np.arange(n - passage, 1)).ravel()
                found.append(np.unique(windows[np.unique(near[(near >= 0) & (near < len(windows))])]))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.list_(pa.int64()))], names=["d", "th", "keys"])

    wide = materialize(some.transform(small_batches).mapInArrow(around, f"d {kind}, th bigint, keys array<bigint>"), "passage-keys")
    more = first_pairs(wide.select(F.explode("keys").alias("k"), "d", "th"), "passage").join(pairs, ["d", "th", "f_d", "f_th"], "left_anti")
    again = aligned(materialize(more, "more-pairs"), texts, n, passage, "passage", repeated)
    return cuts.unionByName(again.filter(F.size("spans") > 0).select("d", "th", "spans"))


def removals(docs: DataFrame, min_words: int = MIN_WORDS, id_col: str = "doc_id", text_col: str = "text", passage: int | None = None) -> DataFrame:
    """``d, th, lines, spans``: line numbers to delete and words to delete (starts and ends in
    turn; they may overlap), per id and text hash; whole lines only if ``passage`` is None."""
    texts = docs.filter(F.col(id_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(id_col).alias("d"), F.xxhash64(F.col(text_col)).alias("th"), F.col(text_col).alias("text")
    )
    kind = texts.schema["d"].dataType.simpleString()
    if passage:
        cut = passage_cuts(texts, min(min_words, passage), passage)
        return cut.groupBy("d", "th").agg(F.flatten(F.collect_list("spans")).alias("spans")).withColumn("lines", F.array().cast("array<int>"))

    def run(batches):
        release()
        for batch in batches:
            got = [line_hashes(t.as_py()) for t in batch.column(2)]
            keys = [all_keys(h, w, min_words) for h, w in got]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([h for h, _ in got], pa.list_(pa.int64())), pa.array([w for _, w in got], pa.list_(pa.int32())),
                 pa.array(keys, pa.list_(pa.int64()))],
                names=["d", "th", "hashes", "words", "keys"],
            ).filter(pa.array([bool(k) for k in keys], pa.bool_()))

    found = texts.transform(small_batches).mapInArrow(run, f"d {kind}, th bigint, hashes array<bigint>, words array<int>, keys array<bigint>")
    lines = materialize(found, "lines")
    keyed = lines.select(F.explode("keys").alias("k"), F.struct("d", "th").alias("me"))
    first = keyed.groupBy("k").agg(F.min("me").alias("first"), F.max("me").alias("most")).filter("first < most")
    first = first.select(F.col("k").alias("f_k"), "first")
    pairs = materialize(
        keyed.join(first, F.col("k") == F.col("f_k")).filter("first < me").select(
            F.col("me.d").alias("l_d"), F.col("me.th").alias("l_th"), F.col("first.d").alias("e_d"), F.col("first.th").alias("e_th")
        ).distinct(), "line-pairs",
    )
    once = lines.dropDuplicates(["d", "th"])
    later = once.select(F.col("d").alias("a_d"), F.col("th").alias("a_th"), F.col("hashes").alias("a_h"), F.col("words").alias("a_w"))
    earlier = once.select(F.col("d").alias("b_d"), F.col("th").alias("b_th"), F.col("hashes").alias("b_h"))
    both = (
        pairs.join(later, (F.col("l_d") == F.col("a_d")) & (F.col("l_th") == F.col("a_th")))
        .join(earlier, (F.col("e_d") == F.col("b_d")) & (F.col("e_th") == F.col("b_th")))
        .select(F.col("l_d").alias("d"), F.col("l_th").alias("th"), "a_h", "a_w", "b_h")
    )

    def align(batches):
        release()
        for batch in batches:
            cut = [common_blocks(*args, min_words) for args in zip(*(batch.column(i).to_pylist() for i in (2, 3, 4)))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(cut, pa.list_(pa.int32()))], names=["d", "th", "lines"])

    cut = both.transform(small_batches).mapInArrow(align, f"d {kind}, th bigint, lines array<int>").filter(F.size("lines") > 0)
    cut = cut.groupBy("d", "th").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("lines")))).alias("lines"))
    return cut.withColumn("spans", F.array().cast("array<int>"))


def marked(docs: DataFrame, min_words: int, id_col: str, text_col: str, passage: int | None) -> tuple[DataFrame, str]:
    """``docs`` with what a cut leaves (null without one): ``text``, ``lines`` (numbers of
    the deleted lines) and ``words`` (how many were deleted), under a fresh name."""

    @F.pandas_udf("text string, lines array<int>, words int")
    def left(parts: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        release()
        for texts, lines, spans in parts:
            rows = [("", [], 0) if l is None else cut_text(t, l, s) for t, l, s in zip(texts, lines, spans)]
            yield pd.DataFrame(rows, columns=["text", "lines", "words"])

    cut = materialize(removals(docs, min_words, id_col, text_col, passage), "removals")
    hit, th, d, c_th, lines, spans, out = fresh(docs, "hit_id", "text_hash", "cut_id", "cut_hash", "cut_lines", "cut_spans", "cut")
    ids = small(cut.select(F.col("d").alias(hit)).distinct())
    touched = docs.join(ids, docs[id_col] == F.col(hit), "left_semi").withColumn(th, F.xxhash64(F.col(text_col)))
    plan = cut.select(F.col("d").alias(d), F.col("th").alias(c_th), F.col("lines").alias(lines), F.col("spans").alias(spans))
    joined = touched.join(plan, (F.col(id_col) == F.col(d)) & (F.col(th) == F.col(c_th)), "left").transform(small_batches)
    made = left.asNondeterministic()(F.col(text_col), F.col(lines), F.col(spans))
    cleaned = joined.withColumn(out, made).withColumn(out, F.when(F.col(lines).isNotNull(), F.col(out))).drop(th, d, c_th, lines, spans)
    same = docs.join(ids, docs[id_col] == F.col(hit), "left_anti")
    return cleaned.unionByName(same.withColumn(out, F.lit(None).cast(cleaned.schema[out].dataType))), out


def dedup_lines(docs: DataFrame, min_words: int = MIN_WORDS, id_col: str = "doc_id", text_col: str = "text", passage: int | None = None) -> DataFrame:
    """``doc_id, text`` (without what is deleted), ``n_lines`` (before), ``removed_lines``
    (numbers from 0 of the lines of which nothing is left) and ``removed_words`` of every row.
    Without ``passage`` whole lines only; with it also runs of words within lines."""
    out, cut = marked(docs.select(id_col, text_col), min_words, id_col, text_col, passage)
    return out.select(
        F.col(id_col).alias("doc_id"), F.when(F.col(cut).isNotNull(), F.col(cut)["text"]).otherwise(F.col(text_col)).alias("text"),
        F.coalesce(F.size(F.split(F.col(text_col), "\n", -1)), F.lit(0)).alias("n_lines"),
        F.coalesce(F.col(cut)["lines"], F.array().cast("array<int>")).alias("removed_lines"),
        F.coalesce(F.col(cut)["words"], F.lit(0)).alias("removed_words"),
    )


def clean_documents(docs: DataFrame, min_words: int = MIN_WORDS, id_col: str = "doc_id", text_col: str = "text", chars_col: str = "n_chars", passage: int | None = None) -> DataFrame:
    """``docs`` (all their columns) without what is deleted (``passage`` as for
    :func:`dedup_lines`); a document of which nothing is left goes. ``chars_col``, if there, follows a changed text."""
    out, cut = marked(docs, min_words, id_col, text_col, passage)
    clean, changed = F.col(cut)["text"], F.col(cut).isNotNull()
    out = out.filter(~changed | (F.regexp_replace(clean, r"[\x20\x09-\x0D]+", "") != ""))
    cols = []
    for c in docs.columns:
        if c == text_col:
            cols.append(F.when(changed, clean).otherwise(F.col(c)).alias(c))
        elif c == chars_col:
            kind = docs.schema[c].dataType
            cols.append(F.when(changed, F.char_length(clean).cast(kind)).otherwise(F.col(c)).alias(c))
        else:
            cols.append(F.col(c))
    return out.select(*cols)
