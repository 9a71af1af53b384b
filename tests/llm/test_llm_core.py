"""Spark-free parts of the training-data operators against brute force."""

import random
import time
from array import array

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tessera.llm import bpe, html_extract, lang_id, line_dedup, ngram_join, packing, quality, sharding, topk

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(PATH)
    t.no_truncation()
    t.no_padding()
    return t


TEXTS = [
    "", "Hello, World! don't", "ΣΑΣ Σ", " <|endoftext|>a<|startoftext|>B's'RE", "éa ́x", "İstanbul ǅ ß", "a\x1cb c\x85d​e",
    "1234 ½ ²", "th" * 1500, "aab" * 1200, "!" * 2500, "日本語テキスト" * 100, "👍🏽x" * 60, "\x00a\x00", "ﬁ ﷺ Å",
]


def test_encoder_equals_library(library):
    _, enc = bpe.loaded(bpe.read_spec(PATH))
    rng = random.Random(1)
    odd = ["".join(rng.choice("theaing") for _ in range(4000)) for _ in range(2)]
    odd += ["".join(chr(rng.choice([rng.randrange(32, 0x2FFF), rng.randrange(0xE000, 0x1FFFF), rng.randrange(9, 127)])) for _ in range(200)) for _ in range(40)]
    for text in TEXTS + odd:
        assert array("I", b"".join(enc.encode(text))).tolist() == library.encode(text, add_special_tokens=False).ids


def test_transducer_holds_two_windows_and_equals_whole_merge():
    spec, enc = bpe.loaded(bpe.read_spec(PATH))
    assert enc.lookahead == bpe.sufficient_lookahead([tuple(m) for m in spec["model"]["merges"]])
    rng = random.Random(2)
    for letters in ("th", "thea", "aeiourst", "nnm"):
        word = "".join(rng.choice(letters) for _ in range(6000)).encode()
        whole = enc.merge([*(enc.first[b] for b in word[:-1]), enc.last[word[-1]]])
        seen = []
        merge = enc.merge
        enc.merge = lambda s: seen.append(len(s)) or merge(s)
        try:
            assert list(enc.transduce(word)) == whole
        finally:
            enc.merge = merge
        assert max(seen) <= 2 * enc.lookahead


def test_decoder_equals_library_and_plain_text(library):
    spec, enc = bpe.loaded(bpe.read_spec(PATH))
    for text in TEXTS:
        dec = bpe.Decoder(spec)
        parts = [dec.feed(ids) for ids in enc.encode(text)]
        assert "".join(parts) + dec.finish() == library.decode(library.encode(text, add_special_tokens=False).ids, skip_special_tokens=False)
    plain = bpe.Decoder(spec, plain=True)
    ids = array("I", b"".join(enc.encode("naïve 日本 ok")))
    assert "".join(plain.feed(array("I", [i]).tobytes()) for i in ids) + plain.finish() == "naïve 日本 ok "


def test_best_fit_equals_piecewise_best_fit():
    rng = random.Random(3)
    for capacity in (10, 64, 2048):
        counts = {rng.randint(1, capacity): rng.randint(1, 40) for _ in range(min(capacity, 60))}
        runs = packing.plan_best_fit(counts, capacity)
        free = []  # brute force: one piece at a time, tightest open sequence
        for length in sorted(counts, reverse=True):
            for _ in range(counts[length]):
                fit = [f for f in free if f >= length]
                if fit:
                    free.remove(min(fit))
                    free.append(min(fit) - length)
                else:
                    free.append(capacity - length)
        used = {}
        for length, lo, hi, first, per, at in runs:
            for r in range(lo, hi):
                used.setdefault(first + (r - lo) // per, []).append((at + (r - lo) % per * length, length))
        for spots in used.values():
            end = 0
            for at, length in sorted(spots):
                assert at == end
                end += length
            assert end <= capacity
        assert len(used) == len(free)
        assert {n: sum(hi - lo for m, lo, hi, *_ in runs if m == n) for n in counts} == counts


def test_language_model_learns_and_rejects():
    rng = random.Random(4)
    vocabulary = {"xx": ["zorp", "blik", "tarn"], "yy": ["éclo", "prêt", "fûm"]}
    rows = [(" ".join(rng.choices(words, k=12)), lang) for lang, words in vocabulary.items() for _ in range(60)]
    scorer = lang_id.Scorer(lang_id.fit(rows))
    assert scorer.predict("blik tarn zorp tarn")[0] == "xx" and scorer.predict("fûm prêt")[0] == "yy"
    assert scorer.predict(None) == scorer.predict("") == scorer.predict("12 34 !") == ("und", 0.0, True)
    assert lang_id.Scorer(lang_id.fit([])).predict("abc") == ("und", 0.0, True)
    long = "blik tarn " * 60_000
    assert np.isclose(scorer.sums(long)[1], scorer.sums("blik tarn ")[1] * 60_000)


def brute_statistics(text):
    import re

    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    hit = {j for i, w in enumerate(windows) if windows.count(w) > 1 for j in range(i, i + 8)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return [len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(hit)]


def test_quality_statistics_equal_brute_force():
    rng = random.Random(5)
    texts = [None, "", " ", "a", "a b\n\na b\n a b", "é\x85x\xa0y # z", "a a a a a a a a a", "\n".join(["x y z"] * 9)]
    texts += [" ".join(rng.choices(["a", "b", "c\n", "#d", "é&"], k=rng.randint(5, 60))) for _ in range(60)]
    for text in texts:
        assert quality.statistics(text)[0] == brute_statistics(text)


def test_boosted_trees_learn_and_are_monotone():
    rng = np.random.default_rng(6)
    x = rng.normal(size=(600, 12))
    y = ((x[:, 2] < 0.3) & (x[:, 0] > -0.5)).astype(int)
    model = quality.boost(x, y, quality.MONOTONE, trees=30)
    assert ((model.probability(x) > 0.5) == y).mean() > 0.95
    for f, sign in enumerate(quality.MONOTONE):
        if sign:
            grid = np.repeat(x[:40], 20, axis=0)
            grid[:, f] = np.tile(np.linspace(-3, 3, 20), 40)
            steps = np.diff(model.probability(grid).reshape(40, 20), axis=1)
            assert (sign * steps >= -1e-12).all()
    assert quality.fit(np.zeros((0, 12)), np.zeros(0)) is None


def test_smallest_capacity_equals_brute_force():
    rng = random.Random(7)
    for _ in range(60):
        sizes = np.array([rng.randint(1, 30) for _ in range(rng.randint(1, 9))], np.int64)
        shards = rng.randint(1, 4)
        capacity, ends = sharding.smallest_capacity(sizes, shards)
        prefix = np.concatenate([[0], np.cumsum(sizes)])
        smaller = [c for c in range(capacity) if sharding.greedy(prefix, c, shards) is not None]
        assert not smaller and ends[-1] == len(sizes) and len(ends) <= shards
        cuts = sharding.level(sizes, shards)
        assert cuts[-1] == len(sizes) and len(cuts) <= shards
        for a, b in zip([0, *cuts], cuts):
            assert b - a == 1 or sizes[a:b].sum() <= capacity
    hot = np.array([5] * 50 + [1000] + [5] * 50, np.int64)
    assert max(np.diff([0, *sharding.level(hot, 11)])) <= 11


def test_search_block_equals_brute_force():
    rng = np.random.default_rng(8)
    x = np.floor(rng.normal(size=(300, 64)) * 60)
    x[40:60] = x[40]
    ids = rng.permutation(300).astype(np.int64)
    got = list(zip(*(c.tolist() for c in topk.search_block(ids[:30], x[:30], ids, x, 5))))
    want = []
    for i in range(30):
        s = (x[i] @ x.T).astype(np.int64)
        order = [j for j in np.lexsort((ids, -s)) if ids[j] != ids[i]][:5]
        want += [(ids[i], ids[j], s[j]) for j in order]
    assert got == want
    for n in topk.levels(64):
        f = topk.segment_features(x, n)
        assert (f @ f.T >= x @ x.T - 1e-6).all()
    big = np.full((2, 3), 2.0**30)
    assert topk.exact_scores(big, big).tolist() == [3 * 2**60] * 2


def brute_marginals(parents, unary, pair):
    from itertools import product

    n = len(parents)
    total, full = 0.0, np.zeros(n)
    for state in product((0, 1), repeat=n):
        w = np.exp(sum(u * s for u, s in zip(unary, state)) + sum(pair[state[p]][s] for p, s in zip(parents, state) if p >= 0))
        total += w
        full += w * np.array(state)
    return full / total


def test_message_passing_equals_enumeration():
    rng = random.Random(9)
    for _ in range(20):
        parents = [-1] + [rng.randrange(-1, i) for i in range(1, 9)]
        unary = [rng.uniform(-3, 3) for _ in parents]
        pair = [[rng.uniform(-2, 2) for _ in range(2)] for _ in range(2)]
        assert np.allclose(html_extract.marginals(parents, unary, pair)[0], brute_marginals(parents, unary, pair))


@pytest.fixture(scope="module")
def pages_model():
    return html_extract.train()


def test_extraction_on_held_out_layouts(pages_model):
    right = wrong = 0
    for html, article in html_extract.labelled_pages(80, seed=123):
        text = f" {pages_model.text(html)} "
        for run in html_extract.Page(html).runs.values():
            ok = (f" {run} " in text) == (run in article)
            right, wrong = right + ok, wrong + (not ok)
    assert right / (right + wrong) > 0.97


def test_extraction_details(pages_model):
    page = (
        '<html><head><title>no</title></head><body><nav><ul><li><a href="/">Home</a></li></ul></nav><div class="cookie-notice"><p>We use cookies on this page.</p></div>'
        "<article><h1>A  title</h1><p>One w<b>or</b>d &amp; two&#33;<br>next\n line<p>Second.</article>"
        '<section id="comments"><h3>Comments</h3><div class="comment"><p>First reader says a lot of things here.</p></div></section><footer>&copy; 2024</footer>'
    )
    assert pages_model.text(page) == "A title One word & two! next line Second."
    assert pages_model.text(None) == pages_model.text("") == pages_model.text("<nav>x</nav>") == ""


def test_extraction_drops_only_script_style_template_and_title(pages_model):
    first = "The first sentence of the article, with enough words to be one."
    page = f"<html><head><meta charset=utf-8><title>t</title><article><h1>A title</h1><p>{first}<p>Second one.</article>"
    assert pages_model.text(page) == f"A title {first} Second one."  # neither </head> nor body
    assert html_extract.Page("<head><title>t</title><template><p>no</p></template>Text of the page").runs == {0: "Text of the page"}
    for inner, text in [
        ("<math><mi>x</mi><mo>=</mo><mn>2</mn></math>", "x=2"),
        ("<svg><title>a chart</title><path d='M0'/><text>of <tspan>sales</tspan></text><style>no</style></svg>", "a chart of sales"),
        ("<svg><script>no</script></svg>", ""),
        *((f"<{t}>plain words</{t}>", "plain words") for t in ("noscript", "object", "canvas", "audio", "video")),
    ]:
        page = f"<html><head><title>t</title></head><body><article><h1>A title</h1><p>{first} Let {inner} hold.</p></article></body>"
        assert pages_model.text(page) == " ".join(f"A title {first} Let {text} hold.".split())
    assert pages_model.text(f"<body><article><p>{first}</p><noscript><p>Second one.</p></noscript></article>") == f"{first} Second one."


SENTENCES = (
    "The council met on Tuesday to discuss the new bridge, and agreed on a plan after three hours.",
    "Work starts in spring, the mayor said, if the river stays low; otherwise it waits until autumn.",
)
BY_HAND = [
    ("<body><div>Plain text page without any class names. It has two sentences.</div></body>", "Plain text page without any class names. It has two sentences."),
    (f"<body><div class='x1'><p>{SENTENCES[0]}</p><p>{SENTENCES[1]}</p></div><div class='cmt-wrap'><p>Great news!</p></div></body>", " ".join(SENTENCES)),
    (f"<div class='content'><div class='reader-opinions'><p>I like it.</p></div><p>{SENTENCES[0]}</p></div>", SENTENCES[0]),
    (
        "<table><tr><td><a href=/a>Home</a><br><a href=/b>News</a><br><a href=/c>Sport</a></td>"
        f"<td><h1>New bridge</h1><p>{SENTENCES[0]}<p>{SENTENCES[1]}</td></tr></table>",
        f"New bridge {SENTENCES[0]} {SENTENCES[1]}",
    ),
    (
        f"<div class=kopfzeile><ul><li><a href=/>Start</a><li><a href=/n>Nachrichten</a></ul></div><div class=hauptteil><h2>Die neue Br\u00fccke</h2><p>{SENTENCES[0]}</p>"
        f"<p>{SENTENCES[1]}</p></div><div class=fusszeile><a href=/i>Impressum</a> <a href=/d>Datenschutz</a></div>",
        f"Die neue Br\u00fccke {SENTENCES[0]} {SENTENCES[1]}",
    ),
    ("<ul><li><a href=/a>One</a><li><a href=/b>Two</a><li><a href=/c>Three</a></ul><form><label>Name</label><input><button>Send</button></form>", ""),
]


@pytest.mark.parametrize("html, text", BY_HAND)
def test_extraction_without_known_names(pages_model, html, text):
    assert pages_model.text(html) == text


def test_extraction_on_held_out_unmarked_layouts(pages_model):
    right = total = 0
    for html, article in html_extract.unmarked_pages(100, seed=321):
        text = f" {pages_model.text(html)} "
        for run in html_extract.Page(html).runs.values():
            right, total = right + ((f" {run} " in text) == (run in article)), total + 1
    assert right / total > 0.97


def test_deep_and_broken_pages_parse_in_linear_time(pages_model):
    start = time.monotonic()
    for unit in ("<div>x", "<b>x", "<td></div>", "<div></p>", "<svg><g>x", "<li><div>x"):
        pages_model.text(unit * 50_000)
    assert time.monotonic() - start < 60
    assert html_extract.Page("<div>" * 100_000 + "deep").runs == {100_000: "deep"}
    assert list(html_extract.Page("<p>one <script>x</script>line</p><a href=/>link</a><p>two").runs.values()) == ["one line", "link", "two"]
    assert list(html_extract.Page("<div><table><tr><td>a</div>b</td></tr></table>c</div>d").runs.values()) == ["ab", "c", "d"]


def test_shingles_and_prefixes():
    assert len(ngram_join.shingles("", 3)) == len(ngram_join.shingles(None, 3)) == 0
    assert (ngram_join.shingles("A b", 3) == ngram_join.shingles("a\tB", 3)).all()
    assert len(ngram_join.shingles("a b c d a b c", 3)) == 4
    assert len(ngram_join.shingles("É b", 3)) == 1 and ngram_join.shingles("É b", 3)[0] != ngram_join.shingles("é b", 3)[0]
    rng = np.random.default_rng(10)
    for percent in (60, 80, 90):
        for n in (1, 2, 5, 40):
            assert ngram_join.prefix_length(n, percent) <= n
    a = np.sort(rng.integers(0, 2**63, 40).astype(np.uint64))
    b = np.sort(np.concatenate([a[2:], rng.integers(0, 2**63, 1).astype(np.uint64)]))
    sets = [a, b, np.sort(rng.integers(0, 2**63, 40).astype(np.uint64))]
    assert ngram_join.linked_across([1, 2, 3], [1, 2, 3], sets, 0, 90) == [(1, 2)]
    assert ngram_join.linked_across([1, 2, 3], [1, 2, 3], sets, 1, 90) == [(1, 2)]
    assert ngram_join.linked_across([1, 2, 3], [7, 7, 3], sets, 0, 90) == []


def test_common_blocks():
    def cut(later, earlier, words=None, least=3):
        return line_dedup.common_blocks(later, words or [int(h > 0) for h in later], earlier, least)

    assert cut([1, 2, 3, 9], [5, 1, 2, 3]) == [0, 1, 2]
    assert cut([1, 2, 9, 3], [1, 2, 3]) == []
    assert cut([4, 5, 6, 1, 2, 3], [1, 2, 3, 4, 5, 6]) == [0, 1, 2, 3, 4, 5]  # moved blocks
    assert cut([1, 0, 2, 0, 3, 0, 8], [7, 1, 0, 2, 0, 3, 0, 9]) == [0, 1, 2, 3, 4]  # blank lines inside only
    assert cut([1, 1, 1, 2], [1, 1, 1, 3]) == [0, 1, 2]  # only repeated lines in common
    assert cut([], [1]) == [] and cut([1, 2, 3], []) == []
    words = [2, 2, 2, 2, 1]
    hashes = [11, 12, 13, 14, 15]
    assert len(line_dedup.passage_keys(hashes, words, 4)) == 3
    assert line_dedup.passage_keys(hashes, words, 100) == []


def test_common_blocks_of_moved_and_repeated_lines():
    count = {1: 60, 2: 5, 3: 5, 4: 20, 5: 20, 6: 20, 7: 3, 8: 3}

    def cut(later, earlier):
        return line_dedup.common_blocks(later, [count.get(h, 0) for h in later], earlier, 30)

    assert cut([1, 2, 3], [2, 3, 1]) == [0]  # the chain of two short lines is longer
    assert cut([2, 7, 1, 8, 1], [2, 1]) == [2, 4]
    assert cut([2, 7, 1, 8], [2, 1, 3, 1]) == [2]
    assert cut([4, 5, 6], [4, 0, 5, 0, 6]) == [0, 1, 2]  # blank lines of one side
    assert cut([4, 0, 5, 0, 0, 6, 0], [7, 4, 5, 6]) == [0, 1, 2, 3, 4, 5]
    rng = random.Random(12)
    for _ in range(300):
        later, earlier = ([rng.randint(0, 8) for _ in range(rng.randint(0, 14))] for _ in range(2))
        at = [i for i, h in enumerate(later) if h]
        lines, there = [later[i] for i in at], [h for h in earlier if h]
        runs = {tuple(there[i:j]) for i in range(len(there)) for j in range(i + 1, len(there) + 1)}
        spans = [(i, j) for i in range(len(at)) for j in range(i + 1, len(at) + 1) if tuple(lines[i:j]) in runs and sum(count[h] for h in lines[i:j]) >= 30]
        gone = {x for i, j in spans for x in range(i, j)}
        assert cut(later, earlier) == sorted(x for i in gone for x in (range(at[i], at[i + 1]) if i + 1 in gone else [at[i]]))
