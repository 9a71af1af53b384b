"""The operators on Spark: odd rows, brute force on small tables, pipeline."""

import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from tessera.llm import bpe, catalog, html_extract, lang_id, line_dedup, ngram_join, packing, quality, sharding, token_counts, topk

SMALL = "/root/testdata/sf0.001"
DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()), T.StructField("lines", T.StringType()),
    T.StructField("node", T.StringType()), T.StructField("length", T.StringType()), T.StructField("hit_id", T.StringType()),
])
LONG = " ".join(f"w{i}" for i in range(40_000))
PASSAGE = " ".join(f"p{i}" for i in range(60))


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and very long texts, ties, repeated rows and clashing names."""
    body = " ".join(f"q{i}" for i in range(90))
    rows = [
        (1, body), (2, body), (3, body + " end"), (4, None), (5, ""), (6, " \n\t "), (7, LONG), (7, LONG), (8, LONG + " x"), (None, "no id here"),
        (9, "two words"), (10, "Two Words"), (11, f"intro a\n{PASSAGE}\nown a"), (12, f"other b\nthing\n{PASSAGE}\n\nown b"), (12, "other text of the same id"),
    ]
    return spark.createDataFrame([(i, t, "en" if t else None, "s", len(t) if t else None, "l", "n", "x", None) for i, t in rows], DOCS)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], DOCS)


def brute_components(rows, k, percent):
    sets = []
    for _, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets.append({tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1))} if words else set())
    top = list(range(len(rows)))

    def find(v):
        while top[v] != v:
            v = top[v]
        return v

    spots = defaultdict(list)
    for i, s in enumerate(sets):
        for g in s:
            spots[g].append(i)
    common = Counter((a, b) for at in spots.values() for a in at for b in at if a < b)
    for (a, b), n in common.items():
        if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
            top[find(b)] = find(a)
    least = {}
    for i, (d, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), d), d)
    return sorted((d, len(sets[i]), least[find(i)]) for i, (d, _) in enumerate(rows))


@pytest.mark.parametrize("k,percent,tight", [(3, 90, False), (5, 80, False), (3, 60, True)])
def test_join_equals_brute_force(spark, monkeypatch, k, percent, tight):
    if tight:  # every unsettled bucket takes the block-by-block way, over several blocks
        monkeypatch.setattr(ngram_join, "PAIRED_IN_FULL", 1)
        monkeypatch.setattr(ngram_join, "EXPANDED_IN_FULL", 0)
        monkeypatch.setattr(ngram_join, "BLOCK_BYTES", 20_000)
        monkeypatch.setattr(ngram_join, "FREQUENT", 2)
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    got = sorted(tuple(r) for r in ngram_join.components(docs, k, percent).collect())
    assert got == brute_components(rows, k, percent)


def test_join_odd_rows(odd, nothing):
    got = Counter(tuple(r) for r in ngram_join.components(odd, 3, 90).collect())
    assert got[(1, 88, 1)] == got[(2, 88, 1)] == got[(3, 89, 1)] == 1
    assert got[(7, 39_998, 7)] == 2 and got[(8, 39_999, 7)] == 1
    assert got[(4, 0, 4)] == got[(5, 0, 5)] == got[(6, 0, 6)] == 1
    assert got[(9, 1, 9)] == got[(10, 1, 9)] == 1 and got[(None, 1, None)] == 1
    assert ngram_join.components(nothing, 3, 90).count() == 0
    kept = ngram_join.keep_one(odd, 3, 90)
    assert kept.columns == odd.columns
    assert sorted((r["doc_id"] or 0) for r in kept.collect()) == [0, 1, 4, 5, 6, 7, 9, 11, 12, 12]  # of 7, given twice, one stays
    assert ngram_join.keep_one(nothing).count() == 0


def test_line_dedup(spark, odd, nothing):
    got = {(r["doc_id"], r["n_lines"]): r for r in line_dedup.dedup_lines(odd).collect()}
    assert got[(12, 5)]["removed_lines"] == [2] and got[(12, 5)]["text"] == "other b\nthing\n\nown b"
    assert got[(11, 3)]["removed_lines"] == [] and got[(2, 1)]["removed_lines"] == [0] and got[(1, 1)]["removed_lines"] == []
    assert got[(4, 0)]["text"] is None
    clean = line_dedup.clean_documents(odd)
    assert clean.columns == odd.columns and clean.schema == odd.schema
    rows = [(r["doc_id"], r["text"], r["n_chars"]) for r in clean.collect()]
    assert sorted((r[0] or 0) for r in rows) == [0, 1, 3, 4, 5, 6, 7, 7, 8, 9, 10, 11, 12, 12]
    assert all(n == len(t) for _, t, n in rows if t)
    assert line_dedup.dedup_lines(nothing).count() == line_dedup.clean_documents(nothing).count() == 0


def test_line_dedup_keeps_every_line_once(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    before = {l.strip() for r in docs.collect() for l in r["text"].split("\n")}
    out = line_dedup.dedup_lines(docs).collect()
    assert {l.strip() for r in out for l in r["text"].split("\n")} | {""} >= before
    lines = Counter(l.strip() for r in out for l in {x.strip() for x in r["text"].split("\n")} if len(l.split()) >= line_dedup.MIN_WORDS)
    assert max(lines.values(), default=0) <= 1  # a long line survives in one document only


def test_line_dedup_finds_passages_within_lines(spark):
    def words(name, n):
        return " ".join(f"{name}{i}" for i in range(n))

    shared, split = words("s", 51), words("t", 60).split()
    rows = [
        (1, f"{words('a', 9)} {shared} {words('b', 7)}\n{words('c', 5)} {' '.join(split)}"),
        (2, f"{words('d', 40)} {shared} {words('e', 3)}"),  # in mid-line
        (3, f"x {' '.join(split[:25])}\n\n{' '.join(split[25:])} y\nz"),  # over line ends
        (4, f"{words('s', 20)} own words {words('t', 25)}"),  # short pieces stay
        (5, f"{words('f', 33)} {shared} {shared} g"),  # repeated
    ]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r["doc_id"]: r for r in line_dedup.dedup_lines(docs, passage=line_dedup.PASSAGE).collect()}
    assert [got[i]["text"] for i in (1, 4)] == [rows[0][1], rows[3][1]] and got[1]["removed_words"] == 0
    assert got[2]["text"] == f"{words('d', 40)} {words('e', 3)}" and got[2]["removed_words"] == 51 and got[2]["removed_lines"] == []
    cleaned = line_dedup.clean_documents(docs, passage=line_dedup.PASSAGE)
    assert {r["doc_id"]: r["text"] for r in cleaned.collect()} == {d: r["text"] for d, r in got.items()}
    assert got[3]["text"] == "x\n\ny\nz" and got[5]["text"] == f"{words('f', 33)} g"


def test_no_passage_of_over_50_words_is_left(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    before = {r["doc_id"]: r["text"].split() for r in docs.collect()}
    after = {r["doc_id"]: r["text"].split() for r in line_dedup.dedup_lines(docs, passage=line_dedup.PASSAGE).collect()}

    def without_copies(n):
        """Words of every document that are in no run of n words of an earlier one."""
        first, out = {}, {}
        for d in sorted(before):
            text = before[d]
            copied = [False] * len(text)
            for i in range(len(text) - n + 1):
                if first.setdefault(hash(tuple(text[i : i + n])), d) != d:
                    copied[i : i + n] = [True] * n
            out[d] = [w for w, c in zip(text, copied) if not c]
        return out

    def within(part, whole):
        rest = iter(whole)
        return all(w in rest for w in part)

    least, most = without_copies(line_dedup.MIN_WORDS), without_copies(line_dedup.PASSAGE)
    assert sum(map(len, most.values())) < sum(map(len, before.values()))
    assert all(within(least[d], after[d]) and within(after[d], most[d]) for d in before)


def check_packing(rows, capacity):
    by = defaultdict(list)
    for r in rows:
        by[r["sequence_id"]].append((r["offset"], r["length"]))
    for spots in by.values():
        end = 0
        for at, n in sorted(spots):
            assert at == end
            end += n
        assert end <= capacity
    return len(by)


def test_packing(spark, odd, nothing, monkeypatch):
    monkeypatch.setattr(packing, "RANKED_TOGETHER", 3)
    rows = packing.pack(odd, catalog.TOKENIZER, 64).collect()
    total = sum(r["length"] for r in rows)
    assert check_packing(rows, 64) <= -(-total // 64) + 1
    assert sorted((r["doc_id"], r["length"]) for r in rows if r["doc_id"] in (4, 5, 6)) == [(4, 1), (5, 1), (6, 1)]
    assert packing.pack(nothing, catalog.TOKENIZER).count() == 0
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    got = packing.pack(docs, catalog.TOKENIZER, 100).collect()
    _, enc = bpe.loaded(bpe.read_spec(catalog.TOKENIZER))
    want = set()
    for r in docs.collect():
        ids = b"".join(enc.encode(r["text"])) + bytes(4)
        want |= {(r["doc_id"], i // 400, i // 4, len(ids[i : i + 400]) // 4, zlib.crc32(ids[i : i + 400])) for i in range(0, len(ids), 400)}
    assert {(r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got} == want


def test_bpe_on_spark(odd, nothing):
    rows = {r["doc_id"]: r for r in bpe.round_trip(odd, catalog.TOKENIZER).collect()}
    assert rows[4]["n_tokens"] == rows[5]["n_tokens"] == 0 and rows[7]["n_tokens"] > 40_000
    assert bpe.round_trip(nothing, catalog.TOKENIZER).count() == 0
    ids = {r["doc_id"]: r["ids"] for r in bpe.encode_documents(odd, catalog.TOKENIZER).collect()}
    assert ids[9] == ids[10] and ids[4] == []


def test_token_counts(spark, odd, nothing):
    written = token_counts.write_token_files(odd, catalog.TOKENIZER, catalog.SEPARATOR)
    want = sorted(r["n_tokens"] for r in bpe.round_trip(odd, catalog.TOKENIZER).collect())
    for block in (6, 1000, 1 << 20):
        rows = token_counts.count_tokens(written, catalog.SEPARATOR, block_bytes=block if block > 6 else 20_000).collect()
        assert sorted(r["n_tokens"] for r in rows) == want and all(r["closed"] for r in rows)
    assert token_counts.corpus_token_counts(nothing, catalog.TOKENIZER, catalog.SEPARATOR).count() == 0
    assert written.columns == ["path", "bytes"]


@pytest.mark.parametrize("parts", [1, 7])
def test_token_counts_carry_the_document(odd, parts):
    library = Tokenizer.from_file(catalog.TOKENIZER)
    want = Counter((r["doc_id"], len(library.encode(r["text"] or "", add_special_tokens=False).ids)) for r in odd.collect())
    rows = token_counts.corpus_token_counts(odd.repartition(parts), catalog.TOKENIZER, catalog.SEPARATOR).collect()
    assert Counter((r["doc_id"], r["n_tokens"]) for r in rows) == want and all(r["closed"] for r in rows)
    named = odd.select(F.col("doc_id").cast("string").alias("path"), F.col("text").alias("doc"), F.lit(1).alias("bytes"))
    rows = token_counts.corpus_token_counts(named, catalog.TOKENIZER, catalog.SEPARATOR, id_col="path", text_col="doc").collect()
    assert Counter((r["doc_id"] and int(r["doc_id"]), r["n_tokens"]) for r in rows) == want


def test_token_counts_of_hand_made_files(spark, tmp_path):
    import numpy as np

    cases = {"a": [1, 2, 9, 9, 3], "b": [9], "c": [], "d": [4, 4, 4, 4, 4, 4, 9, 5]}
    for name, ids in cases.items():
        np.array(ids, "<u2").tofile(tmp_path / name)
    files = spark.createDataFrame([(f"{tmp_path}/{n}", 2 * len(i)) for n, i in cases.items()], "path string, bytes bigint")
    for block in (2, 4, 6, 100):
        rows = token_counts.count_tokens(files, 9, 2, block).collect()
        got = sorted((r["path"][-1], r["doc"], r["start"], r["n_tokens"], r["closed"]) for r in rows)
        assert got == [("a", 0, 0, 2, True), ("a", 1, 3, 0, True), ("a", 2, 4, 1, False), ("b", 0, 0, 0, True), ("d", 0, 0, 6, True), ("d", 1, 7, 1, False)]


def test_sharding(odd, nothing, monkeypatch):
    monkeypatch.setattr(sharding, "NUMBERED_TOGETHER", 1)
    rows = sharding.assign(odd, 4).collect()
    assert len(rows) == odd.count()
    slots = defaultdict(list)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    shard = {r["doc_id"]: r["shard"] for r in rows}
    assert shard[1] == shard[2] and shard[4] == shard[5]
    assert {r["doc_id"]: (r["size"], r["text_crc32"]) for r in rows}[4] == (16, 0)
    assert sharding.assign(nothing, 4).count() == 0


def test_topk(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (50, [0.5, -1.0]), (3, [1.0, 2.0]), (2, [1.0, 2.0]), (4, None), (5, [nan, 1.0]), (6, [inf, 0.0]), (7, [None, 1.0]), (8, [1.0]), (None, [1.0, 1.0]), (9, [-1.0, -1.0])]
    v = topk.quantise(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").withColumns({"id": F.lit("x"), "v": F.lit("y")}))
    got = sorted(tuple(r) for r in topk.top_k(v, v.filter(F.col("id") % 50 == 0), 3).collect())
    assert got == [(0, 1, 2, 327680), (0, 2, 3, 327680), (0, 3, 50, -98304), (50, 1, 9, 32768), (50, 2, 0, -98304), (50, 3, 2, -98304)]
    none = v.filter("id < 0")
    assert topk.top_k(none, none).count() == 0


def test_language_id(spark, odd, nothing):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = lang_id.train(docs)
    got = lang_id.predict(docs, model).join(docs.select("doc_id", "lang"), "doc_id").filter(lang_id.held_out("doc_id")).collect()
    assert sum(r["lang"] == r["lang_pred"] for r in got) / len(got) > 0.97
    rows = {r["doc_id"]: r for r in lang_id.predict(odd, model).collect()}
    assert rows[4]["lang_pred"] == rows[5]["lang_pred"] == rows[6]["lang_pred"] == "und" and 0 <= rows[7]["score"] <= 1
    kept = lang_id.accept(odd, model)
    assert kept.columns == odd.columns and not {4, 5, 6} & {r["doc_id"] for r in kept.collect()}
    assert lang_id.accept(nothing, model).count() == lang_id.predict(nothing, model).count() == 0
    assert lang_id.train(nothing).languages == []


def test_quality(spark, odd, nothing):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    model = quality.train(docs, labels)
    got = quality.judge(docs, model).filter("not base_failed").join(labels, "doc_id").collect()
    good = [r["kept"] for r in got if r["quality"] == 1]
    bad = [r["kept"] for r in got if r["quality"] == 0]
    assert sum(good) / len(good) > 0.98 and sum(bad) / max(1, len(bad)) < 0.1
    rows = {r["doc_id"]: r for r in quality.judge(odd, model).collect()}
    assert rows[4]["base_failed"] and rows[4]["n_words"] == 0 and not rows[9]["kept"] and rows[7]["n_words"] == 40_000
    assert quality.keep(odd, model).columns == odd.columns
    assert quality.train(docs, labels.limit(0)) is None and quality.judge(nothing, None).count() == quality.keep(nothing, None).count() == 0


def test_html_on_spark(spark):
    pages = spark.createDataFrame(
        [(1, "u", "<body><nav>menu</nav><article><p>Main  text.</p></article>"), (1, "u", None), (None, None, ""), (2, "v", "<p>" + "long " * 50_000)],
        "page_id bigint, url string, html string",
    ).withColumn("text", F.lit("t"))
    rows = [tuple(r) for r in html_extract.extract(pages, html_extract.train()).collect()]
    assert rows[0] == (1, "u", "Main text.", 10) and rows[1] == (1, "u", "", 0) and rows[2] == (None, None, "", 0) and rows[3][3] == 249_999
    assert html_extract.extract(pages.limit(0), html_extract.train()).count() == 0


def test_pipeline(spark):
    import corpus_pipeline

    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["language ID", "quality rules", "line dedup", "n-gram Jaccard join", "best-fit packing"]
    rows = corpus_pipeline.run(spark, SMALL).collect()
    assert rows and check_packing(rows, catalog.CAPACITY)
