"""Word n-gram Jaccard join: a grouped prefix join with component-aware candidates.

1. Every whole text becomes its set of distinct word shingles (64-bit hashes); equal sets
   collapse to one node.
2. Shingles have one global order: the most frequent ones of a bounded list last, the
   others by hash. Linked sets share at least ``l`` shingles of their prefixes (the
   first ``n - ceil(t * n) + l``).
3. Nodes with identical prefix and size form one group; groups that share prefix
   shingles meet in a bucket. Group pairs are filtered by size and by the number of
   shared prefix shingles, then expanded to members and verified on the whole sets.
4. A bucket first pairs all its groups with one hub (the group with the most frequent
   prefix); what that connects is one component. Only groups of different components
   that still share a bucket are paired in full, so a large family of copies costs a
   star, not all its pairs, and no link between components is lost. Large buckets that
   the star does not settle are compared block by block on the whole sets, where only
   links that join components leave a task.

Nodes are 64-bit digests of the sets. Results for odd input: a null or empty text, or one
without words, has an empty set and is linked with nothing; a text with fewer words than
a shingle is one shingle; rows without an id are not joined (component null); rows that
repeat an id are judged by their own texts.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import fresh, materialize, release, small, small_batches
from tessera.llm.components import connected_components

#: Prefix shingles that a linked pair must share (fewer for tiny sets).
SHARED = 3
#: A shingle in more prefixes than this may go to the end of the order ...
FREQUENT = 24
#: ... if it is among this many most frequent ones (the list is broadcast).
FREQUENT_LIST = 300_000
#: Buckets of at most this many groups pair them in full; the groups of larger ones that
#: hold several components form families, which are compared block by block.
PAIRED_IN_FULL = 64
#: Member pairs up to which a group pair is expanded; larger ones form families too.
EXPANDED_IN_FULL = 4096
#: Bytes of sets in one block of a family.
BLOCK_BYTES = 4 << 20


def shingles(text: str | None, k: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word k-grams (A-Z lower-cased, words cut at
    ASCII white space); the whole sequence if it has fewer words."""
    words = (text or "").encode("utf-8", "replace").lower().split()
    n = len(words)
    if not n:
        return np.zeros(0, np.uint64)
    v = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, n)
    k = min(k, n)
    h = np.full(n - k + 1, 0x9E3779B97F4A7C15 + k, np.uint64)
    for i in range(k):
        h = (h ^ v[i : n - k + 1 + i]) * np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(31)
    return np.unique(h)


def least_overlap(n: int, percent: int) -> int:
    """Shingles that any set linked with one of n shingles shares with it, at least."""
    return -(-percent * n // 100)


def prefix_length(n: int, percent: int) -> int:
    need = least_overlap(n, percent)
    return n - need + min(SHARED, need)


def signed(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)


def node_of(h: np.ndarray) -> int | None:
    return int.from_bytes(hashlib.blake2b(h.tobytes(), digest_size=8).digest(), "little", signed=True) if len(h) else None


def documents_nodes(docs: DataFrame, k: int) -> DataFrame:
    """``doc_id, node, n`` of every row of ``docs`` (``doc_id, text``)."""

    def run(batches):
        release()
        for batch in batches:
            sets = [shingles(t.as_py(), k) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([node_of(h) for h in sets], pa.int64()), pa.array([len(h) for h in sets], pa.int64())],
                names=["doc_id", "node", "n"],
            )

    return docs.transform(small_batches).mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, node bigint, n bigint")


def starts(docs: DataFrame, k: int, percent: int) -> DataFrame:
    """``node, n, first``: the smallest hashes of every node, one and a half prefixes long."""

    def run(batches):
        release()
        for batch in batches:
            sets = [h for t in batch.column(1) if len(h := shingles(t.as_py(), k))]
            yield pa.RecordBatch.from_arrays(
                [pa.array([node_of(h) for h in sets], pa.int64()), pa.array([len(h) for h in sets], pa.int64()),
                 pa.array([signed(h[: 3 * prefix_length(len(h), percent) // 2]) for h in sets], pa.list_(pa.int64()))],
                names=["node", "n", "first"],
            )

    return docs.transform(small_batches).mapInArrow(run, "node bigint, n bigint, first array<bigint>").dropDuplicates(["node"])


def full_sets(docs: DataFrame, nodes: DataFrame, one_doc: DataFrame, k: int) -> DataFrame:
    """``node, h`` (the whole set, as bytes) of the given nodes, from their texts."""
    ids = materialize(one_doc.join(nodes, one_doc["node"] == nodes["w"], "left_semi"), "wanted")
    texts = docs.join(small(ids.select(F.col("one").alias("w_id"))), F.col("doc_id") == F.col("w_id"), "left_semi")

    def run(batches):
        release()
        for batch in batches:
            sets = [h for t in batch.column(1) if len(h := shingles(t.as_py(), k))]
            yield pa.RecordBatch.from_arrays(
                [pa.array([node_of(h) for h in sets], pa.int64()), pa.array([h.tobytes() for h in sets], pa.binary())], names=["node", "h"]
            )

    return texts.transform(small_batches).mapInArrow(run, "node bigint, h binary")


def prefixes(source: DataFrame, frequent, percent: int, whole: bool) -> DataFrame:
    """``node, n, prefix, plain``: prefixes in the global order from ``first`` (or whole
    sets ``h``); ``prefix`` is null where ``first`` does not reach far enough. ``plain``
    counts its shingles that are not on the frequent list."""

    def run(batches):
        release()
        last = frequent.value
        for batch in batches:
            ids, ns, out, plain = [], [], [], []
            for node, n, first in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                h = np.frombuffer(first.as_py(), np.int64) if whole else first.values.to_numpy(zero_copy_only=False)
                n = len(h) if whole else n
                p = prefix_length(n, percent)
                late = np.zeros(len(h), bool)
                if len(last):
                    at = np.minimum(np.searchsorted(last, h), len(last) - 1)
                    late = last[at] == h
                rare = h[~late]
                ids.append(node)
                ns.append(n)
                plain.append(min(p, len(rare)))
                out.append(np.concatenate([rare, h[late]])[:p] if len(rare) >= p or len(h) == n else None)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(ns, pa.int64()), pa.array(out, pa.list_(pa.int64())), pa.array(plain, pa.int64())],
                names=["node", "n", "prefix", "plain"],
            )

    return source.transform(small_batches).mapInArrow(run, "node bigint, n bigint, prefix array<bigint>, plain bigint")


def verified(pairs: DataFrame, docs: DataFrame, one_doc: DataFrame, k: int, percent: int) -> DataFrame:
    """The pairs (``a, b``) whose whole sets are similar enough."""
    pairs = materialize(pairs, "pairs")
    wanted = pairs.select(F.col("a").alias("w")).union(pairs.select("b")).distinct()
    sets = materialize(full_sets(docs, wanted, one_doc, k).dropDuplicates(["node"]), "sets")
    left = sets.select(F.col("node").alias("a_node"), F.col("h").alias("ha"))
    right = sets.select(F.col("node").alias("b_node"), F.col("h").alias("hb"))
    joined = pairs.join(right, F.col("b") == F.col("b_node")).join(left, F.col("a") == F.col("a_node")).select("a", "b", "ha", "hb")

    def run(batches):
        release()
        for batch in batches:
            ok = []
            for x, y in zip(batch.column(2), batch.column(3)):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = np.concatenate([x, y])
                both.sort(kind="stable")
                common = int((both[1:] == both[:-1]).sum())
                ok.append(100 * common >= percent * (len(both) - common))
            yield batch.select([0, 1]).filter(pa.array(ok, pa.bool_()))

    return joined.transform(small_batches).mapInArrow(run, "a bigint, b bigint")


def links(docs: DataFrame, nodes: DataFrame, k: int, percent: int) -> DataFrame:
    """``node, label``: components of the nodes that have a link."""
    spark = docs.sparkSession
    one_doc = materialize(nodes.filter("node is not null").groupBy("node").agg(F.min("doc_id").alias("one")), "one-doc")
    first = materialize(starts(docs, k, percent), "starts")
    counts = first.select(F.explode("first").alias("t")).groupBy("t").agg(F.count("*").alias("c")).filter(F.col("c") > FREQUENT)
    counts = materialize(counts.withColumn("grade", F.floor(F.log2("c") * 8)), "frequent")
    # the list ends at the lowest grade of frequency (at most some hundred exist) that fits
    fits, lowest = 0, None
    for grade, n in sorted(((r["grade"], r["count"]) for r in counts.groupBy("grade").count().collect()), reverse=True):
        fits += n
        if fits > FREQUENT_LIST:
            break
        lowest = grade
    often = np.zeros(0, np.int64)
    if lowest is not None:
        # by Arrow: as rows the list would take some hundred bytes a hash on the driver
        often = counts.filter(F.col("grade") >= lowest).select("t").toArrow()["t"].to_numpy().astype(np.int64, copy=False)
    frequent = spark.sparkContext.broadcast(np.sort(often))
    near = materialize(prefixes(first, frequent, percent, False), "prefixes")
    short = near.filter("prefix is null").select(F.col("node").alias("w"))
    far = prefixes(full_sets(docs, short, one_doc, k).dropDuplicates(["node"]).selectExpr("node", "0L as n", "h"), frequent, percent, True)
    all_of = materialize(near.filter("prefix is not null").unionByName(far).withColumn("key", F.xxhash64("n", "prefix")), "prefixes")

    groups = all_of.groupBy("n", "key").agg(F.min("node").alias("gid")).select(F.col("n").alias("g_n"), F.col("key").alias("g_key"), "gid")
    members = materialize(
        all_of.join(groups, (F.col("n") == F.col("g_n")) & (F.col("key") == F.col("g_key"))).select("gid", "node", "n"), "members"
    )
    heads = members.filter("gid = node").select(F.col("gid").alias("h_gid"))
    tokens = all_of.join(heads, F.col("node") == F.col("h_gid"), "left_semi").select(
        F.explode("prefix").alias("t"), F.col("node").alias("gid"), "n", "plain"
    )
    hubs = (
        tokens.groupBy("t").agg(F.min(F.struct("plain", "gid", "n")).alias("hub"), F.count("*").alias("c")).filter("c > 1")
        .select(F.col("t").alias("h_t"), F.col("hub.gid").alias("hub"), F.col("hub.n").alias("hub_n"))
    )
    buckets = materialize(tokens.join(hubs, F.col("t") == F.col("h_t")).select("t", "gid", "n", "hub", "hub_n"), "buckets")

    def similar_size(x: str, y: str) -> F.Column:
        return 100 * F.least(x, y) >= percent * F.greatest(x, y)

    def enough(x: str, y: str) -> F.Column:
        """Shared prefix shingles that a link needs; sizes bound the overlap below."""
        need = F.ceil(percent * F.least(x, y) / 100)
        return F.col("count") >= F.least(F.lit(SHARED), need)

    star = (
        buckets.filter(F.col("gid") != F.col("hub")).filter(similar_size("n", "hub_n"))
        .groupBy("hub", "gid", "n", "hub_n").count().filter(enough("n", "hub_n")).select("hub", F.col("gid").alias("s_gid"))
    )
    spread = star.join(members, F.col("s_gid") == F.col("gid")).select(F.col("hub").alias("a"), F.col("node").alias("b"))
    within = members.filter("gid <> node").select(F.col("gid").alias("a"), F.col("node").alias("b"))
    found = materialize(verified(spread.union(within), docs, one_doc, k, percent), "links")
    labels = connected_components(found)

    placed = members.join(labels.select(F.col("node").alias("l_node"), "label"), F.col("node") == F.col("l_node"), "left")
    placed = materialize(placed.select("gid", "node", "n", F.coalesce("label", "node").alias("label")), "placed")
    span = placed.groupBy("gid").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.count("*").alias("m"))
    span = materialize(span.withColumnRenamed("gid", "p_gid"), "span")
    known = buckets.select("t", "gid", "n").join(span, F.col("gid") == F.col("p_gid")).drop("p_gid")
    known = materialize(known, "known")
    mixed = known.groupBy("t").agg(F.min("lo").alias("l"), F.max("hi").alias("h"), F.min("gid").alias("lead"), F.count("*").alias("c"))
    mixed = materialize(mixed.filter("l <> h").select(F.col("t").alias("m_t"), "lead", "c"), "mixed")
    few = known.join(mixed.filter(F.col("c") <= PAIRED_IN_FULL), F.col("t") == F.col("m_t"), "left_semi")
    many = known.join(mixed.filter(F.col("c") > PAIRED_IN_FULL), F.col("t") == F.col("m_t")).select(F.col("lead").alias("a"), F.col("gid").alias("b"))
    x, y = (few.select(*(F.col(c).alias(f"{s}_{c}") for c in ("t", "gid", "n", "lo", "hi", "m"))) for s in "xy")
    settled = (F.col("x_lo") == F.col("x_hi")) & (F.col("y_lo") == F.col("y_hi")) & (F.col("x_lo") == F.col("y_lo"))
    pairs = (
        x.join(y, (F.col("x_t") == F.col("y_t")) & (F.col("x_gid") < F.col("y_gid")) & similar_size("x_n", "y_n") & ~settled)
        .groupBy("x_gid", "y_gid", "x_n", "y_n", "x_m", "y_m").count()
    )
    pairs = materialize(pairs, "group-pairs")
    wide = (F.col("x_m") * F.col("y_m") > EXPANDED_IN_FULL) & enough("x_n", "y_n")
    torn = span.filter("lo <> hi").select(F.col("p_gid").alias("a"), F.col("p_gid").alias("b"))
    kin = many.union(pairs.filter(wide).select("x_gid", "y_gid")).union(torn)
    families = connected_components(kin).select(F.col("node").alias("f_gid"), F.col("label").alias("family"))
    families = materialize(families, "families")

    f1, f2 = (families.select(F.col("f_gid").alias(f"{s}_f_gid"), F.col("family").alias(f"{s}_f")) for s in "xy")
    apart = (
        pairs.filter(enough("x_n", "y_n")).join(f1, F.col("x_gid") == F.col("x_f_gid"), "left").join(f2, F.col("y_gid") == F.col("y_f_gid"), "left")
        .filter(F.coalesce(F.col("x_f") != F.col("y_f"), F.lit(True))).select("x_gid", "y_gid")
    )
    a = placed.select(F.col("gid").alias("a_gid"), F.col("node").alias("a"), F.col("label").alias("a_label"))
    b = placed.select(F.col("gid").alias("b_gid"), F.col("node").alias("b"), F.col("label").alias("b_label"))
    cross = (
        apart.join(a, F.col("x_gid") == F.col("a_gid"))
        .join(b, (F.col("y_gid") == F.col("b_gid")) & (F.col("a_label") != F.col("b_label"))).select("a", "b")
    )
    more = materialize(verified(cross, docs, one_doc, k, percent), "links")
    relatives = placed.join(families, F.col("gid") == F.col("f_gid")).select("family", "node", "n", "label")
    more = more.union(materialize(family_links(relatives, docs, one_doc, k, percent), "links"))
    if not more.limit(1).count():
        return labels
    return connected_components(found.union(more))


def linked_across(nodes: list, labels: list, sets: list[np.ndarray], at: int, percent: int) -> list[tuple[int, int]]:
    """Links between sets ``[:at]`` and ``[at:]`` (among all if ``at`` is 0) that join
    two components; links that the ones before make superfluous are left out."""
    top: dict[int, int] = {}

    def find(v: int) -> int:
        while top.get(v, v) != v:
            top[v] = v = top.get(top[v], top[v])
        return v

    sizes = np.array([len(s) for s in sets], np.int64)
    rest = sets[at:]
    if not rest or not sets:
        return []
    tokens, owner = np.concatenate(rest), np.repeat(np.arange(len(rest)), sizes[at:])
    order = np.argsort(tokens, kind="stable")
    tokens, owner = tokens[order], owner[order]
    out = []
    for i in range(at or len(sets)):
        lo, hi = np.searchsorted(tokens, sets[i], "left"), np.searchsorted(tokens, sets[i], "right")
        many = hi - lo
        spots = np.repeat(hi - np.cumsum(many), many) + np.arange(many.sum())
        common = np.bincount(owner[spots], minlength=len(rest))
        for j in np.flatnonzero(100 * common >= percent * (sizes[i] + sizes[at:] - common)):
            p, q = find(labels[i]), find(labels[at + int(j)])
            if p != q:
                top[max(p, q)] = min(p, q)
                out.append((nodes[i], nodes[at + int(j)]))
    return out


def family_links(relatives: DataFrame, docs: DataFrame, one_doc: DataFrame, k: int, percent: int) -> DataFrame:
    """Links between different components of a family (``family, node, n, label``).

    Sizes of linked sets differ by at most the threshold, so they lie in the same or
    neighbouring size classes. Each class is cut by hash into blocks of bounded bytes,
    and every task compares two blocks; nothing holds a family whole.
    """
    width = float(np.log(100 / percent)) or 1.0
    sized = materialize(relatives.withColumn("cls", F.floor(F.log("n") / width + F.lit(1e-9)).cast("bigint")), "relatives")
    blocks = sized.groupBy("family", "cls").agg(F.ceil(F.sum("n") * 8 / BLOCK_BYTES).cast("bigint").alias("parts"))
    own, near = (blocks.select(F.col("family").alias(f"{s}_fam"), F.col("cls").alias(f"{s}_cls"), F.col("parts").alias(f"{s}_parts")) for s in "on")
    cut = sized.join(own, (F.col("family") == F.col("o_fam")) & (F.col("cls") == F.col("o_cls")))
    cut = cut.withColumn("part", F.pmod(F.xxhash64("node"), F.col("o_parts")))
    # a block meets the blocks of its own class and of the next: keys name the lower block first
    same = cut.select(
        "family", "cls", F.lit(0).alias("step"), "node", "label", "part", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("o_parts") - 1)).alias("other")
    ).select(
        "family", "cls", "step", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"),
        (F.col("part") > F.col("other")).cast("int").alias("side"), "node", "label",
    )
    upper = cut.join(near, (F.col("family") == F.col("n_fam")) & (F.col("cls") + 1 == F.col("n_cls"))).select(
        "family", "cls", F.lit(1).alias("step"), F.col("part").alias("i"),
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("n_parts") - 1)).alias("j"), F.lit(0).alias("side"), "node", "label",
    )
    lower = cut.join(near, (F.col("family") == F.col("n_fam")) & (F.col("cls") - 1 == F.col("n_cls"))).select(
        "family", F.col("n_cls").alias("cls"), F.lit(1).alias("step"),
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("n_parts") - 1)).alias("i"), F.col("part").alias("j"), F.lit(1).alias("side"), "node", "label",
    )
    sets = full_sets(docs, sized.select(F.col("node").alias("w")), one_doc, k).dropDuplicates(["node"])
    sets = materialize(sets.select(F.col("node").alias("s_node"), "h"), "sets")
    dealt = same.unionByName(upper).unionByName(lower).join(sets, F.col("node") == F.col("s_node")).drop("s_node")

    def compare(block: pa.Table) -> pa.Table:
        block = block.sort_by("side")
        side = block["side"].to_pylist()
        held = [np.frombuffer(h, np.uint64) for h in block["h"].to_pylist()]
        at = side.index(1) if 1 in side else 0
        whole = not at and block["step"][0].as_py() == 0 and block["i"][0] == block["j"][0]
        found = linked_across(block["node"].to_pylist(), block["label"].to_pylist(), held, at, percent) if at or whole else []
        return pa.table({"a": pa.array([p for p, _ in found], pa.int64()), "b": pa.array([q for _, q in found], pa.int64())})

    return dealt.groupBy("family", "cls", "step", "i", "j").applyInArrow(compare, "a bigint, b bigint")


def components(docs: DataFrame, k: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id`` (smallest doc_id reachable by links) of every
    row; texts link when ``100 * intersection >= percent * union`` of their shingles."""
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    named = docs.filter("doc_id is not null")
    nodes = materialize(documents_nodes(docs, k), "nodes")
    labels = links(named, nodes.filter("doc_id is not null"), k, percent)
    placed = nodes.join(labels.select(F.col("node").alias("l_node"), "label"), F.col("node") == F.col("l_node"), "left").select(
        "doc_id", "n", F.coalesce("label", "node").alias("label")
    )
    placed = materialize(placed, "placed")
    least = placed.groupBy("label").agg(F.min("doc_id").alias("least")).select(F.col("label").alias("m_label"), "least")
    return placed.join(least, F.col("label") == F.col("m_label"), "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce("least", "doc_id")).alias("component_id"),
    )


def keep_one(docs: DataFrame, k: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` (all their columns) but for those of a component that are not its
    first by (id, hash of the text). So where rows of different texts share an id, only copies go.
    Of rows that repeat id and text one stays (any: they differ in other columns at
    most). Rows without an id or without a word are linked with nothing and stay."""
    key, th = fresh(docs, "row_key", "text_hash")
    pair = F.struct(F.col(id_col).alias("id"), F.xxhash64(F.col(text_col)).alias("th"))
    keyed = docs.select(F.when(F.col(id_col).isNotNull(), pair).alias(key), F.col(text_col).alias(text_col))
    placed = materialize(components(keyed, k, percent, key, text_col).filter("doc_id is not null and n_shingles > 0"), "linked")
    drop = placed.filter("component_id <> doc_id").select(F.col("doc_id.id").alias("x_id"), F.col("doc_id.th").alias("x_th"), F.lit(True).alias("x_all"))
    again = placed.filter("component_id = doc_id").groupBy("doc_id").count().filter("count > 1")
    marks = drop.distinct().unionByName(again.select(F.col("doc_id.id").alias("x_id"), F.col("doc_id.th").alias("x_th"), F.lit(False).alias("x_all")))
    marks = materialize(marks, "marked")
    ids = small(marks.select(F.col("x_id").alias(key)).distinct())
    same = docs.join(ids, docs[id_col] == ids[key], "left_anti")
    touched = docs.join(ids, docs[id_col] == ids[key], "left_semi").withColumn(th, F.xxhash64(F.col(text_col)))
    touched = touched.join(marks, (F.col(id_col) == F.col("x_id")) & (F.col(th) == F.col("x_th")), "left").filter("x_all is null or not x_all")
    once = touched.filter("x_all is not null").dropDuplicates([id_col, th])
    return same.unionByName(touched.filter("x_all is null").unionByName(once).select(*docs.columns))
