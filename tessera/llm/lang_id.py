"""Language identification: averaged hashed subword embeddings and a linear softmax,
trained by stochastic gradient descent in numpy, with calibrated rejection.

A document's vector is the mean of the embeddings of its subwords (character 1- to
4-grams with word edges, hashed into a fixed table); a linear layer and a softmax give
the language. Subwords that fewer than two training texts have share one embedding.

Rejection is learned: beside the languages there is a class "none of them", trained on texts made
from the sample's own: letters exchanged for others throughout (another language in the same
letters), letters shuffled, letters drawn at random, letters of other scripts. Part of the sample, with
its made texts, is held back to fit one temperature (the score is then a calibrated
probability) and the threshold: of the held-back texts no more than ``reject`` of the right ones are
turned away, whole texts and short pieces alike.

Training uses a bounded sample of labelled rows: at most ``sample_rows`` documents, about as
many of every language (of the ``most_languages`` most frequent), in hash order of their ids; of a text of more than
``sample_chars`` characters a piece of that length from a place by hash. Prediction reads every whole text.

Results for odd input: a null text or one without a letter is ``und`` with score 0 and
is rejected; a text of no learned language gets the language it resembles most, a low score,
and is rejected; with no labelled rows at all every text is ``und``; ties of probability go
to the first language in alphabetical order.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import release, small_batches, trim

UND = "und"
BUCKETS = 1 << 16
DIM = 16


LETTER = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
#: Odd multipliers of the rolling subword hash.
MIX = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F], np.uint32)
SLICE_CHARS = 1 << 18


def subwords(text: str) -> np.ndarray:
    """Hash buckets of all subwords of a text, in one vectorised pass: the character
    1- to 4-grams whose inner characters are letters and whose ends are letters or a
    word's edge (one blank stands for anything that is not a letter)."""
    code = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)
    letter = np.concatenate([[False], LETTER[code], [False]])
    code = np.where(letter, np.concatenate([[0], code, [0]]), 32).astype(np.uint32)
    out = [code[letter] * MIX[0]]
    for n in (2, 3, 4):
        size = len(code) - n + 1
        if size <= 0:
            break
        inner = letter[: len(code) - 1] | letter[1:] if n == 2 else letter[1 : 1 + size].copy()
        if n == 4:
            inner &= letter[2 : 2 + size]
        at = np.flatnonzero(inner[:size])
        out.append(sum((code[at + i] * MIX[i] for i in range(n)), np.full(len(at), n, np.uint32) * np.uint32(0x165667B1)))
    h = np.concatenate(out)
    h ^= h >> np.uint32(15)
    h *= np.uint32(0x2C1B3C6D)
    return (h >> np.uint32(13)) & np.uint32(BUCKETS - 1)


def slices(text: str):
    """A long text in slices that end where a word ends (so no subword is lost); a
    longer run of letters is cut."""
    at = 0
    while at < len(text):
        to = min(at + SLICE_CHARS, len(text))
        while at + SLICE_CHARS // 2 < to < len(text) and text[to - 1].isalpha():
            to -= 1
        yield text[at:to]
        at = to


@dataclass
class Model:
    languages: list[str]
    table: np.ndarray  # BUCKETS x DIM
    weights: np.ndarray  # DIM x (languages, then none of them)
    temperature: float
    threshold: float


class Scorer:
    """Scores texts. The linear layer is applied to the embedding table once, so a text
    sums one row of logits per subword."""

    def __init__(self, model: Model):
        self.m = model
        self.logits = (model.table @ model.weights).astype(np.float32)

    def sums(self, text: str) -> tuple[np.ndarray, int]:
        """Summed logits and the number of subwords of a whole text."""
        total, n = np.zeros(self.logits.shape[1]), 0
        for part in slices(text):
            ids = subwords(part)
            total += self.logits.take(ids, axis=0).sum(axis=0, dtype=np.float64)
            n += len(ids)
        return total, n

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        total, n = self.sums(text) if text and self.m.languages else (None, 0)
        if not n:
            return UND, 0.0, True
        p = softmax(total / n / self.m.temperature)
        best = int(p[:-1].argmax())
        return self.m.languages[best], float(p[best]), bool(p[best] < self.m.threshold)


def softmax(z: np.ndarray) -> np.ndarray:
    p = np.exp(z - z.max(axis=-1, keepdims=True))
    return p / p.sum(axis=-1, keepdims=True)


#: First letters of scripts for made texts, and how many follow.
SCRIPTS = [(0x430, 32), (0x3B1, 24), (0x5D0, 27), (0x627, 28), (0x905, 50), (0xE01, 44), (0x4E00, 3000), (0x3042, 80), (0xAC00, 3000), (0x10D0, 33), (0x561, 38)]


def made_texts(text: str, letters: np.ndarray, kind: int, rng: np.random.Generator) -> str:
    """A text of no language with the shape of ``text``; ``letters`` are those of the sample."""
    code = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32).copy()
    spots = np.flatnonzero(LETTER[code])
    if kind == 0:  # one letter for another throughout
        found, which = np.unique(code[spots], return_inverse=True)
        code[spots] = rng.choice(letters, len(found), replace=len(found) > len(letters))[which]
    elif kind == 1:
        code[spots] = rng.permutation(code[spots])
    elif kind == 2:
        code[spots] = rng.choice(letters, len(spots))
    else:
        first, many = SCRIPTS[rng.integers(len(SCRIPTS))]
        code[spots] = first + np.minimum(rng.integers(0, many, len(spots)), rng.integers(0, many, len(spots)))
    return code.tobytes().decode("utf-32-le", "replace")


def pieces(text: str, rng: np.random.Generator) -> list[str]:
    """The text, and a short piece of it."""
    words = text.split()
    at, n = int(rng.integers(0, max(1, len(words)))), int(rng.integers(2, 12))
    return [text, " ".join(words[at : at + n])]


def fit(rows: list[tuple[str, str]], epochs: int = 4, rate: float = 20.0, seed: int = 7, reject: float = 0.002) -> Model:
    """Train on ``(text, language)`` rows; every fifth row is kept for calibration.

    ``reject`` is the share of rightly labelled calibration texts that the threshold may
    turn away; it never exceeds a probability of 0.5.
    """
    languages = sorted({lang for _, lang in rows})
    none, rng = len(languages), np.random.default_rng(seed)
    table = rng.uniform(-0.5 / DIM, 0.5 / DIM, (BUCKETS + 1, DIM))  # the last row stands for rare subwords
    weights = np.zeros((DIM, len(languages) + 1))
    letters = np.array(sorted(map(ord, set("".join(t for t, _ in rows).lower()))), np.uint32)
    letters = letters[LETTER[letters]]
    texts: list[list[tuple[str, int]]] = []
    for k, (text, lang) in enumerate(rows):
        own = [(p, languages.index(lang)) for p in pieces(text, rng)]
        if len(letters):
            base = text[:2000] if k % 2 else own[1][0]
            own.append((made_texts(base, letters, k % 4, rng), none))
        texts.append(own)
    held = [x for i, own in enumerate(texts) if i % 5 == 0 for x in own]
    train = [x for i, own in enumerate(texts) if i % 5 or len(texts) < 5 for x in own]
    times = np.zeros(BUCKETS, np.int64)
    for text, y in train:
        if y != none:
            times[np.unique(subwords(text))] += 1
    # a whole text and its piece both count, so twice for one text
    place = np.where(times > 2, np.arange(BUCKETS), BUCKETS)

    def coded(part: list[tuple[str, int]]) -> list[tuple[np.ndarray, np.ndarray, int]]:
        """Subwords of every text and how often it has them, in 8 bytes a subword (the driver holds all)."""
        out = []
        for text, y in part:
            ids, n = np.unique(place[subwords(text)], return_counts=True)
            if len(ids):
                out.append((ids.astype(np.int32), n.astype(np.int32), y))
        return out

    data = coded(train)
    steps, total = 0, max(1, epochs * len(data))
    for _ in range(epochs):
        for k in rng.permutation(len(data)):
            idx, n, y = data[k]
            share = n / n.sum()
            lr = rate * (1 - steps / total)
            hidden = share @ table[idx]
            g = softmax(hidden @ weights)
            g[y] -= 1
            back = weights @ g
            weights -= 0.05 * lr * np.outer(hidden, g)
            table[idx] -= lr * share[:, None] * back
            steps += 1
    temperature, threshold = 1.0, 0.5
    data = coded(held)
    if data:
        z = np.stack([((n / n.sum()) @ table[idx]) @ weights for idx, n, _ in data])
        y = np.array([c for _, _, c in data])

        def loss(t: float) -> float:
            return float(-np.log(np.maximum(softmax(z / t)[np.arange(len(y)), y], 1e-12)).mean())

        temperature = min(np.geomspace(0.001, 10, 160), key=loss)
        p = softmax(z / temperature)[:, :-1] if none else np.zeros((len(y), 1))
        right = p.max(axis=1)[(p.argmax(axis=1) == y) & (y != none)]
        if len(right):
            threshold = float(min(0.5, np.quantile(right, reject)))
    table = table[place]
    return Model(languages, table.astype(np.float32), weights.astype(np.float32), float(temperature), threshold)


def held_out(id_col: str) -> F.Column:
    """The contract's held-out rows: crc32 of the id as text leaves 2 when divided by 4."""
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def train(
    docs: DataFrame, sample_rows: int = 3000, sample_chars: int = 20_000, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", most_languages: int = 200
) -> Model:
    """Fit on the bounded sample of labelled documents that are not held out. Ids are sampled first, the
    same number of every language where it has as many; only the sampled documents' texts are gathered."""
    lang = F.col(lang_col)
    labelled = docs.filter(lang.isNotNull() & F.col(id_col).isNotNull() & ~held_out(id_col) & F.col(text_col).isNotNull())
    keys = labelled.select(F.col(id_col).alias("i"), lang.alias("l"), F.xxhash64(F.col(text_col)).alias("h"))
    counts = keys.groupBy("l").count().orderBy(F.desc("count"), "l").limit(most_languages).collect()
    if not counts:
        return fit([])
    # languages with few rows leave their share to the others
    quota, left, rest = {}, sample_rows, len(counts)
    for r in sorted(counts, key=lambda r: (r["count"], r["l"])):
        quota[r["l"]] = min(r["count"], left // rest)
        left, rest = left - quota[r["l"]], rest - 1
    rank = F.xxhash64("i", "h")

    def bound(n: int, count: int) -> int:
        return min(2**63 - 1, int(-(2**63) + 2**64 * min(1.0, (1.3 * n + 20) / count)))

    parts = [F.when(F.col("l") == c["l"], rank <= bound(quota[c["l"]], c["count"])) for c in counts]
    few = keys.filter(F.coalesce(*parts, F.lit(False))).withColumn("rank", rank)  # a hash bound first, then the exact number
    window = Window.partitionBy("l").orderBy("rank", "i", "h")
    most = F.element_at(F.create_map(*[x for name, n in quota.items() for x in (F.lit(name), F.lit(n))]), F.col("l"))
    picked = few.withColumn("nth", F.row_number().over(window)).filter(F.col("nth") <= most).select(F.col("i").alias("p_i"), F.col("h").alias("p_h"))
    text = F.col(text_col)
    start = F.pmod(F.xxhash64(text, F.lit(1)), F.greatest(F.lit(1), F.length(text) - sample_chars)).cast("int") + 1
    taken = labelled.join(F.broadcast(picked.distinct()), F.col(id_col) == F.col("p_i"), "left_semi")
    rows = taken.select(F.col(id_col).alias("i"), lang.alias("l"), F.xxhash64(text).alias("h"), F.substring(text, start, F.lit(sample_chars)).alias("t"))
    rows = rows.join(F.broadcast(picked.distinct()), (F.col("i") == F.col("p_i")) & (F.col("h") == F.col("p_h")), "left_semi").dropDuplicates(["i", "l", "h"])
    model = fit([(r["t"], r["l"]) for r in rows.orderBy(F.xxhash64("i", "h"), "i", "h", "l").limit(sample_rows).collect()])
    trim()  # the sample and what it was coded to; else the driver keeps that memory for all later steps
    return model


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, lang_pred, score, rejected`` of every row, from the text alone."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        release()
        scorer = Scorer(shared.value)
        for batch in batches:
            out = list(zip(*(scorer.predict(t.as_py()) for t in batch.column(1)))) or [(), (), ()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(out[0], pa.string()), pa.array(out[1], pa.float64()), pa.array(out[2], pa.bool_())],
                names=["doc_id", "lang_pred", "score", "rejected"],
            )

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).transform(small_batches).mapInArrow(
        run, f"doc_id {kind}, lang_pred string, score double, rejected boolean"
    )


def accept(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` (all their columns) that the model does not reject."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)

    def run(batches):
        release()
        scorer = Scorer(shared.value)
        for batch in batches:
            yield batch.filter(pa.array([not scorer.predict(t.as_py())[2] for t in batch.column(at)], pa.bool_()))

    return docs.transform(small_batches).mapInArrow(run, docs.schema)
