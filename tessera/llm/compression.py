"""Quality classifier by compression: zstandard dictionaries of good and of bad texts.

Two dictionaries are trained, on good and on bad labelled texts. A text is compressed piece
by piece (so that the dictionary counts for all of it, not just its start) with each, and

    x = (size with the bad one - size with the good one) / (bytes of the text + 200)

is its normalised difference: above 0 the text resembles the good ones. Related to the
text's own length, a text that only repeats itself has almost no difference. A logistic
curve over ``x`` and the logarithm of the length (short texts give little evidence), fitted
on labelled rows that no dictionary has seen, turns it into a probability of label 1.

Training uses a bounded sample of labelled rows: ``sample_rows`` ids by hash, of whose
documents those of at most ``sample_chars`` characters count; three quarters make the
dictionaries, a quarter the curve. Scores read every whole text.

Results for odd input: null and empty texts have x = 0 and length 0 and are scored by the
same curve; without labels every score is 0.5, with one class only, the share of label 1 of
the sample plus one row of each class; repeated rows get equal scores; labels that
contradict each other all count; a null id is scored and never learned from; columns other
than id and text are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import hash_sample, release, small_batches
from tessera.llm.lang_id import held_out

PIECE = 2000
LEVEL = 3
DICTIONARY_BYTES = 112_640
#: Bytes added to a text's length, so that a difference of a few bytes in a short text is small.
SLACK = 200
#: Scores from here on predict label 1.
ACCEPT = 0.7


@dataclass
class Model:
    good: bytes
    bad: bytes
    raw: bool  # contents of texts instead of trained dictionaries (samples too small to train on)
    weights: list[float]  # constant, x, log length


def pieces(text: bytes) -> list[bytes]:
    return [text[i : i + PIECE] for i in range(0, len(text), PIECE)]


def compressor(content: bytes, raw: bool) -> zstandard.ZstdCompressor:
    kind = zstandard.DICT_TYPE_RAWCONTENT if raw else zstandard.DICT_TYPE_FULLDICT
    known = zstandard.ZstdCompressionDict(content, dict_type=kind)
    known.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=known, write_content_size=False, write_dict_id=False, write_checksum=False)


class Scorer:
    def __init__(self, model: Model):
        self.good, self.bad = compressor(model.good, model.raw), compressor(model.bad, model.raw)
        self.weights = np.array(model.weights)

    def features(self, text: str | None) -> list[float]:
        raw = (text or "").encode("utf-8", "replace")
        more = sum(len(self.bad.compress(p)) - len(self.good.compress(p)) for p in pieces(raw))
        return [1.0, 100 * more / (len(raw) + SLACK), float(np.log1p(len(raw)))]

    def score(self, text: str | None) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.weights @ self.features(text), -35, 35))))


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.1) -> np.ndarray:
    """Weights of a logistic curve by Newton steps (every step halved until the loss falls)."""
    w = np.zeros(x.shape[1])

    def loss(w: np.ndarray) -> float:
        z = x @ w
        return float(np.logaddexp(0, z).sum() - y @ z + ridge / 2 * w @ w)

    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -35, 35)))
        slope = x.T @ (p - y) + ridge * w
        step = np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + ridge * np.eye(len(w)), slope)
        size = 1.0
        while size > 1e-6 and loss(w - size * step) > loss(w):
            size /= 2
        w = w - size * step
        if np.abs(size * step).max() < 1e-8:
            break
    return w


def dictionaries(good: list[bytes], bad: list[bytes]) -> tuple[bytes, bytes, bool]:
    """Dictionaries of both classes; the texts themselves where there is too little to train on."""
    try:
        both = [zstandard.train_dictionary(DICTIONARY_BYTES, [p for t in c for p in pieces(t)], k=200, d=8, level=LEVEL).as_bytes() for c in (good, bad)]
        return both[0], both[1], False
    except zstandard.ZstdError:
        return *(b"\n".join(c)[-DICTIONARY_BYTES:].rjust(8) for c in (good, bad)), True


def fit(rows: list[tuple[str, int]]) -> Model | float:
    """Model of ``(text, label)`` rows; with one class or none, the score of every text."""
    rows = [(t or "", y) for t, y in rows]
    kinds = [sum(y == c for _, y in rows) for c in (0, 1)]
    if not all(kinds):
        return (kinds[1] + 1) / (len(rows) + 2)
    seen, left, number = [], [], [0, 0]
    for t, y in rows:  # every fourth row of a class is left for the curve
        number[y] += 1
        (left if number[y] % 4 == 0 else seen).append((t, y))
    left = left if {y for _, y in left} == {0, 1} else rows
    good, bad, raw = dictionaries(*([t.encode("utf-8", "replace") for t, y in seen if y == c] for c in (1, 0)))
    scorer = Scorer(Model(good, bad, raw, [0.0, 0.0, 0.0]))
    x = np.array([scorer.features(t) for t, _ in left])
    return Model(good, bad, raw, logistic(x, np.array([float(y) for _, y in left])).tolist())


def train(
    docs: DataFrame, labels: DataFrame, sample_rows: int = 4000, sample_chars: int = 12_000,
    id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
) -> Model | float:
    """Fit on the bounded sample of labelled documents that are not held out. Ids are sampled
    first; only the sampled documents' texts are gathered."""
    known = labels.filter(F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1) & ~held_out(id_col))
    known = known.select(F.col(id_col).alias("l_id"), F.col(label_col).cast("int").alias("l_y")).distinct()
    sample = hash_sample(known, sample_rows, "l_id", "l_y")
    text = docs.select(F.col(id_col).alias("d_id"), F.col(text_col).alias("t")).filter(F.coalesce(F.length("t"), F.lit(0)) <= sample_chars)
    picked = text.join(F.broadcast(sample), F.col("d_id") == F.col("l_id")).withColumn("h", F.xxhash64("t"))
    picked = picked.select("l_id", "l_y", "h", "t").dropDuplicates(["l_id", "l_y", "h"])
    rows = hash_sample(picked, sample_rows, "l_id", "l_y", "h").collect()
    return fit([(r["t"], r["l_y"]) for r in rows])


def score(docs: DataFrame, model: Model | float, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row, the score from the text alone."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        release()
        one = shared.value
        scorer = Scorer(one) if isinstance(one, Model) else None
        for batch in batches:
            values = [scorer.score(t.as_py()) if scorer else one for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(values, pa.float64()), pa.array([int(v >= ACCEPT) for v in values], pa.int32())],
                names=["doc_id", "held_out", "score", "predicted"],
            )

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("doc_id"), held_out(id_col).alias("held_out"), F.col(text_col).alias("text"))
    return rows.transform(small_batches).mapInArrow(run, f"doc_id {kind}, held_out boolean, score double, predicted int")
