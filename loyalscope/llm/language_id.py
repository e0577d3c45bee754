"""Language identification: averaged hashed subword embeddings under a linear softmax.

Trained by stochastic gradient descent in numpy on a bounded sample of labelled rows, with a temperature and a rejection
threshold fitted on rows of the sample that training leaves out.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loyalscope.llm.common import FOLD, appended, groups, release, text_bytes

UNKNOWN = "und"
SIZES = (2, 3, 4)  # bytes of a subword
BITS = 15  # 2^15 vectors for each size
DIMENSIONS = 16
CEILING = 0.2  # of the rejection threshold: 0.4 with four languages, 0.6 with two
#: Everything in ASCII that is no letter stands for a word's edge.
_FORM = FOLD.copy()
_FORM[[i for i in range(128) if not (65 <= i <= 90 or 97 <= i <= 122)]] = 32


def subwords(data: np.ndarray, starts: np.ndarray) -> list[np.ndarray]:
    """For each size, the vector number of the subword that begins at each byte; 2^15 where a text ends before it does."""
    form = _FORM[data].astype(np.uint32)
    left = np.repeat(starts[1:], np.diff(starts)) - np.arange(len(data))  # bytes to the end of the text
    out, key = [], form
    for size in range(2, max(SIZES) + 1):
        after = np.zeros_like(form)
        after[: 1 - size] = form[size - 1 :]
        key = key | (after << np.uint32(8 * (size - 1)))
        if size in SIZES:
            number = ((key * np.uint32(2654435761)) >> np.uint32(32 - BITS)).astype(np.int32)
            number[left < size] = 1 << BITS
            out.append(number)
    return out


@dataclass
class Model:
    languages: list[str]
    vectors: np.ndarray  # sizes x (2^15 + 1) x dimensions; the last vector is 0
    weights: np.ndarray  # languages x dimensions
    bias: np.ndarray
    temperature: float = 1.0
    threshold: float = 0.0

    def logits(self, data: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """A row for each text: the softmax's inputs."""
        folded = len(self.languages) <= DIMENSIONS  # then the linear layer goes into the vectors
        table = self.vectors @ self.weights.T if folded else self.vectors
        sums = np.zeros((len(starts) - 1, table.shape[2]))
        used = np.diff(starts) > 0
        count = np.zeros(len(starts) - 1)
        if len(data):
            for size, numbers in zip(SIZES, subwords(data, starts)):
                part = table[SIZES.index(size)]
                for k in range(table.shape[2]):
                    sums[used, k] += np.add.reduceat(np.ascontiguousarray(part[:, k])[numbers], starts[:-1][used], dtype=np.float64)
                count += np.maximum(0, np.diff(starts) - size + 1)
        mean = sums / np.maximum(count, 1)[:, None]
        return (mean if folded else mean @ self.weights.T) + self.bias

    def probabilities(self, data: np.ndarray, starts: np.ndarray) -> np.ndarray:
        return softmax(self.logits(data, starts) / self.temperature)


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


LEAST = 20  # rows of a label, as far as it has them, however many labels there are


def labelled_sample(docs: DataFrame, sample: int) -> DataFrame:
    """About `sample` rows (doc_id, text, lang), an even share of every label, but LEAST of each or as many as there are.

    Rows are picked by a hash of doc_id, so the pick doesn't depend on how the table is laid out.
    """
    known = docs.where("lang IS NOT NULL AND text IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.col("lang").cast("string").alias("lang"))
    counts = known.groupBy("lang").count().collect()  # a row for each label that the model will know
    share = max(LEAST, sample / max(1, len(counts)))
    rates = docs.sparkSession.createDataFrame([(r["lang"], share / r["count"]) for r in counts], "lang string, rate double")
    uniform = F.shiftrightunsigned(F.xxhash64(F.col("doc_id"), F.lit("sample")), 11) / F.lit(2.0**53)
    return known.join(rates, "lang").where(uniform < F.col("rate")).select("doc_id", "text", "lang")


def train(docs: DataFrame, sample: int = 3000, epochs: int = 3, seed: int = 7) -> Model:
    """Fit a model on a sample of about `sample` of the given labelled documents (doc_id, text, lang); every label is learned.

    Without labelled rows the model knows no language and every prediction is `und`. One step takes a stretch of some 300
    bytes from somewhere in a text, so short texts are learned as well as long ones.
    """
    table = labelled_sample(docs, sample).toArrow().sort_by([("doc_id", "ascending"), ("lang", "ascending")])
    names = sorted({x for x in table.column("lang").to_pylist()})
    rng = np.random.default_rng(seed)
    vectors = rng.normal(0, 0.3, (len(SIZES), (1 << BITS) + 1, DIMENSIONS)).astype(np.float32)
    vectors[:, -1] = 0
    model = Model(names, vectors, np.zeros((len(names), DIMENSIONS)), np.zeros(len(names)))
    if not names:
        return model
    label = np.array([names.index(x) for x in table.column("lang").to_pylist()])
    data, starts = text_bytes(table.column("text"))
    order = rng.permutation(len(label))
    held, fit = order[: len(order) // 5], order[len(order) // 5 :]
    steps = np.concatenate([rng.permutation(np.repeat(fit, 3)) for _ in range(epochs)])
    for i, doc in enumerate(steps):
        rate = 0.5 * (1 - i / len(steps))
        a, b = starts[doc], starts[doc + 1]
        if b - a > 300:
            a = rng.integers(a, b - 300)
            b = a + 300
        if b - a < 2:
            continue
        numbers = subwords(data[a:b], np.array([0, b - a]))
        numbers = [n[n < 1 << BITS] for n in numbers]
        n = sum(map(len, numbers))
        hidden = sum(vectors[s][x].sum(axis=0) for s, x in enumerate(numbers)) / n
        error = softmax((model.weights @ hidden + model.bias)[None])[0]
        error[label[doc]] -= 1
        back = (model.weights.T @ error) * (rate * 10 / n)  # few of the vectors are met in a step
        model.weights -= rate * np.outer(error, hidden)
        model.bias -= rate * 0.1 * error
        for s, x in enumerate(numbers):
            np.subtract.at(vectors[s], x, back.astype(np.float32))
    calibrate(model, data, starts, label, held if len(held) else fit)
    del table, data
    release()
    return model


def calibrate(model: Model, data: np.ndarray, starts: np.ndarray, label: np.ndarray, rows: np.ndarray) -> None:
    """The temperature with the best likelihood on rows left out of training, and a threshold below which at most one of
    a thousand of their right answers falls, but no more than CEILING of the way from chance to certainty: two languages may
    share a text."""
    logits = np.concatenate([model.logits(data[starts[r] : starts[r + 1]], np.array([0, starts[r + 1] - starts[r]])) for r in rows])
    truth = label[rows]
    loss = lambda t: -np.log(softmax(logits / t)[np.arange(len(rows)), truth] + 1e-12).mean()
    model.temperature = float(min(np.geomspace(0.05, 20, 60), key=loss))
    scores = softmax(logits / model.temperature)
    right = scores.max(axis=1)[scores.argmax(axis=1) == truth]
    chance = 1 / len(model.languages)
    model.threshold = float(min(chance + CEILING * (1 - chance), 0.9 * np.quantile(right, 0.001))) if len(right) else 0.0


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo folds; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """All columns of docs with lang_pred, score and accepted.

    lang_pred is a learned language, or `und` (score 0, not accepted) if the text is null or has no letter; accepted is
    whether the score reaches the calibrated threshold. Whole texts are read, lang, source and doc_id are not. Repeated
    rows get equal answers, columns of docs with the three names are replaced, an empty table gives no rows. The model is
    a few megabytes whatever the corpus and goes to the tasks with the function.
    """
    return _identified(docs, model, "").drop("_letters")


def accepted(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of docs that identify() accepts, with just their own columns."""
    return _identified(docs, model, "_").where("_accepted").select(*docs.columns)


def _identified(docs: DataFrame, model: Model, prefix: str) -> DataFrame:
    rows = docs.withColumn("_letters", F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)))

    def compute(batch):
        data, starts = text_bytes(batch.column("text"))
        letters = batch.column("_letters").to_numpy(zero_copy_only=False)
        names, scores = [], []
        for first, last in groups(starts):
            a, b = starts[first], starts[last]
            p = model.probabilities(data[a:b], starts[first : last + 1] - a) if model.languages else np.zeros((last - first, 1))
            names += [model.languages[k] for k in p.argmax(axis=1)] if model.languages else [UNKNOWN] * (last - first)
            scores.append(p.max(axis=1))
        scores = np.where(letters, np.concatenate(scores), 0.0) if scores else np.zeros(0)
        names = [n if ok else UNKNOWN for n, ok in zip(names, letters)]
        accepted = letters & (scores >= model.threshold) & np.array([n != UNKNOWN for n in names], dtype=bool)
        return [pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(accepted, pa.bool_())]

    return appended(rows, compute, f"{prefix}lang_pred string, {prefix}score double, {prefix}accepted boolean")
