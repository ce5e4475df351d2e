"""Toxicity by multiple-instance learning.

A document is a bag of sentences. Each sentence has a probability from a logistic
model over its words and their beginnings, and the document's is their noisy-or, one minus the product of
the complements. Only documents have labels; the gradient of the document's
likelihood gives each sentence its share, so the model learns which sentences made
a document toxic, and names them. Scores count what a sentence holds beyond one without
any evidence: a sentence that speaks for nothing adds nothing, however many there are.
"""

import math
import re
from array import array
from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skylag.llm.common import give_back, slices
from skylag.llm.decontam import FOLD

# Bounds of the sample that the model is fitted on: documents, and their mean characters.
FIT_DOCUMENTS = 6000
FIT_CHARS = 4000
# Fewest documents of the sample that hold a feature of the model.
MIN_DOCUMENTS = 5
ROUNDS = 300
# Words whose weight a worker keeps.
KEPT_WORDS = 400_000
L1 = 2e-4
SENTENCE = re.compile(r"[^.!?\n]+")

SCORE_SCHEMA = (
    "doc_id long, score double, predicted int, "
    "sentences array<struct<start:int,length:int,score:double>>"
)


def sentences(text: str) -> list[tuple[int, int, set[bytes]]]:
    """Start, length and distinct words of each sentence that has words."""
    found = []
    for m in SENTENCE.finditer(text):
        words = set(m.group().encode().translate(FOLD).split())
        if words:
            found.append((m.start(), m.end() - m.start(), words))
    return found


def features(word: bytes) -> list[str]:
    """The word, and its beginnings of 3 to 8 characters."""
    text = word.decode()
    return [f"^{text}$", *(f"^{text[:k]}" for k in range(3, min(len(text), 8) + 1))]


def fit(texts: Iterable[str], labels: list[int], rounds: int = ROUNDS, l1: float = L1) -> tuple[float, dict[str, float]]:
    """Bias and weights of the features, by proximal gradient steps on the bags' likelihood.

    A sentence's logit is the bias and the weights of its distinct words; a word's weight
    is that of its features. Texts are turned into numbers of words one by one, and
    features known by their hash until those of enough documents are found.
    """
    import numpy as np

    number: dict[bytes, int] = {}
    word, sentence, owner = array("i"), array("i"), array("i")
    for d, text in enumerate(texts):
        for _, _, words in sentences(text):
            word.extend(number.setdefault(w, len(number)) for w in sorted(words))
            sentence.extend([len(owner)] * len(words))
            owner.append(d)
    word, sentence, owner = (np.frombuffer(x, dtype=np.int32) if len(x) else np.zeros(0, dtype=np.int32) for x in (word, sentence, owner))
    hashed, of_word = array("q"), array("i")
    for w, k in number.items():
        own = features(w)
        hashed.extend(map(hash, own))
        of_word.extend([k] * len(own))
    hashes, feature = np.unique(np.array(hashed, dtype=np.int64), return_inverse=True)
    of_word = np.array(of_word, dtype=np.int32)
    # Only features of enough documents are learned.
    pairs = np.unique(owner[sentence].astype(np.int64) * len(number) + word)
    in_docs = np.bincount(pairs % max(len(number), 1), minlength=len(number))
    enough = np.bincount(feature, in_docs[of_word], len(hashes)) >= MIN_DOCUMENTS
    del pairs
    of_word, feature = of_word[enough[feature]], feature[enough[feature]]
    place = {h: k for k, h in enumerate(hashes.tolist()) if enough[k]}
    names = {place[h]: f for w in number for f in features(w) if (h := hash(f)) in place}
    y = np.array(labels, dtype=np.float64)
    n, m, size = len(y), len(owner), len(hashes)
    weight, bias = np.zeros(size), -5.0
    scale, scale_b = np.full(size, 1e-8), 1e-8
    for _ in range(rounds if m else 0):
        of_words = np.bincount(of_word, weight[feature], len(number))
        logit = bias + np.bincount(sentence, of_words[word], m)
        none = np.bincount(owner, np.logaddexp(0, logit), n)  # minus the log of "no sentence is toxic"
        p = np.clip(-np.expm1(-none), 1e-9, 1)
        share = np.where(y > 0, (1 - p) / p, -1.0) / n
        slope = share[owner] / (1 + np.exp(-logit))
        grad = np.bincount(feature, np.bincount(word, slope[sentence], len(number))[of_word], size)
        scale += grad * grad
        step = 0.5 / np.sqrt(scale)
        weight = weight + step * grad
        weight = np.sign(weight) * np.maximum(np.abs(weight) - step * l1, 0)
        scale_b += slope.sum() ** 2
        bias += 0.2 * slope.sum() / math.sqrt(scale_b)
    return float(bias), {names[k]: float(weight[k]) for k in np.flatnonzero(weight).tolist()}


class Scorer:
    """A fitted model, with the weights of the words seen so far."""

    def __init__(self, bias: float, weights: dict[str, float]):
        self.bias, self.weights, self.known = bias, weights, {}
        self.plain = math.log1p(math.exp(bias))

    def score(self, text: str | None) -> tuple[float, list[dict]]:
        """Noisy-or over the sentences of a text, each beyond a plain one, and its offending sentences."""
        known, none, bad = self.known, 0.0, []
        for start, length, words in sentences(text or ""):
            logit = self.bias
            for word in sorted(words):
                value = known.get(word)
                if value is None:
                    if len(known) > KEPT_WORDS:
                        known.clear()
                    value = known[word] = math.fsum(self.weights.get(f, 0.0) for f in features(word))
                if value:
                    logit += value
            if logit <= self.bias:
                continue
            none += max(logit, 0.0) + math.log1p(math.exp(-abs(logit))) - self.plain
            if logit >= 0:
                bad.append({"start": start, "length": length, "score": 1 / (1 + math.exp(-logit))})
        return -math.expm1(-none), bad


def held_out(doc_id: str = "doc_id"):
    """Whether a document is never learned from; a null id is not either."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(True))


def fit_sample(
    documents: DataFrame, labels: DataFrame, fit_documents: int = FIT_DOCUMENTS, fit_chars: int = FIT_CHARS
) -> tuple[float, dict[str, float]]:
    """Fit on a bounded sample: the labelled ids with the smallest hashes.

    Repeated labels of an id count as toxic if one does; null labels and null texts are
    left out. The sample has at most ``fit_documents`` times ``fit_chars`` characters; only
    if it has more are its longest texts not learned from.
    The labels, not the documents, are sampled, and they are few enough to broadcast.
    """
    ids = (
        labels.where("toxic IS NOT NULL AND doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("label_id"))
        .agg(F.max(F.col("toxic").cast("int")).alias("label")).where(~held_out("label_id"))
        .orderBy(F.xxhash64("label_id"), "label_id").limit(fit_documents)
    )
    rows = documents.select("doc_id", "text").join(F.broadcast(ids), F.col("doc_id") == F.col("label_id"))
    # Lengths come first, so that no text beyond the bound is read into the driver.
    sizes = rows.groupBy(F.char_length("text").alias("n")).agg(F.count("*").alias("rows")).orderBy("n")
    room, longest = fit_documents * fit_chars, -1
    for n, count in sizes.where("n IS NOT NULL").toLocalIterator():
        room -= n * count
        if room < 0:
            break
        longest = n
    rows = rows.where(F.char_length("text") <= longest).orderBy("doc_id", "text").limit(fit_documents)
    # As Arrow, so that only one text at a time is a Python string.
    sample = rows.select("text", "label").toArrow()
    model = fit((t.as_py() for t in sample.column(0)), sample.column(1).to_pylist())
    # The driver needs the sample and the numbers of its words no more.
    del sample
    give_back()
    return model


def score_documents(documents: DataFrame, model: tuple[float, dict[str, float]]) -> DataFrame:
    """Score every whole text: ``doc_id, score, predicted, sentences``.

    ``sentences`` are the offending ones, of probability at least one half, by place in
    characters. A null or empty text has no sentences and scores 0.
    """
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        import pyarrow as pa

        scorer = Scorer(*shared.value)
        for batch in batches:
            texts = batch.column(1)
            made = [scorer.score(texts[k].as_py()) for k in range(batch.num_rows)]
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array([s for s, _ in made], pa.float64()),
                pa.array([int(s >= 0.5) for s, _ in made], pa.int32()),
                pa.array([b for _, b in made], pa.list_(pa.struct(
                    [("start", pa.int32()), ("length", pa.int32()), ("score", pa.float64())]))),
            ], ["doc_id", "score", "predicted", "sentences"])

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, SCORE_SCHEMA)


def toxicity(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Fit on the labelled documents that are not held out, score all."""
    return score_documents(documents, fit_sample(documents, labels))


def drop_toxic(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that score below one half, with all their columns.

    Each row is judged by its own text in one pass, so repeated or null ids do no harm.
    """
    shared = documents.sparkSession.sparkContext.broadcast(fit_sample(documents, labels))
    at = documents.columns.index("text")

    def run(batches):
        import pyarrow as pa

        scorer = Scorer(*shared.value)
        for batch in slices(batches):
            texts = batch.column(at)
            keep = [scorer.score(texts[k].as_py())[0] < 0.5 for k in range(batch.num_rows)]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return documents.mapInArrow(run, documents.schema)
