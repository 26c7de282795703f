"""Toxicity by multiple-instance learning.

A text is a bag of sentences. Each sentence gets a probability from the words in it,
and the text's score is their noisy-or: one minus the chance that no sentence
offends. The weights come from labels of whole texts; afterwards the sentence
probabilities tell where the offence is.

A word counts by itself and by its beginnings of 4, 5 and 6 bytes, in lower case and
without closing punctuation; words of toxic texts and of clean ones both have weights. What the
words of a sentence add to the bias, if that is above 0, is the rate at which it offends (bent
to meet 0 smoothly), and its probability is one minus the exponent of the negative rate. The bias is below
0 and the weight of a clean word never above it, so sentences without a toxic word, and those whose
clean words outweigh it, count exactly 0 and no text offends by its length. Each text with words has one leak
besides, a rate that grows with the suspicion of its sentences below 0 and never adds more than ``UNSHOWN`` however many they
are, so that texts without an offending sentence are ranked too. The fit maximises the very formula that scores. A sentence ends at ``.``, ``?`` or ``!`` at the end of a
word, or at a line break. Null and empty texts have no sentence and score 0, and so does every text
if no label is toxic or the labels are empty; an empty table gives an empty result. Rows
with equal ids are scored one by one, ids may be of any type; a null id counts as the empty text for its fold. Of
other columns none is looked at; :func:`keep_clean` carries them.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakewright.llm.line_crf import sample_of
from lakewright.llm.words import U64, Hasher, column, mix, slices, text_bytes

#: Labelled texts of either class that the model is fitted on.
TRAIN_TEXTS = 4000
#: Words and beginnings of either kind, toxic and clean, that may carry a weight, and the texts that must hold one.
FEATURES = 50_000
LEAST_TEXTS = 3
BEGINNINGS = (4, 5, 6)
#: Bytes of text that a task takes apart at a time: its arrays hold some forty times as much.
SLICE = 1 << 20
#: Largest slope, as a share of the weight of all texts, at which the fit has settled, and most rounds; its steps shrink.
SETTLED = 1e-5
ROUNDS = 4000
#: Weight of the prior, as a share of the weight of all texts.
PRIOR = 1e-4
#: Score of a sentence without known words, which others must make up for.
BIAS = -1.0
#: Sentences of score 0 that make half of the largest leak.
HALF = 20.0
#: Most that the leak of a text adds to its score.
UNSHOWN = 0.25


def fold(ids: Column, folds: int = 5) -> Column:
    """crc32 of the id's text, modulo ``folds``; a null id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(ids.cast("string"), F.lit("")).cast("binary")), F.lit(folds)).cast("int")


class Sentences:
    """Words of a batch of texts as features, with their sentences."""

    def __init__(self, hasher: Hasher, texts: pa.Array) -> None:
        data, at = text_bytes(texts)
        data = hasher.lower[data]
        start, end, first = hasher.spans(data, at)
        self.start, self.end = start, end
        n = len(start)
        last = data[end - 1] if n else np.empty(0, np.uint8)
        stop = np.isin(last, list(b".?!"))
        breaks = np.zeros(len(data) + 1, np.int64)
        np.cumsum(data == 10, out=breaks[1:])
        begins = np.ones(n, bool)
        if n:
            begins[1:] = stop[:-1] | (breaks[start[1:]] > breaks[end[:-1]])
        begins[first[:-1][first[:-1] < n]] = True
        self.sentence = np.cumsum(begins) - 1
        self.n_sentences = int(self.sentence[-1]) + 1 if n else 0
        first_word = np.flatnonzero(begins)
        self.first_word = np.append(first_word, n)
        self.first_sentence = np.searchsorted(first_word, first)  # of each text, with the end
        trimmed = end.copy()
        for _ in range(3):
            shorter = (trimmed - start > 1) & np.isin(data[trimmed - 1], list(b".,;:?!")) if n else np.zeros(0, bool)
            trimmed = trimmed - shorter
        self.feature = [hasher.runs(data, start, trimmed)]
        self.word = [np.arange(n)]
        for size in BEGINNINGS:
            long = np.flatnonzero(trimmed - start > size)
            self.feature.append(mix(hasher.runs(data, start[long], start[long] + size) + U64(size)))
            self.word.append(long)


def rate(score: np.ndarray) -> np.ndarray:
    """The score of a sentence above 0, less one half from 1 on and bent below, so that its slope has no step."""
    return np.clip(score, 0, 1) ** 2 / 2 + np.maximum(score - 1, 0)


def suspicion(score: np.ndarray) -> np.ndarray:
    """What a sentence adds to the doubt about a text: 1 from a score of 0 on, never less than one without known words."""
    return np.exp(np.clip(score, BIAS, 0))


@dataclass(frozen=True)
class Model:
    """Weight of each feature, in order of features, the bias of a sentence, and the largest leak of a text as a probability."""

    features: np.ndarray
    weights: np.ndarray
    bias: float
    unshown: float = 0.0

    def found(self, texts: Sentences):
        """Sentence and weight index of each known feature that occurs."""
        near = np.zeros(1 << 20, bool)
        near[self.features >> U64(44)] = True
        for feature, word in zip(texts.feature, texts.word, strict=True):
            hit = np.flatnonzero(near[feature >> U64(44)])
            where = np.searchsorted(self.features, feature[hit])
            where[where == len(self.features)] = 0
            same = self.features[where] == feature[hit] if len(self.features) else np.zeros(0, bool)
            yield texts.sentence[word[hit[same]]], where[same]

    def scores(self, texts: Sentences) -> np.ndarray:
        """Bias and weights of each sentence."""
        score = np.full(texts.n_sentences, self.bias)
        for sentence, where in self.found(texts):
            score += np.bincount(sentence, weights=self.weights[where], minlength=texts.n_sentences)
        return score

    def sentences(self, texts: Sentences) -> np.ndarray:
        """Probability of each sentence."""
        return -np.expm1(-rate(self.scores(texts)))

    def texts(self, texts: Sentences) -> np.ndarray:
        """Noisy-or of the sentences of each text and its leak."""
        score, first = self.scores(texts), texts.first_sentence
        total, doubt = (np.concatenate([[0], np.cumsum(x)]) for x in (rate(score), suspicion(score)))
        rates, doubt = (np.maximum(x[first[1:]] - x[first[:-1]], 0) for x in (total, doubt))
        return -np.expm1(np.log1p(-self.unshown) * doubt / (doubt + HALF) - rates)


def fit(sentence: np.ndarray, feature: np.ndarray, text: np.ndarray, label: np.ndarray, weight: np.ndarray, plain: np.ndarray, start: np.ndarray, rounds: int = ROUNDS) -> tuple[np.ndarray, float]:
    """Weights and largest leak of the greatest likelihood of the text labels, by Adam until the gradient settles.

    ``start`` breaks the symmetry; where it is negative the weight stays at most 0. ``text`` is that of each sentence;
    of sentences without a feature that starts above 0 only the number in each text, ``plain``, matters.
    """
    width, n, all_weight = len(start), len(text), weight.sum()
    most_leak = np.log(-np.log1p(-UNSHOWN))
    centre = np.append(np.zeros(width), most_leak - 2)
    theta = np.append(start, centre[-1])
    ceiling = np.append(np.where(start < 0, 0.0, np.inf), most_leak)
    momentum, square = np.zeros(width + 1), np.zeros(width + 1)
    plain = plain * np.exp(BIAS)
    for r in range(1, rounds + 1):
        score = BIAS + np.bincount(sentence, weights=theta[feature], minlength=n)
        each = suspicion(score)
        doubt = plain + np.bincount(text, weights=each, minlength=len(label))
        leak = np.exp(theta[-1]) * doubt / (doubt + HALF)
        quiet = np.exp(-leak - np.bincount(text, weights=rate(score), minlength=len(label)))
        pull = np.where(label == 1, quiet / np.maximum(1 - quiet, 1e-9), -1.0) * weight
        growth = (np.exp(theta[-1]) * HALF / (doubt + HALF) ** 2)[text] * each
        up = pull[text] * (np.clip(score, 0, 1) + np.where((score > BIAS) & (score < 0), growth, 0))
        slope = np.append(np.bincount(feature, weights=up[sentence], minlength=width), (pull * leak).sum())
        slope -= PRIOR * all_weight * (theta - centre)
        stuck = (theta >= ceiling) & (slope > 0)
        if np.abs(np.where(stuck, 0, slope)).max() <= SETTLED * all_weight:
            break
        momentum = 0.9 * momentum + 0.1 * slope
        square = 0.99 * square + 0.01 * slope**2
        step = 0.05 / (1 + r / 200)
        theta = np.minimum(theta + step * (momentum / (1 - 0.9**r)) / (np.sqrt(square / (1 - 0.99**r)) + 1e-9), ceiling)
    return theta[:width], float(-np.expm1(-np.exp(theta[-1])))


def learn(docs: DataFrame, labels: DataFrame, each: int = TRAIN_TEXTS, width: int = FEATURES) -> Model:
    """A model from at most ``each`` toxic and other texts outside fold 0; nothing but texts and labels is used."""
    labels = labels.where(fold(F.col("doc_id")) != 0)
    sample = sample_of(docs, labels, "toxic", each)

    def words_of(batches):
        hasher = Hasher()
        for batch in slices(batches, "text", SLICE):
            texts, label = Sentences(hasher, column(batch, "text")), column(batch, "label").to_numpy()
            owner = np.searchsorted(texts.first_sentence, texts.sentence, "right") - 1
            seen = np.unique(np.concatenate([f ^ mix(owner[w].astype(U64)) for f, w in zip(texts.feature, texts.word, strict=True)]), return_index=True)[1]
            feature = np.concatenate(texts.feature)[seen]
            toxic = label[np.concatenate([owner[w] for w in texts.word])[seen]]
            each_of, where = np.unique(feature, return_inverse=True)
            yield pa.record_batch([pa.array(each_of.view(np.int64)), *(pa.array(np.bincount(where[toxic == k], minlength=len(each_of)).astype(np.int64)) for k in (0, 1))], ["feature", "clean", "toxic"])

    seen = sample.mapInArrow(words_of, "feature long, clean long, toxic long").groupBy("feature").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    odds = F.log((F.col("toxic") + 0.5) / (F.col("clean") + 0.5))
    held = seen.where(F.col("toxic") + F.col("clean") >= LEAST_TEXTS).withColumn("odds", odds)
    # The sample is bounded, and so are the features of either kind. One query counts for both and brings them as columns, not rows.
    toxic, clean = (held.where(kind).orderBy(F.desc(F.abs("odds")), "feature").limit(width).select("feature", "odds") for kind in ("odds > 1", "odds < -1"))
    told = toxic.unionByName(clean).toArrow()
    features, odds = column(told, "feature").to_numpy().view(U64), column(told, "odds").to_numpy()
    order = np.argsort(features)
    features, start = features[order], odds[order] / 2
    blank = Model(features, np.zeros(len(features)), BIAS)

    def bags(batches):
        hasher = Hasher()
        for batch in slices(batches, "text", SLICE):
            texts = Sentences(hasher, column(batch, "text"))
            pairs = list(blank.found(texts))
            sentence, where = (np.concatenate([p[k] for p in pairs]) for k in (0, 1))
            loud = np.zeros(texts.n_sentences, bool)
            loud[sentence[start[where] > 0]] = True
            sentence, where = sentence[loud[sentence]], where[loud[sentence]]
            order = np.lexsort((where, sentence))
            sentence, where = sentence[order], where[order]
            cut = np.searchsorted(sentence, texts.first_sentence)
            local = sentence - np.repeat(texts.first_sentence[:-1], np.diff(cut))
            take = lambda x: pa.array([x[a:b].astype(np.int32).tobytes() for a, b in zip(cut, cut[1:], strict=False)], pa.binary())
            yield pa.record_batch([column(batch, "turn"), column(batch, "label").cast(pa.int32()), pa.array(np.diff(texts.first_sentence)), take(local), take(where)], ["turn", "label", "n", "sentence", "feature"])

    turned = sample.withColumn("turn", F.xxhash64("doc_id", "text"))
    found = turned.mapInArrow(bags, "turn long, label int, n long, sentence binary, feature binary").where("n > 0").collect()
    found.sort(key=lambda r: (r.turn, r.label, bytes(r.feature)))
    label = np.array([r.label for r in found], int)
    if not (label == 1).any():
        return Model(np.empty(0, U64), np.empty(0), BIAS)
    feature = [np.frombuffer(r.feature, np.int32) for r in found]
    owner = np.repeat(np.arange(len(found)), [len(x) for x in feature])
    place = np.concatenate([np.frombuffer(r.sentence, np.int32) for r in found])
    where, sentence = np.unique(owner << 32 | place, return_inverse=True)
    # The sample is even; the weight of the other texts restores their share among all labelled ones.
    share = labels.dropna(subset=["doc_id", "toxic"]).agg(F.sum((F.col("toxic") > 0).cast("int")).alias("bad"), F.count("*").alias("all")).first()
    ratio = ((share["all"] - (share.bad or 0)) / max(1, (label == 0).sum())) / (max(1, share.bad or 0) / max(1, (label == 1).sum()))
    plain = np.array([r.n for r in found]) - np.bincount(where >> 32, minlength=len(found))
    weights, leak = fit(sentence, np.concatenate(feature), where >> 32, label, np.where(label == 1, 1.0, ratio), plain, start)
    return Model(features, weights, BIAS, leak)


def _scored(model: Model, batches):
    hasher = Hasher()
    for batch in slices(batches, "text", SLICE):
        yield batch, model.texts(Sentences(hasher, column(batch, "text")))


def score_texts(docs: DataFrame, model: Model) -> DataFrame:
    """One row per text: doc_id, held_out (fold 0), score and predicted."""

    def scored(batches):
        for batch, score in _scored(model, batches):
            yield pa.record_batch([column(batch, "doc_id"), column(batch, "held_out"), pa.array(score), pa.array((score >= 0.5).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text", (fold(F.col("doc_id")) == 0).alias("held_out")).mapInArrow(scored, f"doc_id {kind}, held_out boolean, score double, predicted int")


def keep_clean(docs: DataFrame, model: Model, limit: float = 0.5) -> DataFrame:
    """The rows of ``docs``, all columns, that score below ``limit``."""

    def kept(batches):
        for batch, score in _scored(model, batches):
            yield batch.filter(pa.array(score < limit))

    return docs.mapInArrow(kept, docs.schema)


def offending(docs: DataFrame, model: Model, limit: float = 0.5) -> DataFrame:
    """The sentences that score ``limit`` or more: doc_id, sentence (from 0 in its text), text and score."""

    def located(batches):
        hasher = Hasher()
        for batch in slices(batches, "text", SLICE):
            data, _ = text_bytes(column(batch, "text"))
            texts = Sentences(hasher, column(batch, "text"))
            score = model.sentences(texts)
            hit = np.flatnonzero(score >= limit)
            owner = np.searchsorted(texts.first_sentence, hit, "right") - 1
            low, high = texts.start[texts.first_word[hit]], texts.end[texts.first_word[hit + 1] - 1]
            said = [data[a:b].tobytes().decode() for a, b in zip(low, high, strict=True)]
            yield pa.record_batch([column(batch, "doc_id").take(pa.array(owner)), pa.array(hit - texts.first_sentence[owner]), pa.array(said, pa.string()), pa.array(score[hit])], ["doc_id", "sentence", "text", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(located, f"doc_id {kind}, sentence long, text string, score double")
