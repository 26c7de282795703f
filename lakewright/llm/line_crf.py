"""Quality rules from a line sequence labelling.

A linear-chain conditional random field gives every line of a text one of two
labels, content or boilerplate; Viterbi decoding finds the best sequence, and the
share of words on content lines decides whether the text stays. Weights are learned
from those texts marked good or bad that pass the base rules: every line of a good
text counts as content, none of a bad one.

Null and empty texts have no words, fail the base rules and are not kept; rows with
equal ids are treated one by one; other columns of the input are not looked at.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakewright.llm.words import U64, Hasher, column, mix, slices, text_bytes, windows

#: Labelled texts of either class that the weights are learned from, with all their lines.
TRAIN_TEXTS = 3000
#: A text stays if at least this share of its words stands on content lines.
CONTENT_SHARE = 0.5
FEATURES = (
    "bias", "log words", "upper case", "symbols", "exclamation marks", "digits", "word length",
    "letters", "ends as a sentence", "repeats a line", "repeated windows", "one word", "bars",
)
_SYMBOLS = b"#*$%&|<>"


def _classes() -> np.ndarray:
    """For each byte, the character classes it counts for."""
    table = np.zeros((7, 256), np.uint8)
    table[0, 65:91] = 1
    table[1, 65:91] = table[1, 97:123] = table[1, 0xC0:] = 1
    table[2, list(_SYMBOLS)] = 1
    table[3, ord("!")] = 1
    table[4, 48:58] = 1
    table[5, ord("|")] = 1
    table[6] = 1  # the first byte of any character that is not space
    table[6, 0x80:0xC0] = 0
    table[6, [9, 10, 11, 12, 13, 32]] = 0
    return table


def _sums(flags: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    total = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=total[1:])
    return total[high] - total[low]


def _seen_before(keys: np.ndarray) -> np.ndarray:
    """True where an equal key stands earlier."""
    order = np.argsort(keys, kind="stable")
    out = np.zeros(len(keys), bool)
    out[order[1:]] = keys[order[1:]] == keys[order[:-1]]
    return out


def _seen_twice(keys: np.ndarray) -> np.ndarray:
    """True where an equal key stands anywhere else."""
    order = np.argsort(keys, kind="stable")
    same = keys[order[1:]] == keys[order[:-1]]
    out = np.zeros(len(keys), bool)
    out[order[1:]] |= same
    out[order[:-1]] |= same
    return out


class Lines:
    """Lines of a batch of texts: where they are, what the base rules count, and their features."""

    def __init__(self, hasher: Hasher, texts: pa.Array) -> None:
        data, at = text_bytes(texts)
        n = len(texts)
        classes = _classes()
        self.texts = n
        word_start, word_end, first = hasher.spans(data, at)
        words = hasher.runs(data, word_start, word_end)
        self.n_words = np.diff(first)
        self.word_chars = _sums(classes[6][data], at[:-1], at[1:])
        self.n_symbols = _sums(classes[2][data], at[:-1], at[1:])

        breaks = np.flatnonzero(data == 10)
        doc_of_break = np.searchsorted(at, breaks, "right") - 1
        low = np.concatenate([at[:-1], breaks + 1])
        doc = np.concatenate([np.arange(n), doc_of_break])
        order = np.lexsort((low, doc))
        low, doc = low[order], doc[order]
        high = np.empty(len(low), np.int64)
        last = np.ones(len(low), bool)
        last[:-1] = doc[1:] != doc[:-1]
        high[~last] = low[1:][~last[:-1]] - 1 if len(low) else 0
        high[last] = at[doc[last] + 1]
        self.doc, self.low, self.high, self.data, self.at = doc, low, high, data, at
        self.first_line = np.searchsorted(doc, np.arange(n + 1))

        first_word, past_word = np.searchsorted(word_start, low), np.searchsorted(word_start, high)
        self.line_words = past_word - first_word
        filled = self.line_words > 0
        key = hasher.runs(data, low, high)
        salt = mix(doc.astype(U64) + U64(1))
        repeats = np.zeros(len(low), bool)
        repeats[filled] = _seen_before(mix(key[filled] ^ salt[filled]))
        self.n_dup_lines = np.bincount(doc[repeats], minlength=n)

        spans = windows(words, 5)
        doc_of_word = np.repeat(np.arange(n), self.n_words)
        covered = np.zeros(len(words) + 1, np.int64)
        if len(spans):
            inside = doc_of_word[:-4] == doc_of_word[4:]
            where = np.flatnonzero(inside)
            twice = where[_seen_twice(mix(spans[where] ^ mix(doc_of_word[where].astype(U64) + U64(1))))]
            covered[: len(words)] += np.bincount(twice, minlength=len(words))[: len(words)]
            covered -= np.bincount(twice + 5, minlength=len(words) + 1)
        covered = np.cumsum(covered[:-1]) > 0
        self.n_repeat_words = np.bincount(doc_of_word[covered], minlength=n)

        self.base_failed = (self.n_words < 10) | (100 * self.n_repeat_words > 20 * self.n_words)

        chars = np.maximum(_sums(classes[6][data], low, high), 1)
        letters = np.maximum(_sums(classes[1][data], low, high), 1)
        many = np.maximum(self.line_words, 1)
        tail = np.zeros(len(low), np.uint8)
        tail[filled] = data[word_end[past_word[filled] - 1] - 1]
        line_repeats = _sums(covered, first_word, past_word)
        self.features = np.stack(
            [
                np.ones(len(low)),
                np.log1p(self.line_words) / 4,
                _sums(classes[0][data], low, high) / letters,
                _sums(classes[2][data], low, high) / chars,
                np.minimum(1, 4 * _sums(classes[3][data], low, high) / chars),
                _sums(classes[4][data], low, high) / chars,
                np.minimum(chars / many, 20) / 10,
                np.minimum(letters / chars, 1),
                np.isin(tail, list(b".?")),
                repeats,
                line_repeats / many,
                self.line_words == 1,
                np.minimum(1, 2 * _sums(classes[5][data], low, high) / many),
            ],
            axis=1,
        ).astype(np.float64)


@dataclass(frozen=True)
class Chain:
    """Weights of the field: ``emit`` scores content, ``step[a, b]`` a line b after a line a, ``begin`` the first."""

    emit: np.ndarray
    step: np.ndarray
    begin: np.ndarray

    def viterbi(self, features: np.ndarray, first: np.ndarray) -> np.ndarray:
        """True for each line labelled content. All texts advance together, longest first."""
        score = features @ self.emit
        length = np.diff(first)
        order = np.argsort(-length, kind="stable")
        base, length = first[:-1][order], length[order]
        label = np.zeros(len(score), bool)
        if not len(score):
            return label
        steps = int(length[0])
        active = np.searchsorted(-length, -np.arange(steps), "left")  # texts with more than t lines
        back = np.zeros((len(score), 2), bool)
        best = np.zeros((len(base), 2))
        m = active[0]
        best[:m] = self.begin
        best[:m, 1] += score[base[:m]]
        for t in range(1, steps):
            m = active[t]
            through = best[:m, :, None] + self.step
            choice = through[:, 1] > through[:, 0]
            at = base[:m] + t
            back[at] = choice
            best[:m] = np.where(choice, through[:, 1], through[:, 0])
            best[:m, 1] += score[at]
        state = best[:, 1] > best[:, 0]
        for t in range(steps - 1, -1, -1):
            m = active[t]
            at = base[:m] + t
            label[at] = state[:m]
            state[:m] = back[at, state[:m].astype(int)]
        return label


def fit(features: np.ndarray, first: np.ndarray, good: np.ndarray, rounds: int = 150, decay: float = 1e-3) -> Chain:
    """Maximum likelihood by gradient ascent; expectations come from the forward-backward recursion."""
    length = np.diff(first)
    order = np.argsort(-length, kind="stable")
    base, length, good = first[:-1][order], length[order], good[order].astype(int)
    keep = length > 0
    base, length, good = base[keep], length[keep], good[keep]
    width = features.shape[1]
    theta = np.zeros(width + 6)
    if not len(base):
        return Chain(theta[:width], theta[width : width + 4].reshape(2, 2), theta[width + 4 :])
    # Either class weighs the same, and so does each text of a class, whatever its number of lines.
    texts_of = np.array([max(1, (good == k).sum()) for k in (0, 1)])
    weight = (1.0 / (2 * texts_of))[good] / length
    steps = int(length[0])
    active = np.searchsorted(-length, -np.arange(steps), "left")
    truth = np.zeros(width + 6)
    target = np.zeros(len(features))
    line_weight = np.zeros(len(features))
    for b, n, g, w in zip(base, length, good, weight, strict=True):
        target[b : b + n], line_weight[b : b + n] = g, w
        truth[width + 3 * g] += w * (n - 1)
        truth[width + 4 + g] += w
    truth[:width] = (features * (target * line_weight)[:, None]).sum(0)
    momentum, square = np.zeros_like(theta), np.zeros_like(theta)
    for r in range(1, rounds + 1):
        emit, step, begin = theta[:width], theta[width : width + 4].reshape(2, 2), theta[width + 4 :]
        score = np.zeros((len(features), 2))
        score[:, 1] = features @ emit
        ahead, rest = np.zeros((len(features), 2)), np.zeros((len(features), 2))
        ahead[base] = begin + score[base]
        for t in range(1, steps):
            at = base[: active[t]] + t
            ahead[at] = np.logaddexp(*(ahead[at - 1][:, a, None] + step[a] for a in (0, 1))) + score[at]
        total = np.zeros(len(features))
        expected = np.zeros_like(theta)
        for t in range(steps - 1, 0, -1):
            at = base[: active[t]] + t
            after = rest[at] + score[at]
            rest[at - 1] = np.logaddexp(step[:, 0] + after[:, :1], step[:, 1] + after[:, 1:])
        norm = np.logaddexp(*(ahead[base] + rest[base]).T)
        for t in range(steps):
            total[base[: active[t]] + t] = norm[: active[t]]
        chance = np.exp(ahead + rest - total[:, None])
        expected[:width] = (features * (chance[:, 1] * line_weight)[:, None]).sum(0)
        expected[width + 4 :] = (chance[base] * weight[:, None]).sum(0)
        inner = np.ones(len(features), bool)
        inner[base] = False
        at = np.flatnonzero(inner)
        pair = np.exp(ahead[at - 1][:, :, None] + step + (score[at] + rest[at])[:, None, :] - total[at][:, None, None])
        expected[width : width + 4] = (pair * line_weight[at][:, None, None]).sum(0).ravel()
        slope = truth - expected - decay * theta
        momentum = 0.9 * momentum + 0.1 * slope
        square = 0.99 * square + 0.01 * slope**2
        theta = theta + 0.3 * (momentum / (1 - 0.9**r)) / (np.sqrt(square / (1 - 0.99**r)) + 1e-8)
    return Chain(theta[:width], theta[width : width + 4].reshape(2, 2), theta[width + 4 :])


def sample_of(docs: DataFrame, labels: DataFrame, label: str, each: int) -> DataFrame:
    """At most ``each`` labelled ids of either class, chosen by hash, with their texts: doc_id, text, label.

    An id labelled more than once counts as its largest label; null ids and labels are left out.
    """
    known = (
        labels.select("doc_id", F.col(label).cast("int").alias("label"))
        .dropna()
        .groupBy("doc_id")
        .agg((F.max("label") > 0).cast("int").alias("label"))
        .withColumn("turn", F.xxhash64("doc_id"))
    )
    chosen = [known.where(f"label = {k}").orderBy("turn", "doc_id").limit(each) for k in (0, 1)]
    ids = chosen[0].unionByName(chosen[1]).drop("turn")
    return docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id")  # 2 * each ids at most


def learn(docs: DataFrame, labels: DataFrame, each: int = TRAIN_TEXTS) -> Chain:
    """Weights from all lines of at most ``each`` good and bad texts."""

    def measured(batches):
        hasher = Hasher()
        for batch in slices(batches, "text"):
            found = Lines(hasher, column(batch, "text"))
            passed = pa.array(~found.base_failed)
            rows = [found.features[a:b].tobytes() for a, b in zip(found.first_line, found.first_line[1:], strict=False)]
            yield pa.record_batch([pa.array(rows, pa.binary()), column(batch, "label").cast(pa.int32()), column(batch, "turn")], ["f", "label", "turn"]).filter(passed)

    sample = sample_of(docs, labels, "quality", each).withColumn("turn", F.xxhash64("doc_id", "text"))
    rows = sample.mapInArrow(measured, "f binary, label int, turn long").collect()
    rows.sort(key=lambda r: (r.turn, r.label, len(r.f)))
    width = len(FEATURES)
    parts = [np.frombuffer(r.f, np.float64).reshape(-1, width) for r in rows]
    first = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)
    return fit(np.concatenate([*parts, np.zeros((0, width))]), first, np.array([r.label for r in rows], int))


def judge_texts(docs: DataFrame, chain: Chain, share: float = CONTENT_SHARE) -> DataFrame:
    """One row per text: what the base rules count, the share of words on content lines, and the verdict."""

    def judged(batches):
        hasher = Hasher()
        for batch in slices(batches, "text"):
            found = Lines(hasher, column(batch, "text"))
            content = chain.viterbi(found.features, found.first_line)
            kept_words = np.bincount(found.doc, weights=found.line_words * content, minlength=found.texts)
            part = kept_words / np.maximum(found.n_words, 1)
            yield pa.record_batch(
                [
                    column(batch, "doc_id"),
                    *(pa.array(x.astype(np.int64)) for x in (found.n_words, found.word_chars, found.n_symbols, found.n_dup_lines, found.n_repeat_words)),
                    pa.array(found.base_failed),
                    pa.array(~found.base_failed & (part >= share)),
                    pa.array(part),
                ],
                ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "content_share"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        judged,
        f"doc_id {kind}, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, content_share double",
    )


def label_lines(docs: DataFrame, chain: Chain) -> DataFrame:
    """One row per line: doc_id, line (from 0), text and whether it is content."""

    def labelled(batches):
        hasher = Hasher()
        for batch in slices(batches, "text"):
            found = Lines(hasher, column(batch, "text"))
            content = chain.viterbi(found.features, found.first_line)
            texts = [found.data[a:b].tobytes().decode() for a, b in zip(found.low, found.high, strict=True)]
            number = np.arange(len(found.doc)) - found.first_line[found.doc]
            yield pa.record_batch([column(batch, "doc_id").take(pa.array(found.doc)), pa.array(number), pa.array(texts, pa.string()), pa.array(content)], ["doc_id", "line", "text", "content"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(labelled, f"doc_id {kind}, line long, text string, content boolean")
