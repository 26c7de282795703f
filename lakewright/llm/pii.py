"""Personal data by patterns and a skip-chain conditional random field.

Patterns find e-mail addresses, IP addresses, card numbers and phone numbers, each
from the left without overlaps; a match that fails its check is dropped and not tried
again. That loses data, for instance a card number right after a phone number. The
field labels every word with a digit or ``@``. Neighbouring words share a potential,
and so do distant ones with the same content, or with the same beginning or domain;
loopy message passing makes their labels agree across the text. What it labels beyond
the patterns becomes further spans.

The weights maximise the pseudo-likelihood of the patterns' own labels on a bounded
sample of texts. Repeated words are linked to their last occurrence only, so there are
never more links than words.

A null text is empty and has no spans. Rows with equal ids are searched one by one;
other columns are not looked at. Places count code points, the end excluded.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakewright.llm.words import column, slices, text_bytes

KINDS = ("email", "ip", "card", "phone")
#: About as many texts are looked at for learning; those with a digit or an at sign count, equal texts once.
SAMPLE_TEXTS = 30_000
ROUNDS = 8

_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_MARK = re.compile(r"[0-9@]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_QUAD = re.compile(r"[0-9]{1,3}(\.[0-9]{1,3}){3}")
_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_EDGE = ".,;:!?\"'<>[]{}"
_NOT_DIGIT = re.compile(r"[^0-9]+")


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2])) + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return total % 10 == 0


def _emails(text: str):
    """Matches of the address pattern, in time linear in the text: from each at sign to both sides."""
    at, low = text.find("@"), 0
    while at >= 0:
        start = low + len(text[low:at].rstrip(_LOCAL))
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            yield start, found.end()
            low = found.end()
        else:
            low = at + 1
        at = text.find("@", low)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """start, kind and end of what the patterns find, in order."""
    out = [(a, 0, b) for a, b in _emails(text)]
    if not _MARK.search(text):
        return out
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m[0].split(".")):
            out.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        digits = _NOT_DIGIT.sub("", m[0])
        if 12 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), 2, m.end()))
    for m in _PHONE.finditer(text):
        if 9 <= len(_NOT_DIGIT.sub("", m[0])) <= 15:
            out.append((m.start(), 3, m.end()))
    return sorted(out)


def _shape(word: str) -> list[float]:
    """What a word looks like by itself."""
    digits = _NOT_DIGIT.sub("", word)
    n = len(digits)
    local, at, domain = word.partition("@")
    plain = word.replace("-", "")
    return [
        1.0,
        bool(local and at and _DOMAIN.fullmatch(domain)),
        n == 0, 1 <= n <= 3, 4 <= n <= 8, 9 <= n <= 11, 12 <= n <= 19, n > 19,
        12 <= n <= 19 and plain.isdecimal() and luhn(digits),
        bool(_QUAD.fullmatch(word)) and all(int(p) <= 255 for p in word.split(".")),
        word[:1] == "+",
        word[:1] == "(" and word[-1:] == ")",
        "-" in word and plain.isdecimal(),
        plain.isdecimal(),
        any(c.isalpha() for c in word),
        "." in word,
        any(c in "=/_#*$%&|" for c in word),
    ]


WIDTH = 3 * 17


class Graph:
    """Words that may be personal data of many texts, with their features and the links between them."""

    def __init__(self, texts: list[str]) -> None:
        self.place: list[tuple[int, int, int]] = []  # text, start, end
        shapes, beside, same, alike = [], [], [], []
        for t, text in enumerate(texts):
            before = None  # the last such word, if it is the neighbour
            last: dict[tuple, int] = {}
            number = -2
            for k, m in enumerate(_WORD.finditer(text)):
                if not _MARK.search(m[0]):
                    continue
                core = m[0].strip(_EDGE)
                if not core:
                    continue
                start = m.start() + m[0].index(core)
                node = len(self.place)
                self.place.append((t, start, start + len(core)))
                shapes.append(_shape(core))
                if before is not None and number == k - 1:
                    beside.append((before, node))
                before, number = node, k
                digits = _NOT_DIGIT.sub("", core)
                keys = [(same, ("=", digits if len(digits) >= 7 and "@" not in core else core.lower()))]
                if "@" in core:
                    keys.append((alike, ("@", core.rpartition("@")[2].lower())))
                elif len(digits) >= 9:
                    keys.append((alike, ("#", len(digits), digits[:6])))
                for links, key in keys:
                    if key in last:
                        links.append((last[key], node))
                    last[key] = node
        n = len(self.place)
        own = np.array(shapes, float).reshape(n, WIDTH // 3)
        left, right = np.zeros_like(own), np.zeros_like(own)
        pairs = [np.array(x, np.int64).reshape(-1, 2) for x in (beside, same, alike)]
        left[pairs[0][:, 1]], right[pairs[0][:, 0]] = own[pairs[0][:, 0]], own[pairs[0][:, 1]]
        self.features = np.concatenate([own, left, right], axis=1)
        self.links = np.concatenate(pairs)
        self.kind = np.repeat([0, 1, 2], [len(p) for p in pairs])

    def labels(self, spans: list[list[tuple[int, int, int]]]) -> np.ndarray:
        """For every word the kind, from 1, of the pattern's span it lies in, else 0."""
        out = np.zeros(len(self.place), int)
        for i, (t, start, end) in enumerate(self.place):
            for a, kind, b in spans[t]:
                if a < end and start < b:
                    out[i] = kind + 1
        return out


@dataclass(frozen=True)
class Field:
    """Potentials: of a word, of neighbours, and of equal labels on words with the same or like content."""

    node: np.ndarray
    beside: np.ndarray
    agree: np.ndarray

    def _pair(self, kind: np.ndarray) -> np.ndarray:
        out = np.where((kind == 0)[:, None, None], self.beside, 0.0)
        return out + np.where(kind == 1, self.agree[0], np.where(kind == 2, self.agree[1], 0.0))[:, None, None] * np.eye(len(KINDS) + 1)

    def decode(self, graph: Graph, rounds: int = ROUNDS) -> np.ndarray:
        """The likeliest label of each word after ``rounds`` of loopy sum-product messages."""
        node = graph.features @ self.node
        if not len(node):
            return np.zeros(0, int)
        pair = self._pair(graph.kind)
        one, two = np.concatenate([graph.links, graph.links[:, ::-1]]).T  # a message goes from one to two
        pair = np.concatenate([pair, pair.transpose(0, 2, 1)])
        reverse = np.roll(np.arange(len(one)), len(graph.links))
        message = np.zeros((len(one), node.shape[1]))
        belief = node
        for _ in range(rounds):
            cavity = belief[one] - message[reverse]
            new = np.logaddexp.reduce(cavity[:, :, None] + pair, axis=1) if len(one) else message
            new -= new.max(axis=1, keepdims=True) if len(one) else 0
            message = (message + new) / 2
            belief = node.copy()
            np.add.at(belief, two, message)
        return belief.argmax(axis=1)


def fit(features: np.ndarray, links: np.ndarray, kind: np.ndarray, label: np.ndarray, rounds: int = 300, decay: float = 1e-4) -> Field:
    """Maximum pseudo-likelihood: every label given those of the linked words."""
    many, n = len(KINDS) + 1, len(label)
    theta = np.zeros(features.shape[1] * many + many * many + 2)
    if not n:
        return Field(theta[: features.shape[1] * many].reshape(-1, many), np.zeros((many, many)), np.zeros(2))
    cut = features.shape[1] * many
    hot = np.eye(many)[label]
    near = links[kind == 0]
    votes = [np.zeros((n, many)), np.zeros((n, many))]
    for k in (0, 1):
        for a, b in ((0, 1), (1, 0)):
            np.add.at(votes[k], links[kind == k + 1][:, a], hot[links[kind == k + 1][:, b]])
    momentum, square = np.zeros_like(theta), np.zeros_like(theta)
    for r in range(1, rounds + 1):
        node, beside, agree = theta[:cut].reshape(-1, many), theta[cut:-2].reshape(many, many), theta[-2:]
        score = features @ node + agree[0] * votes[0] + agree[1] * votes[1]
        np.add.at(score, near[:, 1], beside[label[near[:, 0]]])
        np.add.at(score, near[:, 0], beside[:, label[near[:, 1]]].T)
        score -= score.max(axis=1, keepdims=True)
        chance = np.exp(score)
        chance /= chance.sum(axis=1, keepdims=True)
        off = hot - chance
        step = np.zeros((many, many))
        np.add.at(step, label[near[:, 0]], off[near[:, 1]])
        np.add.at(step.T, label[near[:, 1]], off[near[:, 0]])
        slope = np.concatenate([(features.T @ off).ravel(), step.ravel(), [(off * v).sum() for v in votes]]) / n - decay * theta
        momentum = 0.9 * momentum + 0.1 * slope
        square = 0.99 * square + 0.01 * slope**2
        theta = theta + 0.1 * (momentum / (1 - 0.9**r)) / (np.sqrt(square / (1 - 0.99**r)) + 1e-9)
        theta[-2:] = np.maximum(theta[-2:], 0)  # words alike never push labels apart
    return Field(theta[:cut].reshape(-1, many), theta[cut:-2].reshape(many, many), theta[-2:])


def learn(docs: DataFrame, texts: int = SAMPLE_TEXTS) -> Field:
    """A field from about ``texts`` sampled texts and the patterns' labels on them."""
    many = max(1, -(-docs.count() // texts))
    sample = docs.where((F.pmod(F.xxhash64("text"), F.lit(many)) == 0) & F.col("text").rlike("[0-9@]")).select("text").distinct()

    def measured(batches):
        for batch in slices(batches, "text"):
            said = column(batch, "text").to_pylist()
            graph = Graph(said)
            label = graph.labels([base_spans(t) for t in said])
            key = int.from_bytes(hashlib.md5(said[0].encode()).digest()[:6], "big")
            yield pa.record_batch([pa.array([key]), *(pa.array([x.ravel().tolist()], kind) for x, kind in ((graph.features, pa.list_(pa.float32())), (graph.links, pa.list_(pa.int64())), (graph.kind, pa.list_(pa.int64())), (label, pa.list_(pa.int64()))))], ["key", "features", "links", "kind", "label"])

    rows = sorted(sample.mapInArrow(measured, "key long, features array<float>, links array<long>, kind array<long>, label array<long>").collect(), key=lambda r: r.key)
    base = np.concatenate([[0], np.cumsum([len(r.label) for r in rows])]).astype(np.int64)
    join = lambda parts, empty: np.concatenate([*parts, empty])
    features = join([np.array(r.features).reshape(-1, WIDTH) for r in rows], np.zeros((0, WIDTH)))
    links = join([np.array(r.links, np.int64).reshape(-1, 2) + b for r, b in zip(rows, base, strict=False)], np.zeros((0, 2), np.int64))
    kind, label = (join([np.array(getattr(r, c), np.int64) for r in rows], np.zeros(0, np.int64)) for c in ("kind", "label"))
    return fit(features, links, kind, label)


def added_spans(field: Field, texts: list[str], spans: list[list[tuple[int, int, int]]]) -> list[list[tuple[int, int, int]]]:
    """Spans of words with one label side by side that overlap none of the patterns' spans."""
    graph = Graph(texts)
    label = field.decode(graph)
    joined = set(map(tuple, graph.links[graph.kind == 0].tolist()))
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    i = 0
    while i < len(label):
        j = i
        while j + 1 < len(label) and label[j + 1] == label[i] and (j, j + 1) in joined and label[i] == 4:
            j += 1
        t, start, _ = graph.place[i]
        end = graph.place[j][2]
        if label[i] and not any(a < end and start < b for a, _, b in spans[t]) and (label[i] != 4 or 9 <= len(_NOT_DIGIT.sub("", texts[t][start:end])) <= 15):
            out[t].append((start, int(label[i]) - 1, end))
        i = j + 1
    return out


def _said(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def find(docs: DataFrame, field: Field) -> DataFrame:
    """One row per text: doc_id, the patterns' spans counted by kind and as a sha256 of their list, all spans, and n_added."""

    def found(batches):
        for batch in slices(batches, "text"):
            texts = column(batch, "text")
            data, at = text_bytes(texts)
            marks = np.zeros(len(data) + 1, np.int64)
            np.cumsum(((data >= 48) & (data <= 57)) | (data == 64), out=marks[1:])
            has = np.flatnonzero(marks[at[1:]] > marks[at[:-1]])
            said = texts.take(pa.array(has)).to_pylist()
            base = [base_spans(t) for t in said]
            more = added_spans(field, said, base)
            counts = np.zeros((4, len(texts)), np.int64)
            added = np.zeros(len(texts), np.int64)
            digest = [hashlib.sha256(b"").hexdigest()] * len(texts)
            listed = [""] * len(texts)
            for i, b, m in zip(has.tolist(), base, more, strict=True):
                for _, kind, _ in b:
                    counts[kind, i] += 1
                added[i] = len(m)
                digest[i] = hashlib.sha256(_said(b).encode()).hexdigest()
                listed[i] = _said(sorted(b + m))
            yield pa.record_batch(
                [column(batch, "doc_id"), *map(pa.array, counts), pa.array(digest, pa.string()), pa.array(listed, pa.string()), pa.array(added)],
                ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_added"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(found, f"doc_id {kind}, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long")
