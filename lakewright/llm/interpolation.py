"""A language model by deleted interpolation.

The probability of a token after another mixes three estimates: how often the pair
follows its context, how often the token occurs, and one share for every known token
and for all unknown ones together. The weights depend on how often the context occurs
(buckets by powers of two). They are learned by expectation-maximisation on a part of
the training texts that the counts leave out meanwhile; afterwards the counts cover
all training texts.

Counts are never gathered in one place. Texts are dealt into chunks; a chunk asks for
the counts of its distinct tokens and pairs, sorted by hash and packed; the requests
are dealt by hash range, summed there, and answered in the same order. A chunk then
needs only its texts and its answers. Per pair of chunk and range there is one small
row, and a frequent token is one entry per chunk.

Words are lower-cased (A-Z only); every text ends with an end token, which is also the
context of its first word. A null text is empty and has the end token alone. Rows with
equal ids count and are scored one by one; a null id counts as the empty text for its
fold. Extra columns are not looked at. Without training texts the model is uniform.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakewright.llm.toxicity import fold
from lakewright.llm.words import U64, Hasher, column, mix, text_bytes
from lakewright.session import materialise

FOLDS = 5
#: The fold that is scored only, and the training fold that the weights are learned on.
TEST, HELD = 1, 2
#: Bytes of text in a chunk, and of text whose requests one range of hashes takes.
CHUNK = 16 << 20
RANGE = 32 << 20
BUCKETS = 48
GRID = 8
END = U64(0x5851F42D4C957F2D)


def tokens_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of all texts, each closed by END, and the first of each text, with the end."""
    hasher = Hasher()
    data, at = text_bytes(texts)
    data = hasher.lower[data]
    start, end, first = hasher.spans(data, at)
    words = hasher.runs(data, start, end)
    return np.insert(words, first[1:], END), first + np.arange(len(first))


def pairs_of(tokens: np.ndarray) -> np.ndarray:
    """A 56-bit number for each token with the one before it."""
    before = np.concatenate([[END], tokens[:-1]])
    return mix(before * U64(0x9E3779B97F4A7C55) + tokens) >> U64(8) << U64(8)


def packed(numbers: np.ndarray) -> bytes:
    """Numbers as bytes, plane by plane, compressed: small ones cost little."""
    planes = np.ascontiguousarray(numbers.view(np.uint8).reshape(len(numbers), -1).T)
    return pa.compress(planes.tobytes(), codec="zstd", asbytes=True) if len(numbers) else b""


def unpacked(data: bytes, n: int, kind) -> np.ndarray:
    width = np.dtype(kind).itemsize
    if not n:
        return np.empty(0, kind)
    planes = np.frombuffer(pa.decompress(data, decompressed_size=n * width, codec="zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(width, n).T).view(kind).ravel()


def requests(chunked: DataFrame, ranges: int) -> DataFrame:
    """chunk, fold, kind (1 token, 2 pair), range, n, keys (packed differences) and times: what every chunk asks for."""

    def asked(table: pa.Table) -> pa.Table:
        tokens, _ = tokens_of(column(table, "text"))
        chunk, part = table.column("chunk")[0].as_py(), table.column("fold")[0].as_py()
        rows = []
        for kind, keys in ((1, tokens), (2, pairs_of(tokens))):
            found, times = np.unique(keys, return_counts=True)
            edges = (np.arange(1, ranges, dtype=object) * (1 << 64) // ranges).astype(U64) if ranges > 1 else np.empty(0, U64)
            cuts = np.concatenate([[0], np.searchsorted(found, edges), [len(found)]])
            for r, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
                if b > a:
                    gaps = np.diff(found[a:b] >> U64(8) if kind == 2 else found[a:b], prepend=U64(0))
                    rows.append((chunk, part, kind, r, int(b - a), packed(gaps), packed(times[a:b].astype(np.uint32))))
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _REQUEST.types, strict=True)], schema=_REQUEST)

    return chunked.groupBy("chunk").applyInArrow(asked, "chunk long, fold int, kind int, range int, n int, keys binary, times binary")


_REQUEST = pa.schema([("chunk", pa.int64()), ("fold", pa.int32()), ("kind", pa.int32()), ("range", pa.int32()), ("n", pa.int32()), ("keys", pa.binary()), ("times", pa.binary())])
_ANSWER = pa.schema([("chunk", pa.int64()), ("kind", pa.int32()), ("range", pa.int32()), ("n", pa.int32()), ("all", pa.binary()), ("kept", pa.binary()), ("types", pa.int64()), ("tokens", pa.int64()), ("kept_tokens", pa.int64())])


def answers(asked: DataFrame) -> DataFrame:
    """For every request the counts in all training texts, for held-out chunks also those without the held-out texts.

    One row per range, of chunk -1, has the numbers of distinct and of all tokens.
    """

    def counted(table: pa.Table) -> pa.Table:
        table = table.sort_by("chunk")
        size = column(table, "n").to_numpy()
        cuts = np.concatenate([[0], np.cumsum(size)])
        kind, span = table.column("kind")[0].as_py(), table.column("range")[0].as_py()
        folds = column(table, "fold").to_numpy()
        keys = np.concatenate([np.cumsum(unpacked(k.as_py(), n, U64)) for k, n in zip(table.column("keys"), size, strict=True)])
        found, where = np.unique(keys, return_inverse=True)
        del keys
        all_, kept = np.zeros(len(found), np.int64), np.zeros(len(found), np.int64)
        for a, b, part, times in zip(cuts, cuts[1:], folds, table.column("times"), strict=False):
            if part != TEST:
                counts = unpacked(times.as_py(), int(b - a), np.uint32)
                all_[where[a:b]] += counts  # the keys of one request are distinct
                if part != HELD:
                    kept[where[a:b]] += counts
        rows = [
            (chunk, kind, span, int(b - a), packed(all_[where[a:b]]), packed(kept[where[a:b]]) if part == HELD else b"", 0, 0, 0)
            for chunk, a, b, part in zip(column(table, "chunk").to_pylist(), cuts, cuts[1:], folds, strict=False)
        ]
        rows.append((-1, kind, span, 0, b"", b"", int((all_ > 0).sum()), int(all_.sum()), int(kept.sum())))
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _ANSWER.types, strict=True)], schema=_ANSWER)

    return asked.groupBy("kind", "range").applyInArrow(counted, "chunk long, kind int, range int, n int, all binary, kept binary, types long, tokens long, kept_tokens long")


class Counted:
    """The tokens of a chunk with the counts it was answered."""

    def __init__(self, texts: pa.Table, replies: pa.Table, name: str) -> None:
        tokens, self.first = tokens_of(column(texts, "text"))
        replies = replies.sort_by("range")
        of = {}
        for kind, keys in ((1, tokens), (2, pairs_of(tokens))):
            mine = replies.filter(pa.array(column(replies, "kind").to_numpy() == kind))
            counts = np.concatenate([unpacked(x.as_py(), n, np.int64) for x, n in zip(mine.column(name), column(mine, "n").to_numpy(), strict=True)])
            where = np.unique(keys, return_inverse=True)[1]
            of[kind] = counts[where]
            if kind == 1:
                end = counts[where[-1]]
        self.token, self.pair = of[1], of[2]
        self.context = np.concatenate([[end], self.token[:-1]])
        self.bucket = bucket(self.context)


def bucket(count: np.ndarray) -> np.ndarray:
    """0 for an unseen context, else one more than the power of two below its count."""
    return np.minimum(np.frexp(count.astype(np.float64))[1], BUCKETS - 1)


def held_out_statistics(chunked: DataFrame, replies: DataFrame) -> DataFrame:
    """bucket, pair, token, n: how many held-out tokens have these logarithms (in eighths) of the estimates; -1 for none.

    The rows are bounded by the grid, whatever the input's size.
    """

    def counted(texts: pa.Table, replies: pa.Table) -> pa.Table:
        schema = pa.schema([(c, pa.int64()) for c in ("bucket", "pair", "token", "n")])
        if not texts.num_rows:
            return schema.empty_table()
        seen = Counted(texts, replies, "kept")
        with np.errstate(divide="ignore", invalid="ignore"):
            pair = np.where(seen.pair > 0, np.rint(GRID * np.log(seen.context / seen.pair)), -1).astype(np.int64)
            token = np.where(seen.token > 0, np.rint(GRID * np.log(seen.token)), -1).astype(np.int64)
        key, n = np.unique((seen.bucket * 4096 + pair + 1) * 4096 + token + 1, return_counts=True)
        return pa.Table.from_arrays([pa.array(x.astype(np.int64)) for x in (key >> 24, (key >> 12 & 4095) - 1, (key & 4095) - 1, n)], schema=schema)

    held = chunked.where(F.col("fold") == HELD).groupBy("chunk").cogroup(replies.where("chunk >= 0 and octet_length(kept) > 0").groupBy("chunk"))
    return held.applyInArrow(counted, "bucket long, pair long, token long, n long").groupBy("bucket", "pair", "token").agg(F.sum("n").alias("n"))


def weights(statistics: list, tokens: int, types: int, rounds: int = 100) -> np.ndarray:
    """Mixture weights of pair, token and even share for each bucket, by expectation-maximisation."""
    mixture = np.tile([0.3, 0.6, 0.1], (BUCKETS, 1))
    mixture[0] = [0.0, 0.9, 0.1]
    if not statistics:
        return mixture
    at, pair, token, n = np.array([(r.bucket, r.pair, r.token, r.n) for r in statistics], np.int64).T
    chance = np.stack([np.where(pair >= 0, np.exp(-pair / GRID), 0), np.where(token >= 0, np.exp(token / GRID) / max(tokens, 1), 0), np.full(len(n), 1 / (types + 1))], axis=1)
    prior = mixture * 2.0
    for _ in range(rounds):
        share = mixture[at] * chance
        share *= (n / share.sum(1))[:, None]
        mixture = prior + np.stack([np.bincount(at, weights=share[:, k], minlength=BUCKETS) for k in range(3)], axis=1)
        mixture /= mixture.sum(1, keepdims=True)
    return mixture


@dataclass(frozen=True)
class Model:
    """Mixture weights, all training tokens, and how many are distinct; ``chunked`` and ``replies`` hold the counts."""

    mixture: np.ndarray
    tokens: int
    types: int
    chunked: DataFrame
    replies: DataFrame


def learn(docs: DataFrame, chunk: int = CHUNK, span: int = RANGE) -> Model:
    """Counts and weights from the texts outside the fold ``TEST``."""
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    chunks, ranges = max(1, -(-total // (FOLDS * chunk))), max(1, -(-total // span))
    part = fold(F.col("doc_id"), FOLDS)
    chunked = docs.select("doc_id", "text", part.alias("fold"), (part * chunks + F.pmod(F.xxhash64("doc_id", "text"), F.lit(chunks))).cast("long").alias("chunk"))
    replies = materialise(answers(requests(chunked, ranges)), "answers")
    sums = replies.where("chunk = -1 and kind = 1").agg(F.sum("types").alias("types"), F.sum("tokens").alias("tokens"), F.sum("kept_tokens").alias("kept")).first()
    tokens, types = sums.tokens or 0, sums.types or 0
    mixture = weights(held_out_statistics(chunked, replies).collect(), sums.kept or 0, types)
    return Model(mixture, tokens, types, chunked, replies)


def score_texts(model: Model) -> DataFrame:
    """One row per text: doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score (log10)."""
    mixture, n, v = model.mixture, model.tokens, model.types
    kind = model.chunked.schema["doc_id"].dataType.simpleString()

    def scored(texts: pa.Table, replies: pa.Table) -> pa.Table:
        names = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
        seen = Counted(texts, replies, "all")
        part = mixture[seen.bucket]
        chance = part[:, 0] * seen.pair / np.maximum(seen.context, 1) + part[:, 1] * seen.token / max(n, 1) + part[:, 2] / (v + 1)
        # An unseen context, or no training at all, leaves the weight of the estimates it lacks unused.
        chance = np.where(seen.context > 0, chance, chance / np.maximum(part[:, 1] * (n > 0) + part[:, 2], 1e-300))
        base = np.log10((seen.token + 0.5) / (n + 0.5 * (v + 1)))
        first = seen.first
        sums = lambda x: np.add.reduceat(x, first[:-1])
        out = [
            column(texts, "doc_id"),
            pa.array(column(texts, "fold").to_numpy() == TEST),
            *(pa.array(x.astype(np.int64)) for x in (np.diff(first), sums((seen.token > 0).astype(np.int64)), np.full(texts.num_rows, n))),
            *(pa.array(sums(x)) for x in (base, np.log10(chance))),
        ]
        return pa.Table.from_arrays(out, names)

    both = model.chunked.groupBy("chunk").cogroup(model.replies.where("chunk >= 0").groupBy("chunk"))
    return both.applyInArrow(scored, f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
