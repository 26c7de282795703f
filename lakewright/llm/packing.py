"""Token ids of texts, packed into sequences of one length.

Texts are dealt into shards by hash; the texts of a shard become token ids, each closed
by an end id, and are packed by best-fit-decreasing: pieces go from long to short, each
into the fullest sequence that still has room for it. A segment tree over the room left
finds that sequence. A text longer than a sequence is first cut into pieces, of which
all but the last fill one; nothing is lost, and pieces carry their number.

Shards depend on the rows alone, so another cluster packs alike. A shard is read in
order and packed whenever it holds ``BUFFER`` tokens, so memory is bounded whatever
rows share a shard.

A null or empty text is its end id alone. Rows with equal ids are packed one by one and
told apart by ``text_nos``; a null id stays null, and ids keep their type. An empty table gives no sequences.
Other columns are not looked at.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakewright.llm.words import column, slices

#: Tokens of a sequence, bytes of text in a shard, tokens packed at a time.
LENGTH = 2048
SHARD = 16 << 20
BUFFER = 1 << 23
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed values of that vocabulary: how text is split before its ranks apply, and the id free for the end of a text.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
END = 50256


@dataclass(frozen=True)
class Vocabulary:
    """Ranks as the file holds them; they go along with the tasks, so executors need no file."""

    ranks: bytes
    split: str = SPLIT
    end: int = END

    @classmethod
    def read(cls, path: str = VOCABULARY, **more) -> Vocabulary:
        with open(path, "rb") as file:
            return cls(file.read(), **more)

    def encoding(self):
        import tiktoken

        ranks = {base64.b64decode(word): int(rank) for word, rank in map(bytes.split, self.ranks.splitlines())}
        return tiktoken.Encoding("own", pat_str=self.split, mergeable_ranks=ranks, special_tokens={})


class Rooms:
    """A segment tree over room 0 to ``length``: the number of open sequences with that room, summed upwards."""

    def __init__(self, length: int) -> None:
        self.leaves = 1 << length.bit_length()
        self.open = [0] * (2 * self.leaves)
        self.held: list[list[int]] = [[] for _ in range(length + 1)]

    def put(self, room: int, sequence: int) -> None:
        self.held[room].append(sequence)
        at = room + self.leaves
        while at:
            self.open[at] += 1
            at >>= 1

    def take(self, need: int) -> tuple[int, int] | None:
        """The fullest sequence with at least ``need`` room, and its room."""
        tree, at = self.open, need + self.leaves
        if not tree[at]:
            # Up until a subtree to the right holds one, then down to its smallest.
            while at > 1 and (at & 1 or not tree[at + 1]):
                at >>= 1
            if at <= 1:
                return None
            at += 1
            while at < self.leaves:
                at = 2 * at if tree[2 * at] else 2 * at + 1
        room = at - self.leaves
        while at:
            tree[at] -= 1
            at >>= 1
        return self.held[room].pop(), room


def best_fit(sizes: np.ndarray, length: int) -> list[list[int]]:
    """Pieces of each sequence, best fit from long to short; of equal sizes the earlier piece first."""
    rooms, sequences = Rooms(length), []
    for piece in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[piece])
        found = rooms.take(size)
        if found is None:
            found = (len(sequences), length)
            sequences.append([])
        sequences[found[0]].append(piece)
        if found[1] > size:
            rooms.put(found[1] - size, found[0])
    return sequences


_NAMES = ["shard", "sequence", "n_tokens", "input_ids", "position_ids", "cu_seqlens", "doc_ids", "text_nos", "pieces"]


class _Shard:
    """Texts of one shard on their way into sequences."""

    def __init__(self, number: int, length: int, pad: int, id_type: pa.DataType) -> None:
        self.number, self.length, self.pad, self.id_type = number, length, pad, id_type
        self.texts = self.done = self.tokens = 0
        self.ids: list[np.ndarray] = []
        self.of: list[tuple] = []

    def add(self, doc_id, ids: np.ndarray) -> None:
        for k, a in enumerate(range(0, len(ids), self.length)):
            self.ids.append(ids[a : a + self.length])
            self.of.append((doc_id, self.texts, k))
        self.texts += 1
        self.tokens += len(ids)

    def packed(self) -> Iterator[pa.RecordBatch]:
        if not self.ids:
            return
        sequences = best_fit(np.array([len(x) for x in self.ids]), self.length)
        for a in range(0, len(sequences), 256):
            part = sequences[a : a + 256]
            ids = np.full((len(part), self.length), self.pad, np.int32)
            positions = np.zeros((len(part), self.length), np.int32)
            ends, of = [], []
            for r, pieces in enumerate(part):
                at, cuts = 0, [0]
                for p in pieces:
                    size = len(self.ids[p])
                    ids[r, at : at + size] = self.ids[p]
                    positions[r, at : at + size] = np.arange(size)
                    at += size
                    cuts.append(at)
                ends.append(cuts)
                of.append([self.of[p] for p in pieces])
            offsets = pa.array(np.arange(len(part) + 1, dtype=np.int32) * self.length)
            lists = [pa.ListArray.from_arrays(offsets, pa.array(x.ravel())) for x in (ids, positions)]
            yield pa.record_batch(
                [
                    pa.array(np.full(len(part), self.number), pa.int64()),
                    pa.array(np.arange(len(part)) + self.done + a, pa.int64()),
                    pa.array([c[-1] for c in ends], pa.int32()),
                    *lists,
                    pa.array(ends, pa.list_(pa.int32())),
                    *(pa.array([[o[k] for o in row] for row in of], pa.list_(kind)) for k, kind in enumerate((self.id_type, pa.int64(), pa.int64()))),
                ],
                _NAMES,
            )
        self.done += len(sequences)
        self.ids, self.of, self.tokens = [], [], 0


def pack(docs: DataFrame, vocabulary: Vocabulary, length: int = LENGTH, shard: int = SHARD, buffer: int = BUFFER) -> DataFrame:
    """One row per sequence: shard, sequence (from 0), n_tokens, input_ids (``length`` ids, padded with the end
    id), position_ids (from 0 again in every segment), cu_seqlens (0 and the end of every segment), and for every
    segment doc_ids, text_nos (of the shard's texts) and pieces (of the text)."""
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(1, -(-total // shard))
    tie = F.xxhash64(F.coalesce("text", F.lit("")))
    dealt = docs.select("doc_id", "text", tie.alias("tie"))
    dealt = dealt.withColumn("shard", F.pmod(F.xxhash64("doc_id", "tie"), F.lit(shards)).cast("long"))

    def packed(batches):
        encoding, end = vocabulary.encoding(), np.array([vocabulary.end], np.int32)
        now = None
        for batch in slices(batches, "text"):
            for doc_id, text, number in zip(*(column(batch, c).to_pylist() for c in ("doc_id", "text", "shard")), strict=True):
                if now is None or now.number != number:
                    if now:
                        yield from now.packed()
                    now = _Shard(number, length, vocabulary.end, column(batch, "doc_id").type)
                ids = np.array(encoding.encode_ordinary(text), np.int32) if text else end[:0]
                now.add(doc_id, np.concatenate([ids, end]))
                if now.tokens >= buffer:
                    yield from now.packed()
        if now:
            yield from now.packed()

    id_type = docs.schema["doc_id"].dataType.simpleString()
    in_order = dealt.repartition("shard").sortWithinPartitions("shard", "doc_id", "tie")
    return in_order.select("doc_id", "text", "shard").mapInArrow(
        packed,
        f"shard long, sequence long, n_tokens int, input_ids array<int>, position_ids array<int>, cu_seqlens array<int>, doc_ids array<{id_type}>, text_nos array<long>, pieces array<long>",
    )
