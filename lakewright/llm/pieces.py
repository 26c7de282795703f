"""Piece ids of texts with the byte spans they stand for, and texts of piece ids.

A text is first normalised: at each place the longest entry of the model's compiled
character map is replaced by its value, and blanks become the mark U+2581. Every byte of
the result remembers where its source began. The normalised text is cut between all
characters that stand together in no piece, as no piece can go on over such a place; the
characters between two cuts, a word, are merged by the pieces' scores, best first and of
equal ones the leftmost. What is no piece becomes the pieces of its bytes, or the unknown
id. Each piece is then projected back to the span of bytes of the text that it came from,
so spans follow each other and together cover the text, but for white space that the
model drops.

Models are byte-pair models without symbols of the user; others are refused. All of a
text is encoded. The new words of some texts are merged together, one pair of each at a
time, and remembered for later texts of the task; how many are has no effect on the
result.

A null text is empty, and an empty one has its end id alone. Rows with equal ids are
encoded one by one, a null id stays null, an empty table gives no rows, and extra columns
are not looked at.
"""

from __future__ import annotations

import contextlib
import heapq
import struct
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from lakewright.llm.words import column, slices, text_bytes

MARK = "▁"
#: Words that a task remembers before it begins anew.
REMEMBERED = 300_000
#: Characters up to which words are merged together; pairs of a longer word wait in a heap.
SHORT = 48
#: Bytes of text whose pieces are held at a time.
BATCH = 1 << 20

MODEL = "/opt/tokenizers/piece_bpe_32k.model"

#: Fixed values of the model's file: kinds of pieces and of models.
NORMAL, UNKNOWN, CONTROL, OF_USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
BYTE_PAIR = 2


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Number and value of each field of a message in protocol-buffer form."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        key = varint()
        size = {1: 8, 5: 4}.get(key & 7)
        if key & 7 == 0:
            yield key >> 3, varint()
            continue
        size = varint() if size is None else size
        yield key >> 3, data[at : at + size]
        at += size


class CharacterMap:
    """Longest-prefix replacement by a compiled map: a double-array trie and its values."""

    def __init__(self, compiled: bytes) -> None:
        size = struct.unpack_from("<I", compiled)[0] if compiled else 0
        self.units = np.frombuffer(compiled, np.uint32, size // 4, 4) if size else np.empty(0, np.uint32)
        self.values = compiled[4 + size :]

    @staticmethod
    def _offset(unit: np.ndarray) -> np.ndarray:
        return (unit >> 10) << ((unit & 512) >> 6)

    def longest(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Where an entry begins, the length of the longest there, and where its value begins; one step of the trie at a time for all places."""
        units = self.units
        length, value = np.zeros(len(data), np.int64), np.zeros(len(data), np.int64)
        if len(units) and len(data):
            place = np.flatnonzero((data & 0xC0) != 0x80)
            node = np.full(len(place), self._offset(units[0]), np.int64)
            depth = 0
            while len(place):
                label = data[place + depth]
                node ^= label
                node = np.where(node < len(units), node, 0)
                unit = units[node]
                ok = (unit & 0x800000FF) == label
                place, node, unit = place[ok], node[ok] ^ self._offset(unit[ok]), unit[ok]
                depth += 1
                leaf = (unit >> 8) & 1 == 1
                length[place[leaf]] = depth
                value[place[leaf]] = units[node[leaf]] & 0x7FFFFFFF
                more = place + depth < len(data)
                place, node = place[more], node[more]
        where = np.flatnonzero(length)
        return where, length[where], value[where]

    def replaced(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes after replacement, from left to right, and for each the place in ``data`` where its source begins, with the end.

        The source of a byte is a whole entry of the map or one character.
        """
        lead = (data & 0xC0) != 0x80
        source = np.maximum.accumulate(np.where(lead, np.arange(len(data)), 0)) if len(data) else np.empty(0, np.int64)
        where, length, value = self.longest(data)
        out, origin, done = [], [], 0
        for at, size, begin in zip(where.tolist(), length.tolist(), value.tolist(), strict=True):
            if at < done:
                continue  # inside an entry already replaced
            new = np.frombuffer(self.values[begin : self.values.index(b"\0", begin)], np.uint8)
            out += [data[done:at], new]
            origin += [source[done:at], np.full(len(new), at)]
            done = at + size
        out.append(data[done:])
        origin += [source[done:], [len(data)]]
        return np.concatenate(out), np.concatenate(origin).astype(np.int64)


def _filled(mask: np.ndarray) -> np.ndarray:
    """The places of bytes when each masked one takes the three bytes of the mark."""
    return np.repeat(np.arange(len(mask)), np.where(mask, 3, 1))


@dataclass(frozen=True)
class Model:
    """A model as its file holds it; it goes along with the tasks, so executors need no file."""

    data: bytes

    @classmethod
    def read(cls, path: str = MODEL) -> Model:
        with open(path, "rb") as file:
            return cls(file.read())

    @cached_property
    def coder(self) -> Coder:
        return Coder(self.data)

    def __getstate__(self):
        return {"data": self.data}


class Coder:
    """Encodes texts, some at a time, and decodes ids."""

    def __init__(self, data: bytes) -> None:
        pieces, trainer, rules = [], {}, {}
        for number, value in _fields(data):
            if number == 1:
                pieces.append(dict(_fields(value)))
            elif number == 2:
                trainer |= dict(_fields(value))
            elif number == 3:
                rules |= dict(_fields(value))
        self.pieces = [p[1].decode() for p in pieces]
        self.kinds = [p.get(3, NORMAL) for p in pieces]
        scores = [struct.unpack("<f", p[2])[0] if 2 in p else 0.0 for p in pieces]
        self.end = trainer.get(42, 2)
        if trainer.get(3, 1) != BYTE_PAIR or {OF_USER, UNUSED} & set(self.kinds) or trainer.get(24) or self.end >= len(pieces):
            raise ValueError("not a byte-pair model of plain pieces with marks in front and an end id")
        self.ranked = {p: (-s, i) for i, (p, k, s) in enumerate(zip(self.pieces, self.kinds, scores, strict=True)) if k == NORMAL}
        self.control = np.array(self.kinds) == CONTROL
        self.piece_sizes = np.array([len(p.encode()) for p in self.pieces])
        self._pairs()
        self.unknown = self.kinds.index(UNKNOWN)
        self.unknown_text = trainer.get(44, b" \xe2\x81\x87 ").decode()
        self.bytes = {int(p[3:5], 16): i for i, (p, k) in enumerate(zip(self.pieces, self.kinds, strict=True)) if k == BYTE} if trainer.get(35) else {}
        self.map = CharacterMap(rules.get(2, b""))
        self.front, self.squeeze, self.escape = (bool(rules.get(n, 1)) for n in (3, 4, 5))
        self.forget()

    def _pairs(self) -> None:
        """A table of the characters that stand together in a piece, numbered, 0 for all that never do; and of the symbols that merge.

        A symbol is the id of a piece, or for a character that is none its code point after all ids.
        """
        pairs = {p[i : i + 2] for p in self.ranked for i in range(len(p) - 1)}
        known = sorted({c for pair in pairs for c in pair})
        self.number = np.zeros(0x110000, np.int32)
        self.number[[ord(c) for c in known]] = np.arange(1, len(known) + 1)
        self.joined = np.zeros((len(known) + 1, len(known) + 1), bool)
        a, b = ([ord(pair[k]) for pair in pairs] for k in (0, 1))
        self.joined[self.number[a], self.number[b]] = True

        self.symbol = np.arange(0x110000) + len(self.pieces)
        for piece, (_, i) in self.ranked.items():
            if len(piece) == 1:
                self.symbol[ord(piece)] = i
        of = lambda x: self.ranked[x][1] if x in self.ranked else int(self.symbol[ord(x)]) if len(x) == 1 else None
        halves = [(of(p[:i]), of(p[i:]), *r) for p, r in self.ranked.items() for i in range(1, len(p))]
        merges = sorted((a << 21 | b, cost, i) for a, b, cost, i in halves if a is not None and b is not None)
        self.halves, self.whole = (np.array([m[k] for m in merges], np.int64) for k in (0, 2))
        self.rank = np.unique([m[1] for m in merges], return_inverse=True)[1].astype(np.int64)

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.ids, self.sizes, self.starts = np.empty(0, np.int32), np.empty(0, np.int32), np.zeros(1, np.int64)

    def words(self, text: str) -> list[str]:
        """The text, cut where no piece goes on."""
        if not text:
            return []
        number = self.number[np.frombuffer(text.encode("utf-32-le"), np.uint32)]
        cuts = (np.flatnonzero(~self.joined[number[:-1], number[1:]]) + 1).tolist()
        return [text[a:b] for a, b in zip([0, *cuts], [*cuts, len(text)], strict=True)]

    def normalised(self, data: np.ndarray) -> tuple[str, np.ndarray]:
        """The normalised text, and the source place of each of its bytes, with the end."""
        out, origin = self.map.replaced(data)
        blank = out == 32
        if self.squeeze and len(out):
            # A blank stays after something else only, and none at the end.
            keep = ~(blank & np.concatenate([[True], blank[:-1]]))
            last = np.flatnonzero(keep & ~blank)
            end = last[-1] + 1 if len(last) else 0
            keep[end:] = False
            origin = np.append(origin[:-1][keep], origin[end])
            out, blank = out[keep], blank[keep]
        if not len(out):
            return "", origin[-1:]
        if self.front:
            out, blank = np.insert(out, 0, 32), np.insert(blank, 0, True)
            origin = np.insert(origin, 0, origin[0])
        if not self.escape:
            return out.tobytes().decode(), origin
        return out.tobytes().decode().replace(" ", MARK), np.append(origin[_filled(blank)], origin[-1])

    def merged(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The symbols that the characters of each word merge into, and the number of the word of each."""
        symbols = self.symbol[np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)]
        of = np.repeat(np.arange(len(words)), [len(w) for w in words])
        done = []
        while len(symbols) and len(self.halves):
            pair = np.append(symbols[:-1] << 21 | symbols[1:], -1)
            where = np.minimum(np.searchsorted(self.halves, pair), len(self.halves) - 1)
            fits = (self.halves[where] == pair) & np.append(of[1:] == of[:-1], False)
            cost = np.where(fits, self.rank[where] * len(symbols) + np.arange(len(symbols)), np.iinfo(np.int64).max)
            first = np.flatnonzero(np.diff(of, prepend=-1))
            best = np.minimum.reduceat(cost, first)
            ended = np.repeat(best == np.iinfo(np.int64).max, np.diff(np.append(first, len(of))))
            at = best[best < np.iinfo(np.int64).max] % len(symbols)
            symbols[at] = self.whole[where[at]]
            stays = ~ended
            stays[at + 1] = False
            done.append((symbols[ended], of[ended]))
            symbols, of = symbols[stays], of[stays]
        symbols, of = (np.concatenate([*(d[k] for d in done), x]) for k, x in ((0, symbols), (1, of)))
        order = np.argsort(of, kind="stable")
        return symbols[order], of[order]

    def merged_long(self, word: str) -> list[int]:
        """The symbols of one word, however long."""
        part, after, before = list(word), list(range(1, len(word) + 1)), list(range(-1, len(word) - 1))
        ranked = self.ranked
        waiting: list[tuple[float, int, str]] = []

        def offer(left: int) -> None:
            if left >= 0 and after[left] < len(part):
                both = part[left] + part[after[left]]
                if both in ranked:
                    heapq.heappush(waiting, (ranked[both][0], left, both))

        for i in range(len(part) - 1):
            offer(i)
        while waiting:
            _, left, both = heapq.heappop(waiting)
            right = after[left]
            if not part[left] or right >= len(part) or part[left] + part[right] != both:
                continue  # one of the two has been merged since
            part[left], part[right] = both, ""
            after[left] = after[right]
            if after[right] < len(part):
                before[after[right]] = left
            offer(before[left])
            offer(left)
        return [ranked[p][1] if p in ranked else int(self.symbol[ord(p)]) for p in part if p]

    def learn(self, words: list[str]) -> None:
        """Remember ids and sizes in bytes of the pieces of new words; of the bytes of one character the last takes them all."""
        short, long = [w for w in words if len(w) <= SHORT], [w for w in words if len(w) > SHORT]
        found = [self.merged(short)]
        for i, word in enumerate(long, len(short)):
            symbols = np.array(self.merged_long(word))
            found.append((symbols, np.full(len(symbols), i)))
        symbols, of = (np.concatenate([f[k] for f in found]) for k in (0, 1))
        strange = np.flatnonzero(symbols >= len(self.pieces))
        sizes = self.piece_sizes[np.where(symbols < len(self.pieces), symbols, 0)]
        if len(strange):
            as_bytes = [chr(c).encode() for c in (symbols[strange] - len(self.pieces)).tolist()]
            sizes[strange] = [len(x) for x in as_bytes]
            symbols[strange] = self.unknown
            if self.bytes:
                many = np.ones(len(symbols), np.int64)
                many[strange] = sizes[strange]
                symbols, sizes, of = (np.repeat(x, many) for x in (symbols, sizes, of))
                last = np.cumsum(many)[strange] - 1
                for at, chars in zip(last.tolist(), as_bytes, strict=True):
                    begin = at + 1 - len(chars)
                    symbols[begin : at + 1] = [self.bytes[b] for b in chars]
                    sizes[begin:at] = 0
        self.known.update(zip(short + long, range(len(self.known), len(self.known) + len(words)), strict=True))
        self.starts = np.append(self.starts, self.starts[-1] + np.cumsum(np.bincount(of, minlength=len(words))))
        self.ids, self.sizes = np.append(self.ids, symbols.astype(np.int32)), np.append(self.sizes, sizes.astype(np.int32))

    def encode(self, data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of texts, given by their bytes and where each begins: where the ids of each begin, with the end; all ids; the first and the end byte of each.

        Bytes are counted in the text; the end id of a text stands for none.
        """
        words, first, origins = [], [0], []
        for a, b in zip(at.tolist(), at[1:].tolist(), strict=False):
            text, origin = self.normalised(data[a:b])
            words += self.words(text)
            first.append(len(words))
            origins.append(origin)
        if len(self.known) > REMEMBERED:
            self.forget()
        if new := list({w for w in words if w not in self.known}):
            self.learn(new)
        word = np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))
        many = self.starts[word + 1] - self.starts[word]
        ends = np.concatenate([[0], np.cumsum(many)])
        where = np.repeat(self.starts[word] - ends[:-1], many) + np.arange(ends[-1])
        ids, cut = self.ids[where], np.concatenate([[0], np.cumsum(self.sizes[where], dtype=np.int64)])
        cuts = ends[first]
        text_no = np.repeat(np.arange(len(at) - 1), np.diff(cuts))
        # An origin has one entry more than its text has bytes.
        origin = np.concatenate([np.empty(0, np.int64), *origins])
        begin, end = origin[cut[:-1] + text_no], origin[cut[1:] + text_no]
        if not self.bytes and len(ids):
            # Unknown pieces that touch are one.
            same = np.append(False, (ids[1:] == self.unknown) & (ids[:-1] == self.unknown) & (text_no[1:] == text_no[:-1]))
            last = np.append(~same[1:], True)
            ids, begin, end = ids[~same], begin[~same], end[last]
            cuts = np.append(0, np.cumsum(~same))[cuts]
        size = np.diff(at)
        found = (np.insert(x, cuts[1:], y).astype(np.int32) for x, y in ((ids, self.end), (begin, size), (end, size)))
        return cuts + np.arange(len(cuts)), *found

    def decode(self, ids: np.ndarray) -> str:
        """The text that ids stand for."""
        if len(ids) and not 0 <= ids.min() <= ids.max() < len(self.pieces):
            raise ValueError("an id is none of the model's")
        numbers = ids.tolist()
        out = list(map(self.surfaces.__getitem__, numbers))
        if self.front or self.squeeze:
            # The blank that encoding puts in front; all blanks there where it drops others.
            for at, i in enumerate(numbers):
                blank = self.kinds[i] == NORMAL and out[at].startswith(b" ")
                out[at] = out[at][1:] if blank else out[at]
                if out[at] or self.kinds[i] != CONTROL and blank and not self.squeeze:
                    break
        if not self.control[ids[:-1]].any():
            with contextlib.suppress(UnicodeDecodeError):
                return b"".join(out).decode()
        # Runs of single bytes are read on their own; one that is no part of a character becomes U+FFFD.
        found, run = [], b""
        for i, text in [*zip(numbers, out, strict=True), (self.end, b"")]:
            if self.kinds[i] == BYTE:
                run += text
            else:
                found += [_of_bytes(run), text.decode()]
                run = b""
        return "".join(found)

    @cached_property
    def surfaces(self) -> list[bytes]:
        """The text of each piece."""
        said = {CONTROL: lambda p: b"", UNKNOWN: lambda p: self.unknown_text.encode(), BYTE: lambda p: bytes([int(p[3:5], 16)]), NORMAL: lambda p: p.replace(MARK, " ").encode()}
        return [said[k](p) for k, p in zip(self.kinds, self.pieces, strict=True)]


def _of_bytes(run: bytes) -> str:
    """A run of bytes as text; each byte of what is no UTF-8 becomes U+FFFD."""
    out = []
    while run:
        try:
            return "".join([*out, run.decode()])
        except UnicodeDecodeError as wrong:
            out += [run[: wrong.start].decode(), "�"]
            run = run[wrong.start + 1 :]
    return "".join(out)


def encode_texts(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, ids, begins and ends (the bytes of the text that each id stands for) and decoded, per row of ``docs``."""

    def coded(batches):
        coder = model.coder
        for batch in slices(batches, "text", BATCH):
            data, at = text_bytes(column(batch, "text"))
            cuts, *found = coder.encode(data, at)
            texts = [coder.decode(found[0][a:b]) for a, b in zip(cuts.tolist(), cuts[1:].tolist(), strict=False)]
            lists = [pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), pa.array(x)) for x in found]
            yield pa.record_batch([column(batch, "doc_id"), *lists, pa.array(texts, pa.string())], ["doc_id", "ids", "begins", "ends", "decoded"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(coded, f"doc_id {kind}, ids array<int>, begins array<int>, ends array<int>, decoded string")


def decode_ids(rows: DataFrame, model: Model, ids: str = "ids", to: str = "decoded") -> DataFrame:
    """All columns of ``rows`` and the text of the id list in one of them; null for null."""
    if to in rows.columns:
        raise ValueError(f"there is a column {to} already")
    schema = StructType([*rows.schema.fields, StructField(to, StringType())])

    def texts(batches):
        coder = model.coder
        for batch in batches:
            found = [None if not x.is_valid else coder.decode(x.values.to_numpy(zero_copy_only=False)) for x in column(batch, ids)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.string())], [*batch.schema.names, to])

    return rows.mapInArrow(texts, schema)


def digests(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, n_tokens, the digests of ids and decoded text, and n_span_bytes, how many bytes of the text the spans cover."""
    rows = encode_texts(docs, model)
    covered = F.aggregate(F.zip_with("ends", "begins", lambda e, b: (e - b).cast("long")), F.lit(0).cast("long"), lambda x, y: x + y)
    return rows.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        covered.alias("n_span_bytes"),
    )
