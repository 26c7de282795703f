"""How filters interact: which documents each order of five filters removes, and where.

Every document becomes a 32-bit word with one bit for each subset of the filters: the bit
is set if the document survives all filters of that subset. The words of a part (a
language) and label are summed bit by bit with carry-save adders, three words of one
weight becoming one of that weight and one of twice it. The 32 sums of a part answer every
order: what a step keeps and removes is a difference of two sums.

The filters, by the failure that each stands for: A under 100 words, B under 80 % distinct
words, C over 10 % capitals (A-Z), D one of the symbols ``#$%&*|``, E the text of a smaller
id anywhere in the table. Words are runs of characters other than the blank and the
controls 9 to 13.

A null text is empty, a null language the empty string. Every row counts, rows with equal
ids too; those with the smallest id of a text all pass E. A null id is neither smaller nor
larger than another, so such a row passes E and fails no other row. A label counts if any
row of the labels gives it to the id; null labels count as 0. Extra columns are not looked
at. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakewright.functions.skew import salted_join
from lakewright.llm.words import column, text_bytes

FILTERS = "ABCDE"
LEAST_WORDS = 100
#: Distinct words below so many of 100 words, capitals above so many of 100 characters.
DISTINCT = 80
CAPITALS = 10
SYMBOLS = b"#$%&*|"

_SUBSETS = 1 << len(FILTERS)
_BIT = {name: 1 << i for i, name in enumerate(FILTERS)}
_UPPER = bytes(range(ord("A"), ord("Z") + 1))
#: Bytes that continue a character of UTF-8.
_LATER = bytes(range(0x80, 0xC0))
#: For each set of failed filters the word of the subsets that are survived.
_WORD = np.array([sum(1 << s for s in range(_SUBSETS) if not s & failed) for failed in range(_SUBSETS)], np.uint32)


def failed_alone(text: bytes) -> int:
    """The failed filters among those that look at one text only."""
    words = text.split()  # of bytes: at the blank and the controls 9 to 13
    characters = len(text.translate(None, _LATER))
    capitals = len(text) - len(text.translate(None, _UPPER))
    return (
        _BIT["A"] * (len(words) < LEAST_WORDS)
        | _BIT["B"] * (100 * len(set(words)) < DISTINCT * len(words))
        | _BIT["C"] * (100 * capitals > CAPITALS * characters)
        | _BIT["D"] * (len(text.translate(None, SYMBOLS)) < len(text))
    )


def failures(docs: DataFrame) -> DataFrame:
    """doc_id, part, failed (a bit for each failed filter), one row per row of ``docs``; texts are read once and not moved."""

    def looked_at(batches):
        for batch in batches:
            data, at = text_bytes(column(batch, "text"))
            texts = [data[a:b].tobytes() for a, b in zip(at.tolist(), at[1:].tolist(), strict=False)]
            digests = pa.array([hashlib.sha256(t).digest() for t in texts], pa.binary())
            failed = pa.array([failed_alone(t) for t in texts], pa.int32())
            yield pa.record_batch([column(batch, "doc_id"), column(batch, "part"), digests, failed], ["doc_id", "part", "digest", "failed"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    plain = docs.select("doc_id", F.coalesce("lang", F.lit("")).alias("part"), "text")
    rows = plain.mapInArrow(looked_at, f"doc_id {kind}, part string, digest binary, failed int")
    first = rows.groupBy("digest").agg(F.min("doc_id").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    joined = salted_join(rows, first, ["digest"], "left", spread_by=["doc_id", "part"])
    again = F.coalesce(F.col("doc_id") > F.col("first"), F.lit(False))
    return joined.select("doc_id", "part", F.col("failed").bitwiseOR(F.when(again, _BIT["E"]).otherwise(0)).alias("failed"))


def positional_popcounts(words: np.ndarray) -> np.ndarray:
    """How many of the words have each of the 32 bits set."""
    total, weight = np.zeros(32, np.int64), 1
    while len(words):
        carries = [words[:0]]
        while (third := len(words) // 3) > 0:
            a, b, c = words[:third], words[third : 2 * third], words[2 * third : 3 * third]
            half = a ^ b
            carries.append((a & b) | (half & c))
            words = np.concatenate([half ^ c, words[3 * third :]])
        for word in words:
            total += weight * (word >> np.arange(32, dtype=np.uint32) & np.uint32(1)).astype(np.int64)
        words, weight = np.concatenate(carries), 2 * weight
    return total


def survivors(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """part, subset (a bit for each filter), and how many documents survive all its filters: n, good, toxic."""
    one = lambda name: F.coalesce(F.max((F.col(name) == 1).cast("int")), F.lit(0)).alias(name)
    marked = labels.groupBy("doc_id").agg(one("quality"), one("toxic"))
    labelled = rows.join(marked, "doc_id", "left").select("part", "failed", (2 * F.coalesce("quality", F.lit(0)) + F.coalesce("toxic", F.lit(0))).alias("label"))

    def summed(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            parts = column(batch, "part").dictionary_encode()
            key = parts.indices.to_numpy(zero_copy_only=False).astype(np.int64) * 4 + column(batch, "label").to_numpy()
            order = np.argsort(key, kind="stable")
            words = _WORD[column(batch, "failed").to_numpy()[order]]
            groups, cuts = np.unique(key[order], return_index=True)
            counts = [positional_popcounts(w) for w in np.split(words, cuts[1:])]
            yield pa.record_batch(
                [parts.dictionary.take(pa.array(groups >> 2)), pa.array((groups & 3).astype(np.int32)), pa.array(counts, pa.list_(pa.int64()))],
                ["part", "label", "counts"],
            )

    sums = labelled.mapInArrow(summed, "part string, label int, counts array<long>").select("part", "label", F.posexplode("counts").alias("subset", "n"))
    of = lambda bit, name: F.sum(F.when(F.col("label").bitwiseAND(bit) != 0, F.col("n")).otherwise(0)).alias(name)
    return sums.groupBy("part", "subset").agg(F.sum("n").alias("n"), of(2, "good"), of(1, "toxic"))


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, order of the filters and step: kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley."""
    orders = ["".join(p) for p in permutations(FILTERS)]
    step = np.tile(np.arange(len(FILTERS)), len(orders))
    bit = np.array([_BIT[name] for order in orders for name in order])
    before = np.array([sum(_BIT[x] for x in order[:i]) for order in orders for i in range(len(FILTERS))])
    after = before | bit
    names = np.repeat(orders, len(FILTERS)).tolist()
    schema = pa.schema([("part", pa.string()), ("filter_order", pa.string()), ("step", pa.int32())] + [(c, pa.int64()) for c in ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")])

    def steps(batches):
        for batch in batches:
            for row in batch.to_pylist():
                n, good, toxic = np.array([list(x.values())[1:] for x in row["sums"]], np.int64).T
                removed = n[before] - n[after]
                over_orders = {b: removed[bit == b].sum() for b in _BIT.values()}
                found = [
                    n[after],
                    removed,
                    n[0] - n[bit] - removed,
                    n[(_SUBSETS - 1) & ~bit] - n[_SUBSETS - 1],
                    good[before] - good[after],
                    toxic[before] - toxic[after],
                    np.array([over_orders[b] for b in bit]),
                ]
                yield pa.RecordBatch.from_arrays([pa.array([row["part"]] * len(names)), pa.array(names), pa.array((step + 1).astype(np.int32)), *map(pa.array, found)], schema=schema)

    sums = survivors(failures(docs), labels)
    whole = sums.groupBy("part").agg(F.array_sort(F.collect_list(F.struct("subset", "n", "good", "toxic"))).alias("sums"))
    return whole.mapInArrow(steps, "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, good_lost long, toxic_lost long, shapley long")


ORACLE = r"""
WITH words AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), failing AS (
  SELECT doc_id, part,
         (len(w) < 100)::INT AS a,
         (100 * len(list_distinct(w)) < 80 * len(w))::INT AS b,
         (100 * len(regexp_extract_all(t, '[A-Z]')) > 10 * length(t))::INT AS c,
         regexp_matches(t, '[#$%&*|]')::INT AS d,
         coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false)::INT AS e
  FROM words
), marked AS (
  SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id
), kinds AS (
  SELECT part, ['A', 'B', 'C', 'D', 'E'] AS names, [a, b, c, d, e] AS fails, count(*) AS n,
         sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic
  FROM failing LEFT JOIN marked USING (doc_id) GROUP BY ALL
), letters AS (
  SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x
), orders AS (
  SELECT p.x || q.x || r.x || s.x || u.x AS filter_order
  FROM letters p, letters q, letters r, letters s, letters u
  WHERE len(list_distinct([p.x, q.x, r.x, s.x, u.x])) = 5
), steps AS (
  SELECT filter_order, unnest([1, 2, 3, 4, 5]) AS step FROM orders
), fate AS (
  SELECT part, filter_order, step, n, good, toxic,
         fails[list_position(names, filter_order[step])] = 1 AS fails_it,
         list_sum(list_transform(string_split(left(filter_order, step - 1), ''), lambda x: coalesce(fails[list_position(names, x)], 0))) > 0 AS earlier,
         list_sum(fails) = 1 AS once
  FROM kinds, steps
), counted AS (
  SELECT part, filter_order, step,
         sum(CASE WHEN NOT fails_it AND NOT coalesce(earlier, false) THEN n ELSE 0 END) AS kept,
         sum(CASE WHEN fails_it AND NOT coalesce(earlier, false) THEN n ELSE 0 END) AS removed,
         sum(CASE WHEN fails_it AND coalesce(earlier, false) THEN n ELSE 0 END) AS redundant,
         sum(CASE WHEN fails_it AND once THEN n ELSE 0 END) AS unique_fails,
         sum(CASE WHEN fails_it AND NOT coalesce(earlier, false) THEN good ELSE 0 END) AS good_lost,
         sum(CASE WHEN fails_it AND NOT coalesce(earlier, false) THEN toxic ELSE 0 END) AS toxic_lost
  FROM fate GROUP BY ALL
)
SELECT part, filter_order, step::INT AS step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
       unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
       sum(removed) OVER (PARTITION BY part, filter_order[step])::BIGINT AS shapley
FROM counted
"""
