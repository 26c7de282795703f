"""Survival words against plain counting, on drawn and on odd tables."""

from __future__ import annotations

import random
from collections import Counter
from itertools import permutations

import numpy as np
import pytest

from lakewright.llm import survival

SCHEMA = "doc_id long, text string, lang string, source string, failed int, part string, digest string"
SPACE = " \t\n\x0b\x0c\r"


def fails(rows):
    """The failed filters of each row, by the words of the contract."""
    texts = [r[1] or "" for r in rows]
    out = []
    for r, t in zip(rows, texts, strict=True):
        words, word = [], ""
        for ch in t + " ":
            if ch in SPACE:
                words += [word] if word else []
                word = ""
            else:
                word += ch
        bad = {"A"} if len(words) < 100 else set()
        bad |= {"B"} if 100 * len(set(words)) < 80 * len(words) else set()
        bad |= {"C"} if 100 * sum("A" <= c <= "Z" for c in t) > 10 * len(t) else set()
        bad |= {"D"} if any(c in "#$%&*|" for c in t) else set()
        if r[0] is not None and any(o[0] is not None and o[0] < r[0] and u == t for o, u in zip(rows, texts, strict=True)):
            bad |= {"E"}
        out.append(bad)
    return out


def brute(rows, labels):
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    failed = fails(rows)
    shapley, out = Counter(), {}
    for part in {r[2] or "" for r in rows}:
        mine = [(r[0], f) for r, f in zip(rows, failed, strict=True) if (r[2] or "") == part]
        for order in map("".join, permutations("ABCDE")):
            left = mine
            for step, name in enumerate(order, 1):
                gone = [x for x in left if name in x[1]]
                left = [x for x in left if name not in x[1]]
                out[part, order, step] = (
                    len(left),
                    len(gone),
                    sum(name in f for _, f in mine) - len(gone),
                    sum(f == {name} for _, f in mine),
                    sum(i in good for i, _ in gone),
                    sum(i in toxic for i, _ in gone),
                )
                shapley[part, name] += len(gone)
    return {k: (*v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def found(df):
    return {(r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley) for r in df.collect()}


def drawn(seed):
    draw = random.Random(seed)
    kinds = [" ".join(f"w{i}" for i in range(120)), "Ab " * 130, "x " * 99, "A b# " * 60, "é ü " * 70, "", None, "one\x0btwo\x85three", " ".join(f"Ü{i}" for i in range(100)), "UP " + "down " * 30]
    rows = [(draw.choice([*range(40), None]), draw.choice(kinds), draw.choice(["en", "de", "", None]), "s", 1, "p", "d") for _ in range(150)]
    return rows, [(draw.choice([*range(50), None]), draw.choice([0, 1, None]), draw.choice([0, 1, None])) for _ in range(60)]


@pytest.mark.parametrize("seed", range(3))
def test_audit(spark, seed):
    rows, labels = drawn(seed)
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    result = survival.audit(docs, marks)
    assert found(result) == brute(rows, labels)
    assert result.count() == 600 * len({r[2] or "" for r in rows})


def test_odd_tables(spark):
    long = "Wide words WALK while winter waits. " * 20_000
    rows = [(1, long, "en", None, None, None, None), (2, long, "en", None, None, None, None), (2, long, "fr", None, None, None, None), (None, None, None, None, None, None, None)]
    docs, none = spark.createDataFrame(rows, SCHEMA), spark.createDataFrame([], SCHEMA)
    marks = spark.createDataFrame([(1, 1, 1), (1, 0, 0), (2, 0, 1), (None, 1, 1)], "doc_id long, quality int, toxic int")
    assert found(survival.audit(docs, marks)) == brute(rows, marks.collect())
    assert found(survival.audit(docs, marks.limit(0))) == brute(rows, [])
    assert survival.audit(none, marks).collect() == []


def test_text_ids(spark):
    rows = [("b", "t", "en"), ("a", "t", "en"), ("c", "t", "fr"), (None, "t", "fr")]
    docs = spark.createDataFrame(rows, "doc_id string, text string, lang string")
    marks = spark.createDataFrame([("b", 1, 1)], "doc_id string, quality int, toxic int")
    assert found(survival.audit(docs, marks)) == brute(rows, [("b", 1, 1)])


@pytest.mark.parametrize("n", [0, 1, 2, 3, 7, 100, 5003])
def test_popcounts(n):
    words = np.random.default_rng(n).integers(0, 1 << 32, n, np.uint32)
    assert survival.positional_popcounts(words).tolist() == [int(sum(int(w) >> b & 1 for w in words)) for b in range(32)]
