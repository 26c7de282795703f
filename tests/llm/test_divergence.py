"""The pattern tree and the whole audit against plain counting."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from lakewright.llm import divergence

SCHEMA = "doc_id long, text string, lang string, source string, term string, n int, value string"


def brute(rows):
    docs = [((r[2] or ""), (r[3] or ""), [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", r[1] or "")]) for r in rows]
    groups = {(lang, source) for lang, source, _ in docs}
    out = set()
    for lang in {lang for lang, _ in groups}:
        mine = [d for d in docs if d[0] == lang]
        held = Counter(w for d in mine for w in set(d[2]))
        kept = [w for w in held if held[w] >= 3]
        counts = defaultdict(Counter)
        for _, source, words in mine:
            counts[source].update(w for w in words if held[w] >= 3)
        every = sum(counts.values(), Counter())
        share = lambda c, w, v=len(kept): 1 + 1_000_000_000 * (c[w] + 1) // (sum(c.values()) + v)
        apart = lambda p, q: (p - q) * (p - q) // q
        sources = [s for g, s in groups if g == lang]
        for s in sources:
            found = [(sum(apart(share(counts[s], w), share(counts[t], w)) for w in kept), t) for t in sources if t != s]
            special = [(apart(share(counts[s], w), share(every, w)), w) for w in kept if counts[s][w] and share(counts[s], w) > share(every, w)]
            for part, items in (("pair", found), ("term", special)):
                ranked = sorted(items, key=lambda x: (-x[0], x[1].encode()))
                out |= {(lang, s, part, item, value, rank) for rank, (value, item) in enumerate(ranked, 1) if part == "pair" or rank <= 200}
    return out


def found(docs):
    rows = [tuple(r) for r in divergence.audit(docs).collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def drawn(seed):
    draw = random.Random(seed)
    words = [f"{a}{b}" for a in "abcdefghijklé" for b in "xyzABÜ"]
    rows = []
    for i in range(120):
        source = draw.choice(["s1", "s1", "s1", "s2", "s3", "s4", None, ""])
        text = draw.choice([None, "", " ".join(draw.choices(words, [1 / (k + 1) for k in range(len(words))], k=draw.randrange(60))), "a1b2_c [d]\t{e}"])
        rows.append((i, text, draw.choice(["en", "en", "de", None]), source, "t", 1, "v"))
    return [*rows, (999, "lonely", "xx", "one", None, None, None), (998, None, "yy", "p", None, None, None), (997, None, "yy", "q", None, None, None)]


@pytest.mark.parametrize("seed", range(3))
def test_audit(spark, seed):
    rows = drawn(seed)
    assert found(spark.createDataFrame(rows, SCHEMA).repartition(4)) == brute(rows)


def test_more_terms_than_ranks_and_small_tasks(spark, monkeypatch):
    draw = random.Random(4)
    words = ["".join(draw.choices("abcdefgh", k=4)) for _ in range(700)]
    rows = [(i, " ".join(draw.choices(words, k=150)), "en", f"s{i % 3}", None, None, None) for i in range(60)]
    monkeypatch.setattr(divergence, "HELD", 50)
    monkeypatch.setattr(divergence, "PAIRS", 3)
    assert found(spark.createDataFrame(rows, SCHEMA)) == brute(rows)


def test_odd_tables(spark):
    long = "Wide words walk while winter waits. " * 20_000
    rows = [(i, long, "en", s, None, None, None) for i, s in enumerate(["a", "a", None, "b"])] + [(None, "wide wide", "en", "c", None, None, None), (None, None, None, None, None, None, None)]
    assert found(spark.createDataFrame(rows, SCHEMA)) == brute(rows)
    assert divergence.audit(spark.createDataFrame([], SCHEMA)).collect() == []


@pytest.mark.parametrize("seed", range(5))
def test_tree(seed):
    """One node and ancestor at a time, and each path by itself."""
    draw = random.Random(seed)
    rare = [draw.randrange(1, 50) for _ in range(7)]
    paths = sorted({tuple((no, draw.choice([60, 70, 10**6])) for no in range(7) if draw.random() < 0.6) for _ in range(200)} - {()})
    times = [draw.randrange(1, 4) for _ in paths]
    want = Counter()
    apart = lambda p, q: (p - q) * (p - q) // q
    for path, m in zip(paths, times, strict=True):
        for s, p in path:
            for t, q in path:
                if s != t:
                    want[s, t] += m * (apart(p, q) - apart(p, rare[t]) - apart(rare[s], q) + apart(rare[s], rare[t]))
    flat = [x for path in paths for x in path]
    no, p = (np.array([x[k] for x in flat], np.int64) for k in (0, 1))
    at = np.cumsum([0, *map(len, paths)])
    a, b, value = divergence.corrections(no, p, np.array(rare)[no], at, np.array(times))
    assert dict(zip(zip(a.tolist(), b.tolist(), strict=True), value.tolist(), strict=True)) == dict(want)
    assert all(len(x) == 0 for x in divergence.corrections(no[:0], no[:0], no[:0], at[:1], np.array([], np.int64)))
