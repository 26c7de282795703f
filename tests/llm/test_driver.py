"""What operators leave on the driver: it keeps every plan that ran, so jobs and collected rows count there."""

from __future__ import annotations

import random
import uuid

import numpy as np
import pytest
from pyspark import cloudpickle

from lakewright.llm import jaccard, toxicity
from lakewright.llm.components import components


def jobs_of(spark, work):
    """What ``work`` returns and how many jobs it ran."""
    group = f"jobs-{uuid.uuid4().hex}"
    spark.sparkContext.setJobGroup(group, "counted")
    try:
        found = work()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        spark.sparkContext.setLocalProperty("spark.job.description", None)
    return found, len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


def test_components_of_stars_take_no_round(spark):
    """The driver keeps every plan that ran: edges that are stars already must not be joined again."""
    stars = [(k, 10 * (k // 10)) for k in range(200)] + [(5000, 4000)]
    made, jobs = jobs_of(spark, lambda: components(spark.createDataFrame(stars, "a long, b long")))
    assert {r.node: r.root for r in made.collect()} == {k: 10 * (k // 10) for k in range(200)} | {5000: 4000, 4000: 4000}
    assert jobs <= 5
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_components_by_chance(spark):
    """Random edges, repeated, with loops, nulls and either way round, against a plain union."""
    rng = random.Random(3)
    edges = [(rng.randrange(-300, 300), rng.randrange(-300, 300)) for _ in range(260)]
    edges += [(b, a) for a, b in edges[:40]] + edges[:10] + [(None, 1), (2, None), (9, 9)]
    root = {}

    def find(i):
        root.setdefault(i, i)
        while root[i] != i:
            i = root[i]
        return i

    for a, b in edges:
        if a is not None and b is not None and a != b:
            a, b = sorted((find(a), find(b)))
            root[b] = a
    found = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert len(found) == len(root) and {r.node: r.root for r in found} == {i: find(i) for i in root}


def test_toxic_words_are_counted_once(spark):
    """Both kinds of features come from one query, and no row object is made for each on the driver."""
    rng = random.Random(5)
    words = [f"word{k}" for k in range(60)]
    rows = [(k, " ".join(rng.choices(words, k=12)) + (" vile filth." if k % 3 == 0 else " good day.")) for k in range(90)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(k, int(k % 3 == 0)) for k in range(90)], "doc_id long, toxic int")
    collected, collect = [], type(docs).collect
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(type(docs), "collect", lambda self: collected.append(self.columns) or collect(self))
        model = toxicity.learn(docs, labels)
    assert ["feature", "odds"] not in collected
    assert len(model.features) > 4 and (np.diff(model.features.astype(object)) > 0).all()
    scores = {r.doc_id: r.score for r in toxicity.score_texts(docs, model).collect()}
    assert min(scores[k] for k in scores if k % 3 == 0) > max(scores[k] for k in scores if k % 3)


def test_order_of_columns_travels_packed(spark, monkeypatch):
    """What goes along with the tasks that take the sets is far smaller than the counters."""
    docs = spark.createDataFrame([(k, f"some words of text number {k} and more of it") for k in range(20)], "doc_id long, text string")
    order, sent = jaccard.column_order(docs), []
    assert order.nbytes == 4 * jaccard.COUNTERS and order.sum() > 0
    monkeypatch.setattr(type(docs), "mapInArrow", lambda self, work, schema: sent.append(len(cloudpickle.dumps(work))))
    jaccard.sets(docs, order)
    assert sent and sent[0] < order.nbytes / 4


def test_one_of_each_component_stays_by_few_jobs(spark):
    """Families of like texts that link only through others, copies, equal ids, nulls and texts without words."""
    rng = random.Random(11)
    rows = []
    for family in range(12):
        words = [f"w{family}x{k}" for k in range(60)]
        for step in range(6):  # each differs from the next in two words, the last from the first in ten
            words[step * 7], words[step * 7 + 1] = f"n{family}s{step}", f"m{family}s{step}"
            rows.append((len(rows), " ".join(words)))
    rows += [(1000 + k, rows[k][1]) for k in range(0, 72, 9)] + [(None, rows[3][1]), (5, "alone with some other words here"), (5, "alone too but in different words"), (2000, None), (2001, " "), (None, "")]
    rng.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept, jobs = jobs_of(spark, lambda: sorted((r.doc_id is None, r.doc_id or 0, r.text or "") for r in jaccard.keep_one(docs, n=4, percent=70).collect()))
    found = jaccard.similar_texts(docs, n=4, percent=70)
    first = {}
    for r in found.where("root is not null").collect():
        first[r.root] = min(first.get(r.root, (True, 0, 0)), (r.doc_id is None, r.doc_id or 0, r.tie))
    assert len(kept) == len(first) + 3
    assert sorted(x[:2] for x in kept) == sorted([x[:2] for x in first.values()] + [(False, 2000), (False, 2001), (True, 0)])
    assert jobs <= 155
