"""How far the sources of a language differ in the terms they use, all in whole numbers.

A term is a run of letters and of characters beyond ASCII, with A-Z in lower case. A
language keeps the terms that at least ``LEAST_DOCS`` of its documents hold: V of them. A
group (a source of a language, or all of a language) with N occurrences of kept terms
gives a term that occurs c times there ``p = 1 + floor(SCALE * (c + 1) / (N + V))``. The
distance of p from q is ``floor((p - q)^2 / q)``.

Two sources are compared over all kept terms without a row for each of them. If neither
had any term, every one would add the same. What a term adds beside that, if just one of
the two sources has it, depends on its count there only: terms of a source are counted by
count. What is left, for terms that both have, comes from a frequent-pattern tree: the
nonzero counts of a term, ordered by source, are a path, and terms with equal beginnings
share nodes. A node knows how many terms pass it, and each pair of a node and one above it
is worked out once for all of them. Paths that are equal are first counted, then dealt by
range and sorted, so that the paths of one subtree follow each other; a task lays the tree
of some thousand paths at a time, which bounds its memory.

The larger a source, the nearer to the root it stands. Numbers stay below 2^63 as long as a
language keeps less than 10^9 terms.

Null texts, languages and sources are empty strings; the empty language and the empty
source are a group like others. A source without kept terms has its pairs, too. Rows count
one by one, whatever their id. A language with one source has no pairs, one without kept
terms has pairs of distance 0. Extra columns are not looked at. An empty table gives no
rows.
"""

from __future__ import annotations

from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakewright.functions.skew import salted_join
from lakewright.llm.words import column, text_bytes
from lakewright.session import materialise

LEAST_DOCS = 3
SCALE = 1_000_000_000
#: Ranks of terms that are reported for each source.
TOP = 200
#: Entries that a task counts before it hands them on, and pairs of nodes worked out at a time.
HELD = 400_000
PAIRS = 1 << 20

#: What splits terms becomes a blank, A-Z become lower case.
_TERMS = bytes(b if b > 127 or chr(b).islower() else b + 32 if chr(b).isupper() else 32 for b in range(256))


def occurrences(docs: DataFrame) -> DataFrame:
    """lang, source, term, n (occurrences) and docs (documents that hold it), counted within a task; a key may have several rows."""
    schema = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()), ("docs", pa.int64())])

    def rows(found):
        for (lang, source), (n, held) in found.items():
            terms = pa.array(list(n), pa.binary()).cast(pa.string())
            sums = (pa.array(np.fromiter(x, np.int64, len(n))) for x in (n.values(), map(held.__getitem__, n)))
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(n)), pa.array([source] * len(n)), terms, *sums], schema=schema)

    def counted(batches):
        found, size = defaultdict(lambda: (Counter(), Counter())), 0
        for batch in batches:
            data, at = text_bytes(column(batch, "text"))
            groups = zip(column(batch, "lang").to_pylist(), column(batch, "source").to_pylist(), strict=True)
            for group, a, b in zip(groups, at.tolist(), at[1:].tolist(), strict=False):
                words = data[a:b].tobytes().translate(_TERMS).split()
                n, held = found[group]
                size -= len(n)
                n.update(words)
                held.update(set(words))
                size += len(n)
                if size > HELD:
                    yield from rows(found)
                    found.clear()
                    size = 0
        yield from rows(found)

    return docs.mapInArrow(counted, "lang string, source string, term string, n long, docs long")


def scaled(n: str, total: str) -> Column:
    """p of a count among ``total``, which is N + V."""
    return F.expr(f"1 + (cast({n} + 1 AS decimal(19, 0)) * {SCALE}) div greatest({total}, 1)")


def distance(p: str, q: str) -> Column:
    return F.expr(f"(({p} - {q}) * ({p} - {q})) div {q}")


def corrections(no: np.ndarray, p: np.ndarray, z: np.ndarray, at: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """From sorted paths of one language, flat from ``at`` on: source, other source, and what the terms of both add to their distance.

    ``no`` is the item's source, ``p`` its share, ``z`` the share of a term that the source lacks, ``times`` how many terms take a path.
    """
    size, many = np.diff(at), np.append(0, np.cumsum(times))
    apart = lambda p, q: (p - q) * (p - q) // q
    shared, found = np.append(False, np.ones(max(0, len(size) - 1), bool)), []

    def summed(keys, values):
        kinds, where = np.unique(np.concatenate(keys), return_inverse=True)
        sums = np.zeros(len(kinds), np.int64)
        np.add.at(sums, where, np.concatenate(values))
        return kinds, sums

    for depth in range(int(size.max(initial=0))):
        # Is the node of a path at this depth the one of the path before?
        here = size > depth
        both = np.flatnonzero(shared & here & np.append(False, here[:-1]))
        shared = np.zeros(len(size), bool)
        mine, last = at[both] + depth, at[both - 1] + depth
        shared[both] = (no[mine] == no[last]) & (p[mine] == p[last])
        ends = np.append(np.flatnonzero(~shared), len(size))
        nodes = np.flatnonzero(here & ~shared)
        passing = many[ends[np.searchsorted(ends, nodes) + 1]] - many[nodes]
        step = max(1, PAIRS // max(1, depth))
        for i in range(0, len(nodes) if depth else 0, step):
            node, m = at[nodes[i : i + step]] + depth, passing[i : i + step, None]
            above = node[:, None] - np.arange(1, depth + 1)
            node = np.broadcast_to(node[:, None], above.shape)
            keys, values = [], []
            for a, b in ((above, node), (node, above)):
                extra = apart(p[a], p[b]) - apart(p[a], z[b]) - apart(z[a], p[b]) + apart(z[a], z[b])
                keys.append((no[a] << 32 | no[b]).ravel())
                values.append((m * extra).ravel())
            found.append(summed(keys, values))
    if not found:
        return (np.empty(0, np.int64),) * 3
    kinds, sums = summed(*zip(*found, strict=True))
    return kinds >> 32, kinds & 0xFFFFFFFF, sums


def shared_terms(paths: DataFrame) -> DataFrame:
    """lang, no, other and value: what terms of both sources add. ``paths``: lang, path (structs of no, p, z) and times."""

    def laid(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            lang, path = column(batch, "lang"), column(batch, "path")
            items, at = path.flatten(), path.offsets.to_numpy() - path.offsets[0].as_py()
            no, p, z = (items.field(k).to_numpy().astype(np.int64) for k in range(3))
            times = column(batch, "times").to_numpy()
            code = lang.dictionary_encode().indices.to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(code)) + 1).tolist(), batch.num_rows]
            for a, b in zip(cuts, cuts[1:], strict=False):
                found = corrections(no, p, z, at[a : b + 1], times[a:b])
                yield pa.record_batch([pa.array([lang[a].as_py()] * len(found[0]), pa.string()), pa.array(found[0].astype(np.int32)), pa.array(found[1].astype(np.int32)), pa.array(found[2])], ["lang", "no", "other", "value"])

    dealt = paths.repartitionByRange("lang", "path").sortWithinPartitions("lang", "path")
    return dealt.mapInArrow(laid, "lang string, no int, other int, value long")


def audit(docs: DataFrame) -> DataFrame:
    """lang, source, part (pair or term), item (a source or a term), value and rank."""
    docs = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")), "text")
    counts = occurrences(docs).groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    held = counts.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("of_lang"), F.collect_list(F.struct("source", "n")).alias("of_sources"))
    terms = materialise(held.where(F.col("docs") >= LEAST_DOCS).drop("docs"), "terms")
    entries = terms.select("lang", "term", "of_lang", F.size("of_sources").alias("sources"), F.explode("of_sources").alias("of")).select("*", "of.*").drop("of")

    langs = terms.groupBy("lang").agg(F.count("*").alias("v"), F.sum("of_lang").alias("n_lang"))
    sizes = entries.groupBy("lang", "source").agg(F.sum("n").alias("n_source"))
    groups = docs.select("lang", "source").distinct().join(sizes, ["lang", "source"], "left").join(langs, "lang", "left").na.fill(0, ["v", "n_lang", "n_source"])
    groups = groups.withColumns({"of_source": F.col("n_source") + F.col("v"), "of_all": F.col("n_lang") + F.col("v")}).withColumn("none", F.lit(0))
    by_size = Window.partitionBy("lang").orderBy(F.desc("n_source"), "source")
    groups = materialise(groups.select("lang", "source", "v", "of_source", "of_all", scaled("none", "of_source").alias("z"), F.row_number().over(by_size).alias("no")), "groups")

    shares = salted_join(entries, groups, ["lang", "source"], spread_by=["term"])
    shares = shares.select("lang", "term", "source", "sources", "no", "z", scaled("n", "of_source").alias("p"), scaled("of_lang", "of_all").alias("q"))

    other = groups.select("lang", F.col("no").alias("other"), F.col("z").alias("z_other"))
    kinds = shares.groupBy("lang", "no", "z", "p").agg(F.count("*").alias("times"))
    met = salted_join(kinds, other, ["lang"], spread_by=["no", "p"]).where("no <> other")
    either = met.groupBy("lang", "no", "other").agg(
        F.sum(F.col("times") * (distance("p", "z_other") - distance("z", "z_other"))).alias("mine"),
        F.sum(F.col("times") * (distance("z_other", "p") - distance("z_other", "z"))).alias("theirs"),
    )
    paths = shares.where("sources > 1").groupBy("lang", "term").agg(F.array_sort(F.collect_list(F.struct("no", "p", "z"))).alias("path"))
    paths = paths.groupBy("lang", "path").agg(F.count("*").alias("times"))

    names = groups.select("lang", F.col("source").alias("item"), F.col("no").alias("other"), F.col("z").alias("z_other"))
    pairs = groups.join(names, "lang").where("no <> other")
    parts = [
        pairs.select("lang", "no", "other", "source", "item", (F.col("v") * distance("z", "z_other")).alias("value")),
        either.select("lang", "no", "other", F.col("mine").alias("value")),
        either.select("lang", F.col("other").alias("no"), F.col("no").alias("other"), F.col("theirs").alias("value")),
        shared_terms(paths),
    ]
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part, allowMissingColumns=True)
    pairs = whole.groupBy("lang", "no", "other").agg(F.max("source").alias("source"), F.max("item").alias("item"), F.sum("value").alias("value"))

    best = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value", F.row_number().over(best).alias("rank"))
    special = shares.where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), distance("p", "q").alias("value"))
    special = special.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= TOP)
    return pairs.unionByName(special)


ORACLE = r"""
WITH held AS (
  SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS found
  FROM documents
), words AS (
  SELECT row, lang, source, unnest(found) AS term FROM held
), kept AS (
  SELECT lang, term, count(*)::HUGEINT AS c FROM words GROUP BY ALL HAVING count(DISTINCT row) >= 3
), langs AS (
  SELECT lang, count(*)::HUGEINT AS v, sum(c)::HUGEINT AS n FROM kept GROUP BY ALL
), counts AS (
  SELECT lang, source, term, count(*)::HUGEINT AS c FROM words SEMI JOIN kept USING (lang, term) GROUP BY ALL
), sizes AS (
  SELECT lang, source, sum(c)::HUGEINT AS n FROM counts GROUP BY ALL
), sources AS (
  SELECT DISTINCT lang, source FROM held
), shares AS (
  SELECT s.lang, s.source, k.term, coalesce(o.c, 0) AS c,
         1 + (1000000000 * (coalesce(o.c, 0) + 1)) // (coalesce(z.n, 0) + l.v) AS p,
         1 + (1000000000 * (k.c + 1)) // (l.n + l.v) AS q
  FROM sources s JOIN kept k USING (lang) JOIN langs l USING (lang)
  LEFT JOIN sizes z ON z.lang = s.lang AND z.source = s.source
  LEFT JOIN counts o ON o.lang = s.lang AND o.source = s.source AND o.term = k.term
), pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), all_pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(p.value, 0) AS value
  FROM sources a JOIN sources b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
), terms AS (
  SELECT lang, source, 'term' AS part, term AS item, ((p - q) * (p - q)) // q AS value FROM shares WHERE c > 0 AND p > q
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
  FROM (SELECT * FROM all_pairs UNION ALL SELECT * FROM terms)
)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INT AS rank FROM ranked WHERE part = 'pair' OR rank <= 200
"""
