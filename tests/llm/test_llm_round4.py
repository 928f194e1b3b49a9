"""Rounds of the components, batch sizes of the Jaccard join, merged ends and bulk cache of the alignment."""

import random

import numpy as np
import pyarrow as pa

from plyscope.llm import alignment, graph
from plyscope.llm import jaccard as jc
from plyscope.llm.common import arrow_rows
from plyscope.llm.wordcache import Generations


def _labels(spark, pairs):
    return {r.node: r.label for r in graph.components(spark.createDataFrame(pairs, "a long, b long")).collect()}


def test_stars_need_no_round(spark, monkeypatch):
    made, keep = [], graph.written
    monkeypatch.setattr(graph, "written", lambda df: made.append(1) or keep(df))
    assert _labels(spark, [(1, i) for i in range(2, 40)] + [(50, 51), (52, 50), (7, 7)]) == {
        **{i: 1 for i in range(1, 40)}, **{i: 50 for i in (50, 51, 52)}}
    assert len(made) == 1


def test_components_of_chains_and_random_graphs(spark):
    rng = random.Random(4)
    pairs = [(i, i + 1) for i in range(100, 130)] + [(rng.randrange(60), rng.randrange(60)) for _ in range(45)]
    root = {n: n for p in pairs if p[0] != p[1] for n in p}
    for _ in root:
        for a, b in pairs:
            if a != b:
                root[a] = root[b] = min(root[a], root[b])
    assert _labels(spark, pairs) == root


def test_batches_are_bounded_inside_only(spark):
    name, sizes = "spark.sql.execution.arrow.maxRecordsPerBatch", []
    before = spark.conf.get(name)

    def count(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows], pa.int64())], ["n"])
    with arrow_rows(spark, 100):
        sizes = [r.n for r in spark.range(1000, numPartitions=2).mapInArrow(count, "n long").collect()]
    assert max(sizes) <= 100 and sum(sizes) == 1000 and spark.conf.get(name) == before


def test_the_join_runs_with_bounded_batches(spark, monkeypatch):
    seen, real = [], jc._groups
    monkeypatch.setattr(jc, "_groups", lambda *a: seen.append(int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch"))) or real(*a))
    docs = spark.createDataFrame([(1, "a b c d e f g"), (2, "a b c d e f g"), (3, "x")], "doc_id long, text string")
    assert sorted((r.doc_id, r.component_id) for r in jc.jaccard_groups(docs, 4, 85, 100).collect()) == [(1, 1), (2, 1), (3, 3)]
    assert seen == [jc.BATCH] and jc.BATCH <= 1000


def test_merged_ends():
    rng = np.random.default_rng(3)
    for n in (0, 1, 5, 200):
        a, b = (np.unique(rng.integers(0, 2 * n + 1, n)) for _ in range(2))
        common, ends = alignment.merged(a, b)
        assert common.tolist() == sorted(set(a.tolist()) & set(b.tolist())) and ends.tolist() == sorted(set(a.tolist()) | set(b.tolist()))


def test_cache_taken_in_bulk_is_bounded_and_right():
    cache, rng = Generations(len, 10), random.Random(2)
    for _ in range(200):
        some = list({"x" * rng.randrange(1, 90) for _ in range(rng.randrange(1, 25))})
        new = [p for p in some if p not in cache]
        cache.take(new, map(len, new))
        assert len(cache) <= 10 and len(cache.old) <= 10
        assert all(len(p) == n <= 64 for held in (cache, cache.old) for p, n in held.items())
