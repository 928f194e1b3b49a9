"""Approximate nearest neighbours by balanced posting lists (operator 3).

Index. Centroids are fitted in numpy on a bounded sample by splitting clusters until each holds a
small share, which keeps the posting lists balanced. Every vector is posted to its nearest centroid
and, near a boundary, to the other centroids that are almost as near (``REPLICAS`` at most). Equal
vectors are posted once, with the smallest ids that share them.

Search. Centroids are found by a best-first search in an in-memory graph that links each to its
nearest others. Lists are searched whose centroid is at most 1 + eps times as far as the nearest one.
eps is the smallest value that reaches ``RECALL`` against brute force within the sample, and grows up
to searching every list if it must. Long lists and their queries are dealt into blocks of bounded
size, so a list that attracts a third of all vectors is searched by many tasks.

Distances are exact Euclidean distances in double precision on the original vectors. Vectors that are
null, zero, or hold null or non-finite components take no part, nor do those whose dimension is not
the most common one. A row repeated with the same id and vector is one row; rows that share an id
are all "own" to a query of that id. Fewer than k candidates: all of them. An empty table: no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from plyscope.llm.common import bounded_sample, prepare, written

K = 10
#: vectors the index is fitted on, at most
SAMPLE = 20_000
#: vectors that a list should hold, and centroids at most (they are broadcast: 8192 of 64 doubles are 4 MB)
LIST, CENTROIDS = 256, 2_048
REPLICAS, CLOSURE = 4, 0.05
RECALL = 0.97
LINKS, POOL = 16, 64
BLOCK = 4_096
QUERY_BLOCK = 1_024


def split_clusters(x: np.ndarray, most: int, count: int, rng) -> np.ndarray:
    """Centroids of clusters of at most ``most`` points: the largest cluster is split by 2-means until
    all are small or there are ``count``."""
    groups = [np.arange(len(x))]
    done: list[np.ndarray] = []
    while groups and len(groups) + len(done) < count:
        groups.sort(key=len)
        own = groups.pop()
        if len(own) <= most:
            done.append(own)
            continue
        c = x[rng.choice(own, 2, replace=False)].copy()
        for _ in range(8):
            gap = x[own] @ (c[1] - c[0]) - (c[1] @ c[1] - c[0] @ c[0]) / 2
            # each side keeps at least a quarter, which balances the lists
            right = gap > np.clip(0.0, *np.quantile(gap, (0.25, 0.75)))
            if right.all() or not right.any():
                right = np.arange(len(own)) % 2 == 0
            c = np.stack([x[own[~right]].mean(0), x[own[right]].mean(0)])
        groups += [own[~right], own[right]]
    return np.stack([x[g].mean(0) for g in groups + done])


class CentroidGraph:
    """Centroids, each linked to its nearest others and to a few at random; best-first search."""

    def __init__(self, centres: np.ndarray, seed: int = 3):
        rng = np.random.default_rng(seed)
        self.c = centres
        self.norm = (centres ** 2).sum(1)
        n = len(centres)
        near = np.empty((n, min(LINKS, n)), np.int64)
        for a in range(0, n, 512):
            d = self.norm - 2 * centres[a:a + 512] @ centres.T
            near[a:a + 512] = np.argsort(d, axis=1)[:, :near.shape[1]]
        self.links = np.concatenate([near, rng.integers(0, n, (n, 4))], axis=1)
        self.entry = rng.permutation(n)[:min(n, 8)]

    def search(self, q: np.ndarray, pool: int) -> tuple[np.ndarray, np.ndarray]:
        """The nearest centroids found for each row of ``q``, nearest first: (ids, squared distances)."""
        n, pool = len(self.c), min(pool, len(self.c))
        b = len(q)
        qn = (q ** 2).sum(1)
        seen = np.zeros((b, n), bool)
        ids = np.tile(self.entry, (b, 1))
        seen[:, self.entry] = True
        dist = np.maximum(self.norm[ids] - 2 * q @ self.c[self.entry].T + qn[:, None], 0)
        open_ = np.ones(ids.shape, bool)
        rows = np.arange(b)
        while True:
            best = np.where(open_, dist, np.inf)
            pick = best.argmin(1)
            live = np.isfinite(best[rows, pick])
            if not live.any():
                break
            r = rows[live]
            open_[r, pick[live]] = False
            nxt = self.links[ids[r, pick[live]]]
            fresh = ~seen[r[:, None], nxt]
            # a centroid linked twice from one node is taken once
            order = np.sort(nxt, axis=1)
            if (order[:, 1:] == order[:, :-1]).any():
                for i in range(nxt.shape[1]):
                    fresh[:, i] &= ~(nxt[:, :i] == nxt[:, i:i + 1]).any(1)
            seen[r[:, None], nxt] = True
            d = np.full((b, nxt.shape[1]), np.inf)
            got = self.norm[nxt] - 2 * np.einsum("rld,rd->rl", self.c[nxt], q[r]) + qn[r][:, None]
            d[r] = np.where(fresh, np.maximum(got, 0), np.inf)
            new = np.zeros((b, nxt.shape[1]), np.int64)
            new[r] = nxt
            ids, dist = np.concatenate([ids, new], 1), np.concatenate([dist, d], 1)
            open_ = np.concatenate([open_, np.isfinite(d)], 1)
            if ids.shape[1] > pool:
                top = np.argpartition(dist, pool - 1, axis=1)[:, :pool]
                ids, dist, open_ = (np.take_along_axis(v, top, 1) for v in (ids, dist, open_))
        order = np.argsort(dist, axis=1)
        return np.take_along_axis(ids, order, 1), np.take_along_axis(dist, order, 1)

    def postings(self, x: np.ndarray) -> list[np.ndarray]:
        ids, dist = self.search(x, POOL // 2)
        take = dist[:, :REPLICAS] <= dist[:, :1] * (1 + CLOSURE) ** 2
        return [i[t] for i, t in zip(ids[:, :REPLICAS], take)]

    def probes(self, q: np.ndarray, eps: float) -> list[np.ndarray]:
        if eps == np.inf:
            return [np.arange(len(self.c))] * len(q)
        ids, dist = self.search(q, len(self.c) if eps > 0.15 else 4 * POOL)
        return [i[d <= (d[0] * (1 + eps) ** 2)] for i, d in zip(ids, dist)]


def fit_index(x: np.ndarray, total: int, k: int = K, seed: int = 3) -> tuple[CentroidGraph, float, float]:
    """(centroid graph, eps, recall within the sample)."""
    rng = np.random.default_rng(seed)
    lists = int(np.clip(total // LIST, 1, min(CENTROIDS, max(1, len(x) // 8))))
    graph = CentroidGraph(split_clusters(x, max(1, len(x) // lists), lists, rng))
    members: list[list[int]] = [[] for _ in graph.c]
    for a in range(0, len(x), 1024):
        for i, own in enumerate(graph.postings(x[a:a + 1024])):
            for c in own:
                members[c].append(a + i)
    where = [np.array(m, np.int64) for m in members]
    asked = rng.choice(len(x), min(len(x), 200), replace=False)
    true = []
    for q in asked:
        d = ((x - x[q]) ** 2).sum(1)
        d[q] = np.inf
        true.append(set(np.argsort(d)[:k].tolist()))
    recall = 1.0
    for eps in (0.02, 0.05, 0.1, 0.15, 0.2, 0.25, 0.3, 0.4, 0.5, 0.75, np.inf):
        found = 0
        for q, t, lists_ in zip(asked, true, graph.probes(x[asked], eps)):
            found += len(t & set(np.concatenate([where[c] for c in lists_]).tolist()))
        recall = found / max(1, sum(map(len, true)))
        if recall >= RECALL:
            break
    return graph, eps, recall


def _post(shared):
    def run(batches):
        graph = shared.value[0]
        for pdf in batches:
            for a in range(0, len(pdf), 512):
                part = pdf.iloc[a:a + 512]
                own = graph.postings(np.stack(part["vec"].to_numpy()))
                yield part.assign(list=[o.astype(np.int32) for o in own])
    return run


def _probe(shared):
    def run(batches):
        graph, eps = shared.value
        for pdf in batches:
            for a in range(0, len(pdf), 128):
                part = pdf.iloc[a:a + 128]
                own = graph.probes(np.stack(part["vec"].to_numpy()), eps)
                yield part.assign(list=[o.astype(np.int32) for o in own])
    return run


def _search_block(k: int):
    def run(queries: pd.DataFrame, posted: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(queries) and len(posted):
            x, reps = np.stack(posted["vec"].to_numpy()), posted["rep"].to_numpy()
            for q, v in zip(queries["rep"].to_numpy(), queries["vec"].to_numpy()):
                d = np.sqrt(((x - v) ** 2).sum(1))
                if len(d) > k:
                    edge = np.partition(d, k - 1)[k - 1]
                    at = np.flatnonzero(d <= edge)
                else:
                    at = np.arange(len(d))
                at = at[np.lexsort((reps[at], d[at]))][:k]
                out.append(pd.DataFrame({"query": q, "rep": reps[at], "score": d[at]}))
        return pd.concat(out) if out else pd.DataFrame({"query": [], "rep": [], "score": []}).astype(
            {"query": "int64", "rep": "int64", "score": "float64"})
    return run


def valid_vectors(rows: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(vec_id, vec) with double components, of the vectors that take part, each once."""
    vec = F.col(vec_col).cast("array<double>")
    ok = F.forall("vec", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))) & F.exists("vec", lambda v: v != 0)
    rows = rows.select(F.col(id_col).cast("long").alias("vec_id"), vec.alias("vec")).filter(F.col("vec_id").isNotNull() & F.col("vec").isNotNull())
    rows = rows.filter(F.coalesce(ok, F.lit(False)))
    sizes = rows.groupBy(F.size("vec").alias("d")).count().orderBy(F.desc("count"), "d").first()
    return rows.filter(F.size("vec") == (sizes["d"] if sizes else 0)).dropDuplicates(["vec_id", "vec"])


def nearest(rows: DataFrame, k: int = K, every: int = 100, id_col: str = "vec_id", vec_col: str = "embedding",
            sample: int = SAMPLE) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the ``k`` nearest found of each row whose id is
    divisible by ``every``, among all rows but its own; ties to the smaller id."""
    spark = rows.sparkSession
    prepare(spark)
    rows = written(valid_vectors(rows, id_col, vec_col))
    # one row for equal vectors: its k + 1 smallest ids (the limit is pushed below the shuffle)
    same = W.partitionBy("vec").orderBy("vec_id")
    groups = written(rows.withColumn("n", F.row_number().over(same)).filter(F.col("n") <= k + 1)
                     .groupBy("vec").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")).withColumn("rep", F.col("ids")[0]))
    total = groups.count()
    out = "query_id long, rank int, vec_id long, score double"
    if not total:
        return spark.createDataFrame([], out)
    x = np.stack(bounded_sample(groups.select("rep", "vec"), sample, "rep").toPandas()["vec"].to_numpy())
    graph, eps, _ = fit_index(x, total, k)
    shared = spark.sparkContext.broadcast((graph, eps))

    posted = written(groups.select("rep", "vec").mapInPandas(_post(shared), "rep long, vec array<double>, list array<int>")
                     .select("rep", "vec", F.explode("list").alias("list")))
    asked = rows.filter(F.col("vec_id") % every == 0)
    named = asked.join(groups.select("rep", F.col("vec").alias("v")), F.col("vec") == F.col("v")).select("vec_id", "rep")
    named = written(named)
    lookups = groups.join(named.select("rep").distinct(), "rep", "left_semi").select("rep", "vec")
    probed = written(lookups.mapInPandas(_probe(shared), "rep long, vec array<double>, list array<int>")
                     .select("rep", "vec", F.explode("list").alias("list")))
    # blocks of bounded size: a list's postings in parts, its queries in parts, each part meets each
    parts = (posted.groupBy("list").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("pp"))
             .join(probed.groupBy("list").agg(F.ceil(F.count("*") / QUERY_BLOCK).cast("int").alias("qp")), "list"))
    part = lambda n: F.pmod(F.xxhash64("rep"), F.col(n)).cast("int")
    every_ = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = probed.join(parts, "list").withColumn("q", part("qp")).withColumn("p", every_("pp"))
    right = posted.join(parts, "list").withColumn("p", part("pp")).withColumn("q", every_("qp"))
    keys, cols = ["list", "p", "q"], ["list", "p", "q", "rep", "vec"]
    hits = (left.select(cols).groupBy(*keys).cogroup(right.select(cols).groupBy(*keys))
            .applyInPandas(_search_block(k + 1), "query long, rep long, score double")).distinct()
    best = W.partitionBy("query").orderBy("score", "rep")
    top = written(hits.withColumn("n", F.row_number().over(best)).filter(F.col("n") <= k + 1).drop("n"))
    ids = top.join(groups.select("rep", "ids"), "rep").select("query", "score", F.explode("ids").alias("vec_id"))
    mine = named.select(F.col("vec_id").alias("query_id"), F.col("rep").alias("query"))
    final = W.partitionBy("query_id", "query").orderBy("score", "vec_id")
    return (mine.join(ids, "query").filter(F.col("query_id") != F.col("vec_id"))
            .withColumn("rank", F.row_number().over(final)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
