"""Quality classifier with hierarchical empirical Bayes (operator 2).

A document's own evidence is a logistic classifier over whole-text statistics (byte classes, word
repetition, line shapes), fitted in numpy on a bounded sample of labelled rows that are not held out.
Sites then add what the corpus says about them, through grouped aggregation over all documents:

- host posterior: Beta prior around the global mean of the document probabilities, whose strength
  comes from the spread of the host means (method of moments);
- path posterior: the same one level down, around the host's posterior mean.

A sparse host therefore stays near the global mean, and a sparse path near its host. The final score
adds the path's log-odds, relative to the global ones, to the document's own; the document's own
probability is left out of its site's sums, so that it is not counted twice.

Results: null host or path: the empty name. Null or empty text: scored like any other text, from its
statistics (all zero). Rows are never joined by id, so repeated rows, ties and null ids are answered
each on its own. Without labelled rows of both classes the classifier gives the prior (0.5), and
nothing is rejected. Empty documents give an empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plyscope.llm import textops as tx
from plyscope.llm.common import TEXT_ROWS, arrow_rows, held_out, prepare, written

#: labelled rows used for fitting, at most (chosen by a hash of the id); about 200 bytes each
SAMPLE = 20_000
FEATURES = 20
_KINDS = {"upper": range(65, 91), "lower": range(97, 123), "digit": range(48, 58), "beyond": range(128, 256),
          "space": (32,), "line": (10,), "stop": (44, 46, 59, 58, 63), "bang": (33,), "pipe": (124,),
          "mark": [b for b in (*range(35, 44), 47, *range(60, 63), 64, *range(91, 97), 123, 125, 126)]}
_MASK = np.zeros((256, len(_KINDS)))
for _i, _members in enumerate(_KINDS.values()):
    _MASK[list(_members), _i] = 1


def features(col: pa.Array) -> np.ndarray:
    """Statistics of each whole text, one row each."""
    out = []
    for i, j, buf, offs in tx.slices(col):
        _, starts, ends, h, at = tx.words(buf, offs, tx.SPACED)
        for r in range(j - i):
            own = buf[offs[r]:offs[r + 1]]
            if not len(own):
                out.append(np.zeros(FEATURES))
                continue
            share = np.bincount(own, minlength=256) @ _MASK / len(own)
            hashes = h[at[r]:at[r + 1]]
            n = max(1, len(hashes))
            lens = (ends - starts)[at[r]:at[r + 1]]
            counts = np.sort(np.unique(hashes, return_counts=True)[1])[::-1] if len(hashes) else np.ones(1)
            pairs = tx.shingles(hashes, 2)
            fours = tx.shingles(hashes, 4)
            out.append(np.concatenate((share, [
                math.log1p(len(own)), math.log1p(len(hashes)), lens.mean() if len(lens) else 0.0,
                lens.std() if len(lens) else 0.0, len(counts) / n, counts[0] / n,
                len(np.unique(pairs)) / max(1, len(pairs)), len(np.unique(fours)) / max(1, len(fours)),
                float((lens == 1).mean()) if len(lens) else 0.0, share[7] + share[8] + share[9] > 0.02])))
    return np.array(out).reshape(-1, FEATURES)


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 30) -> dict:
    """Ridge logistic regression by Newton steps, on standardized features, with balanced weights
    undone in the intercept (so probabilities follow the labels' rate)."""
    mean, std = x.mean(0), x.std(0) + 1e-9
    z = np.c_[np.clip((x - mean) / std, -8, 8), np.ones(len(x))]
    w = np.zeros(z.shape[1])
    reg = np.full(z.shape[1], ridge)
    reg[-1] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p) + 1e-6)[:, None]).T @ z + np.diag(reg), z.T @ (y - p) - reg * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return {"mean": mean, "std": std, "w": w}


def predict(model: dict, x: np.ndarray) -> np.ndarray:
    if model is None:
        return np.full(len(x), 0.5)
    z = np.c_[np.clip((x - model["mean"]) / model["std"], -8, 8), np.ones(len(x))]
    return 1 / (1 + np.exp(-np.clip(z @ model["w"], -15, 15)))


def _score(keep: list[str], text_col: str, shared):
    def run(batches):
        for batch in batches:
            p = predict(shared.value, features(batch.column(text_col))) if batch.num_rows else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], pa.array(p, pa.float64())],
                                             [*keep, "__evidence"])
    return run


def _featured(batches):
    for batch in batches:
        x = features(batch.column("text"))
        yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in ("doc_id", "quality", "h")],
                                          pa.array(list(x), pa.list_(pa.float64()))], ["doc_id", "quality", "h", "x"])


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> dict | None:
    """The document classifier, from at most ``sample`` labelled rows outside the held-out fold; of the
    rows that share an id, the one with the least text hash."""
    own = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
    own = own.filter(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out())
    own = own.groupBy("doc_id").agg(F.max("quality").alias("quality"))
    chosen = own.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    # at most ``sample`` ids, so they are broadcast and no text is shuffled
    got = (texts.join(F.broadcast(chosen), "doc_id").select("doc_id", "quality", F.xxhash64("text").alias("h"), "text")
           .mapInArrow(_featured, "doc_id long, quality int, h long, x array<double>")
           .groupBy("doc_id", "quality").agg(F.min_by("x", "h").alias("x")).select("quality", "x").toPandas())
    if got["quality"].nunique() < 2:
        return None
    return fit_logistic(np.stack(got["x"].to_numpy()), got["quality"].to_numpy(float))


def _strength(mean, var, noise):
    """Beta prior strength from the spread of group means beyond their sampling noise; bounded, so
    that a corpus without site differences leaves sites at their prior."""
    spread = F.greatest(var - noise, F.lit(1e-6))
    return F.least(F.greatest(mean * (1 - mean) / spread - 1, F.lit(1.0)), F.lit(1e4))


def _pool(stats: DataFrame) -> tuple[float, float, float]:
    """(mean, between-group variance, mean sampling noise) of groups with sums n, s, q."""
    m = F.col("s") / F.col("n")
    got = stats.agg(F.sum("s") / F.sum("n"), F.var_pop(m),
                    F.avg(F.greatest(F.col("q") / F.col("n") - m * m, F.lit(0.0)) / F.col("n"))).first()
    return tuple(0.5 if v is None and i == 0 else (v or 0.0) for i, v in enumerate(got))


def score_quality(docs: DataFrame, labels: DataFrame, host_col: str = "source", path_col: str = "lang",
                  threshold: float = 0.5, sample: int = SAMPLE, keep_columns: list[str] | None = None) -> DataFrame:
    """``keep_columns`` of every row of ``docs`` plus evidence, host_mean, path_mean, quality_score and
    rejected (quality_score < threshold). Columns of ``docs`` under these names are not kept. The kept ones are written
    with the evidence, so that each text is scored once."""
    spark = docs.sparkSession
    prepare(spark)
    with arrow_rows(spark, TEXT_ROWS):
        model = fit(docs, labels, sample)
    shared = spark.sparkContext.broadcast(model)
    made = ("evidence", "host_mean", "path_mean", "quality_score", "rejected")
    keep = [c for c in (keep_columns or ["doc_id"]) if c not in made]
    sites = docs.select(*[F.col(c) for c in keep], F.coalesce(F.col("text"), F.lit("")).alias("__text"),
                        F.coalesce(F.col(host_col).cast("string"), F.lit("")).alias("__host"),
                        F.coalesce(F.col(path_col).cast("string"), F.lit("")).alias("__path"))
    fields = sites.select(*keep, "__host", "__path").schema
    with arrow_rows(spark, TEXT_ROWS):
        scored = written(sites.mapInArrow(_score([*keep, "__host", "__path"], "__text", shared), _ddl(fields, "__evidence")))
    # posteriors: a row per path, which is small and written once
    sums = (F.count("*").alias("n"), F.sum("__evidence").alias("s"), F.sum(F.col("__evidence") ** 2).alias("q"))
    paths = written(scored.groupBy("__host", "__path").agg(*sums))
    hosts = paths.groupBy("__host").agg(F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("q").alias("q"))
    mean, host_var, host_noise = _pool(hosts)
    _, path_var, path_noise = _pool(paths)
    mu = F.lit(min(max(mean, 1e-3), 1 - 1e-3))
    host_k = _strength(mu, F.lit(host_var), F.lit(host_noise))
    path_k = _strength(mu, F.lit(path_var), F.lit(path_noise))
    site = paths.join(hosts.select("__host", F.col("n").alias("hn"), F.col("s").alias("hs")), "__host").select(
        F.col("__host").alias("h"), F.col("__path").alias("p"), "n", "s", "hn", "hs")
    site = written(site)
    # the document's own probability is taken out of both sums
    own = F.col("__evidence")
    host_mean = (host_k * mu + F.col("hs") - own) / (host_k + F.col("hn") - 1)
    path_mean = (path_k * F.col("host_mean") + F.col("s") - own) / (path_k + F.col("n") - 1)
    logit = lambda c: F.log(c / (1 - c))
    safe = lambda c: F.least(F.greatest(c, F.lit(1e-6)), F.lit(1 - 1e-6))
    out = scored.join(site, (scored["__host"] == site["h"]) & (scored["__path"] == site["p"]), "left")
    out = out.withColumn("host_mean", safe(host_mean)).withColumn("path_mean", safe(path_mean))
    odds = logit(safe(own)) + logit(F.col("path_mean")) - logit(mu)
    score = 1 / (1 + F.exp(-odds))
    return out.select(*[F.col(f"`{c}`") for c in keep], own.alias("evidence"), "host_mean", "path_mean",
                      score.alias("quality_score"), (score < threshold).alias("rejected"))


def _ddl(schema, extra: str):
    from pyspark.sql import types as T
    return T.StructType([*schema.fields, T.StructField(extra, T.DoubleType())])
