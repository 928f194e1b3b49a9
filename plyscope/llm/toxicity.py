"""Toxicity by weak supervision (operator 10).

Voters. Stems (words, and their first 4, 5, 6 and 8 bytes) that occur in labelled toxic documents
and hardly in clean ones form the lexicon, all of them; each distinct text of the sample counts once, so
copies do not make a text's own words common. It is dealt into ``LEXICONS`` lexicon voters by rank. Four
pattern voters look at the text's shape: many distinct lexicon stems, repeated lexicon stems, shouting
capitals, and exclamation marks. A voter fires or it does not.

Label model. The firing patterns are counted over all documents (2^16 patterns at most, so their table
is bounded); expectation-maximization estimates each voter's firing rate among toxic and clean
documents, with the documents that carry a usable label clamped to it. Correlations of voters given
the class are estimated from the same counts, and a voter's evidence is divided by how much of it its
correlated voters repeat.

Classifier. A ridge logistic regression on lexicon stems (those beyond ``STEMS`` share columns), voters and shape is trained on the label
model's posteriors for a bounded sample of documents, and scores every whole text.

Labels of held-out rows (crc32 of the id modulo 5 is 0) are never read. Results: null text: empty;
an empty text gets the score of no evidence. Without labelled rows of both classes the lexicon is
empty and every score is the prior. Repeated rows are answered each on its own; an id with several
labels counts as toxic if one says so; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plyscope.llm import textops as tx
from plyscope.llm.common import bounded_sample, held_out, prepare, written
from plyscope.llm.decontaminate import HashSet
from plyscope.llm.quality import fit_logistic, predict

#: labelled rows read for the lexicon, per class at most
SAMPLE = 10_000
#: documents whose posterior trains the classifier, at most
TRAINED = 12_000
#: classifier columns of lexicon stems, at most; more stems share them by rank
STEMS = 400
LEXICONS, PATTERNS = 12, 4
STEM_BYTES = (4, 5, 6, 8)
_MUL = np.uint64(0x9E3779B97F4A7C15)


def stems(low: np.ndarray, starts: np.ndarray, ends: np.ndarray, h: np.ndarray):
    """(word number, stem hash) of each word and of its leading bytes."""
    who, out = [np.arange(len(h))], [h]
    for k in STEM_BYTES:
        at = np.flatnonzero(ends - starts > k)
        x = np.full(len(at), k, np.uint64)
        first = starts[at]
        for b in range(k):
            x = tx.mix(x * _MUL + low[first + b])
        who.append(at)
        out.append(tx.mix(x + np.uint64(k)))
    return np.concatenate(who), np.concatenate(out)


def _text_stems(col: pa.Array):
    """Per slice: rows, bytes, offsets, row of each stem occurrence, stem hashes, words in each row."""
    for i, j, buf, offs in tx.slices(col):
        low, starts, ends, h, at = tx.words(buf, offs, tx.ALNUM)
        who, x = stems(low, starts, ends, h)
        yield i, j, buf, offs, np.searchsorted(at, who, side="right") - 1, x, np.diff(at)


def _stem_counts(batches):
    """Distinct (stem, documents with it) of a slice of documents."""
    for batch in batches:
        for _, _, _, _, row, x, _ in _text_stems(batch.column("text")):
            order = np.lexsort((row, x))
            row, x = row[order], x[order]
            first = np.concatenate(([True], (x[1:] != x[:-1]) | (row[1:] != row[:-1]))) if len(x) else np.zeros(0, bool)
            u, c = np.unique(x[first], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(tx.as_signed(u)), pa.array(c.astype(np.int64))], ["stem", "n"])


def learn_lexicon(toxic: DataFrame, clean: DataFrame, n_toxic: int, n_clean: int) -> np.ndarray:
    """Hashes of all stems that tell toxic documents from clean ones, the best separating first. Both
    tables hold distinct texts. Counts are compared in Spark, so that only those stems are collected."""
    least = max(2, n_toxic // 500)

    def counts(texts, name):
        return texts.mapInArrow(_stem_counts, "stem long, n long").groupBy("stem").agg(F.sum("n").alias(name))
    both = (counts(toxic, "t").filter(F.col("t") >= least).join(counts(clean, "c"), "stem", "left")
            .select("stem", ((F.col("t") + 0.1) / (n_toxic + 1)).alias("rate_t"),
                    ((F.coalesce("c", F.lit(0)) + 0.5) / (n_clean + 1)).alias("rate_c")))
    # at least twenty times as likely in toxic documents, with the clean count's uncertainty added
    apart = F.col("rate_t") / (F.col("rate_c") + F.sqrt(F.col("rate_c") / (n_clean + 1)))
    good = both.select("stem", apart.alias("apart")).filter(F.col("apart") > 20).toPandas()
    good = good.sort_values(["apart", "stem"], ascending=[False, True])
    return good["stem"].to_numpy(np.int64).view(np.uint64)


def _features(col: pa.Array, lexicon: np.ndarray):
    """Per slice: rows, stem occurrence counts (sparse: row, rank, count), voters, shape numbers."""
    hashes = HashSet(lexicon) if len(lexicon) else None
    rank = np.argsort(lexicon) if len(lexicon) else None
    for i, j, buf, offs, row, x, n_words in _text_stems(col):
        n = j - i
        if hashes is not None:
            at = hashes.where(x)
            row, which = row[at], rank[np.searchsorted(hashes.sorted, x[at])]
        else:
            row, which = np.zeros(0, np.int64), np.zeros(0, np.int64)
        cell, count = np.unique(row * max(1, len(lexicon)) + which, return_counts=True)
        r, s = cell // max(1, len(lexicon)), cell % max(1, len(lexicon))
        upper = np.concatenate(([0], np.cumsum((buf >= 65) & (buf <= 90))))
        bang = np.concatenate(([0], np.cumsum(buf == 33)))
        size = np.maximum(np.diff(offs), 1)
        shape = np.stack([np.diff(upper[offs]) / size, np.diff(bang[offs]) / size, np.log1p(n_words)], 1)
        votes = np.zeros((n, LEXICONS + PATTERNS), bool)
        votes[r, s % LEXICONS] = True
        votes[:, LEXICONS] = np.bincount(r, minlength=n) >= 3
        twice = np.zeros(n, bool)
        twice[r[count >= 2]] = True
        votes[:, LEXICONS + 1] = twice
        votes[:, LEXICONS + 2] = shape[:, 0] > 0.3
        votes[:, LEXICONS + 3] = shape[:, 1] > 0.01
        yield i, j, (r, s, count), votes, shape


_BITS = 1 << np.arange(LEXICONS + PATTERNS, dtype=np.int64)


def _votes(shared, keep):
    def run(batches):
        for batch in batches:
            parts = [v @ _BITS for _, _, _, v, _ in _features(batch.column("text"), shared.value)]
            got = np.concatenate(parts) if parts else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], pa.array(got)], [*keep, "votes"])
    return run


def label_model(votes: np.ndarray, count: np.ndarray, label: np.ndarray, rounds: int = 60) -> dict:
    """EM over firing patterns. ``label`` is 0, 1 or -1 (none); rows are distinct (votes, label)."""
    fired = ((votes[:, None] & _BITS) > 0).astype(float)
    m = fired.shape[1]
    weight = count.astype(float)
    known = label >= 0
    prior = float(np.clip((weight * (label == 1)).sum() / max(1.0, weight[known].sum()), 0.001, 0.999)) if known.any() else 0.5
    theta = np.stack([np.full(m, 0.02), np.full(m, 0.3)])
    theta[:, LEXICONS + 2:] = 0.05, 
    share = np.ones(m)
    for _ in range(rounds):
        odds = np.log(prior / (1 - prior)) + fired @ (share * np.log(theta[1] / theta[0])) \
            + (1 - fired) @ (share * np.log((1 - theta[1]) / (1 - theta[0])))
        post = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
        q = np.where(known, label, post)
        mass = np.stack([weight * (1 - q), weight * q])
        old = theta.copy()
        theta = (mass @ fired + [[0.5], [0.5]]) / (mass.sum(1, keepdims=True) + 1)
        theta = np.clip(theta, 1e-5, 1 - 1e-5)
        prior = float(np.clip(mass[1].sum() / max(mass.sum(), 1e-9), 1e-4, 1 - 1e-4))
        # correlations given the class: a voter's evidence is shared with those that repeat it
        repeat = np.zeros(m)
        for y in (0, 1):
            mean = theta[y]
            dev = fired - mean
            cov = (dev * mass[y][:, None]).T @ dev / max(mass[y].sum(), 1e-9)
            sd = np.sqrt(np.clip(np.diag(cov), 1e-9, None))
            rho = np.clip(cov / sd / sd[:, None], 0, 1)
            repeat = np.maximum(repeat, (rho ** 2).sum(1) - np.diag(rho) ** 2)
        share = 1 / (1 + repeat)
        if np.abs(theta - old).max() < 1e-6:
            break
    return {"theta": theta, "prior": prior, "share": share}


def posterior(model: dict, fired: np.ndarray) -> np.ndarray:
    t, s, p = model["theta"], model["share"], model["prior"]
    odds = np.log(p / (1 - p)) + fired @ (s * np.log(t[1] / t[0])) + (1 - fired) @ (s * np.log((1 - t[1]) / (1 - t[0])))
    return 1 / (1 + np.exp(-np.clip(odds, -30, 30)))


def _dense(n, cells, votes, shape, stems_n):
    """Classifier inputs: stems (at most ``STEMS`` columns) by their density classes, voters, shape."""
    r, s, count = cells
    stems_n = min(stems_n, STEMS)
    x = np.zeros((n, stems_n + votes.shape[1] + shape.shape[1] + 2))
    x[r, s % max(1, stems_n)] = 1.0
    x[:, stems_n:stems_n + votes.shape[1]] = votes
    x[:, stems_n + votes.shape[1]:-2] = shape
    x[:, -2] = np.minimum(np.bincount(r, minlength=n), 5)
    x[:, -1] = np.log1p(np.bincount(r, weights=count, minlength=n))
    return x


def _inputs(shared):
    def run(batches):
        lexicon = shared.value
        for batch in batches:
            for i, j, cells, votes, shape in _features(batch.column("text"), lexicon):
                x = _dense(j - i, cells, votes, shape, len(lexicon)).astype(np.float32)
                yield pa.RecordBatch.from_arrays([pa.array(votes @ _BITS), pa.array([v.tobytes() for v in x], pa.binary())], ["votes", "x"])
    return run


def _score(shared):
    def run(batches):
        lexicon, model, prior = shared.value
        for batch in batches:
            parts = [predict(model, _dense(j - i, cells, votes, shape, len(lexicon))) if model else np.full(j - i, prior)
                     for i, j, cells, votes, shape in _features(batch.column("text"), lexicon)]
            got = np.concatenate(parts) if parts else np.zeros(0)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(got, pa.float64())], ["doc_id", "score"])
    return run


def score_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   sample: int = SAMPLE, trained: int = TRAINED) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted (1 where score >= 0.5)."""
    spark = docs.sparkSession
    prepare(spark)
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    known = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
             .filter(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out())
             .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    known = written(known)
    sides = []
    for y in (1, 0):
        ids = written(bounded_sample(known.filter(F.col("toxic") == y).select("doc_id"), sample))
        # at most ``sample`` ids, so they are broadcast and no text is shuffled
        texts = written(base.join(F.broadcast(ids), "doc_id", "left_semi").select("text").distinct())
        sides.append((texts, texts.count()))
    (toxic, n_toxic), (clean, n_clean) = sides
    lexicon = learn_lexicon(toxic, clean, n_toxic, n_clean) if n_toxic and n_clean else np.zeros(0, np.uint64)
    shared = spark.sparkContext.broadcast(lexicon)

    patterns = (base.mapInArrow(_votes(shared, ["doc_id"]), "doc_id long, votes long").join(known, "doc_id", "left")
                .groupBy("votes", F.coalesce("toxic", F.lit(-1)).alias("label")).agg(F.count("*").alias("n"))).toPandas()
    model, prior = None, 0.5
    if len(patterns) and n_toxic and n_clean:
        lm = label_model(patterns["votes"].to_numpy(), patterns["n"].to_numpy(), patterns["label"].to_numpy())
        prior = lm["prior"]
        got = bounded_sample(base, trained, salt=11).select("text").mapInArrow(_inputs(shared), "votes long, x binary").toPandas()
        x = np.frombuffer(b"".join(got["x"]), np.float32).reshape(len(got), -1).astype(float)
        fired = ((got["votes"].to_numpy()[:, None] & _BITS) > 0).astype(float)
        model = fit_logistic(x, posterior(lm, fired))
    final = spark.sparkContext.broadcast((lexicon, model, prior))
    return base.mapInArrow(_score(final), "doc_id long, score double").select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
