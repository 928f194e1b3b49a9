"""Language identification by averaged hashed subword embeddings (operator 5).

A text's subwords are the byte runs of 2 to 4 lower-cased letters inside its words, word edges
included. Each is hashed to a row of an embedding matrix; a text is the average of its rows, and a
linear softmax over it gives the languages. Embeddings and softmax are trained together by stochastic
gradient descent in numpy, on a bounded sample of distinct texts that are not held out, dealt evenly
over the languages (a rare one is taken whole); texts are also seen as random subsets of their subwords, so that short texts are learned too. A temperature fitted on a part
of the sample kept aside calibrates the scores, and the rejection threshold is the least score above
which that part is right in ``PRECISION`` of the cases (both with the languages' shares among all
distinct texts). Prediction reads every whole text.

Results: null text, or no letter: ``und``, score 0, rejected. Without any labelled row: ``und`` for
all. Repeated rows are answered each on its own; an empty table gives an empty result. Other columns
are never read.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plyscope.llm import textops as tx
from plyscope.llm.common import even_sample, held_out, prepare, written

#: distinct texts used for training, at most (chosen by a hash of the text); some kB each on the driver
SAMPLE = 4_000
BUCKETS = 1 << 15
DIM = 16
SIZES = (2, 3, 4)
PRECISION = 0.995
_LETTERS = tx.byte_class(lambda b: 97 <= b <= 122 or b >= 0x80)
_ODD = [np.uint32(x) for x in (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F)]
_WORDISH = re.compile(r"[^\W\d_]")


def has_letter(text: str) -> bool:
    return any(m.group().isalpha() for m in _WORDISH.finditer(text))


def subwords(col: pa.Array):
    """(rows, hashes of each size, row borders in them) per slice; a space stands for each word edge."""
    shift = np.uint32(32 - (BUCKETS.bit_length() - 1))
    for i, j, buf, offs in tx.slices(col):
        low = tx._LOWER[buf]
        low = np.where(_LETTERS[low], low, np.uint8(32))
        low = np.insert(low, offs, np.uint8(32))
        offs = offs + np.arange(len(offs))
        letter = low != 32
        ids, rows = [], []
        for size in SIZES:
            n = len(low) - size + 1
            if n <= 0:
                continue
            good = letter[1:n + 1].copy() if size > 2 else letter[:n] | letter[1:n + 1]
            for k in range(2, size - 1):
                good &= letter[k:n + k]
            h = np.full(n, size * 0x51, np.uint32)
            for k in range(size):
                h = (h ^ low[k:n + k]) * _ODD[k]
                h ^= h >> np.uint32(15)
            at = np.flatnonzero(good)
            ids.append((h[at] * _ODD[0] >> shift).astype(np.int32))
            rows.append(np.searchsorted(at, offs))
        yield i, j, ids, rows


def _bags(batches):
    for batch in batches:
        langs, bags, counts = batch.column("lang").to_pylist(), [], []
        for i, j, ids, rows in subwords(batch.column("text")):
            for r in range(j - i):
                u, c = np.unique(np.concatenate([x[b[r]:b[r + 1]] for x, b in zip(ids, rows)]), return_counts=True)
                bags.append(u.astype("<i4").tobytes())
                counts.append(c.astype("<f4").tobytes())
        # as bytes: lists would become Python numbers on the driver
        yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(bags, pa.binary()),
                                          pa.array(counts, pa.binary())], ["lang", "ids", "counts"])


def _forward(e, w, b, ids, counts, lens):
    ends = np.cumsum(lens)[:-1]
    at = np.concatenate(([0], ends))
    weight = counts / np.repeat(np.maximum(np.add.reduceat(counts, at), 1e-9), lens)
    x = np.add.reduceat(e[ids] * weight[:, None], at, axis=0)
    z = x @ w + b
    z -= z.max(1, keepdims=True)
    p = np.exp(z)
    return x, weight, p / p.sum(1, keepdims=True)


def train(bags: list, counts: list, labels: np.ndarray, classes: int, epochs: int = 6, batch: int = 32,
          rate: float = 2.0, seed: int = 7, weight_of: np.ndarray | None = None) -> dict:
    """Embeddings, softmax, temperature and threshold, by SGD on cross entropy. ``weight_of`` a class: texts
    that one of its sampled texts stands for, when temperature and threshold are fitted."""
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(bags))
    kept = order[:max(1, len(bags) // 5)] if len(bags) >= 20 else order
    used = order[len(kept):] if len(bags) >= 20 else order
    e = rng.normal(0, 0.1, (BUCKETS, DIM)).astype(np.float32)
    w, b = np.zeros((DIM, classes), np.float32), np.zeros(classes, np.float32)
    w += rng.normal(0, 0.1, w.shape)
    steps, done = epochs * -(-len(used) // batch), 0
    for _ in range(epochs):
        used = rng.permutation(used)
        for k in range(0, len(used), batch):
            rows = used[k:k + batch]
            ids, cnt, lens = [], [], []
            for r in rows:
                u, c = bags[r], counts[r]
                if rng.random() < 0.5 and len(u) > 8:  # a shorter view of the text
                    m = rng.choice(len(u), max(4, int(len(u) * rng.random() ** 3)), replace=False)
                    u, c = u[m], c[m]
                ids.append(u)
                cnt.append(c)
                lens.append(len(u))
            ids, cnt, lens = np.concatenate(ids), np.concatenate(cnt), np.array(lens)
            x, weight, p = _forward(e, w, b, ids, cnt, lens)
            p[np.arange(len(rows)), labels[rows]] -= 1
            lr = rate * (1 - done / steps)
            back = (p @ w.T).astype(np.float32)
            np.add.at(e, ids, -lr * np.repeat(back, lens, axis=0) * weight[:, None])
            w -= lr / len(rows) * x.T @ p
            b -= lr / len(rows) * p.sum(0)
            done += 1
    logit = []
    for r in kept:
        x = (e[bags[r]] * (counts[r] / counts[r].sum())[:, None]).sum(0)
        logit.append(x @ w + b)
    logit, truth = np.array(logit), labels[kept]
    stands_for = np.ones(len(truth)) if weight_of is None else weight_of[truth]

    def scaled(t):
        z = logit / t
        p = np.exp(z - z.max(1, keepdims=True))
        return p / p.sum(1, keepdims=True)
    temps = np.geomspace(0.2, 10, 60)
    losses = [-(stands_for * np.log(scaled(t)[np.arange(len(truth)), truth] + 1e-12)).sum() for t in temps]
    t = float(temps[int(np.argmin(losses))])
    p = scaled(t)
    score, right = p.max(1), p.argmax(1) == truth
    down = np.argsort(-score)
    precision = np.cumsum((right * stands_for)[down]) / np.cumsum(stands_for[down])
    good = np.flatnonzero(precision >= PRECISION)
    threshold = float(score[down][good[-1]]) if len(good) else 1.0
    return {"e": e, "w": w / t, "b": b / t, "threshold": threshold}


def fit(docs: DataFrame, sample: int = SAMPLE) -> dict | None:
    rows = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out())
    rows = rows.select("text", F.col("lang").alias("stratum"), F.xxhash64("text").alias("key"))
    chosen, sizes = even_sample(rows, sample)
    # at most ``sample`` texts, so their hashes are broadcast and copies meet in the partial aggregate
    texts = rows.join(F.broadcast(written(chosen)), ["stratum", "key"]).select("text", F.col("stratum").alias("lang")).distinct()
    got = texts.mapInArrow(_bags, "lang string, ids binary, counts binary").toPandas()
    got = got[got["ids"].map(len) > 0].sort_values(["lang", "ids"], kind="stable")
    if not len(got):
        return None
    names = sorted(got["lang"].unique())
    labels = got["lang"].map({n: i for i, n in enumerate(names)}).to_numpy()
    stands_for = np.array([sizes[n] for n in names]) / np.bincount(labels)
    model = train([np.frombuffer(x, "<i4") for x in got["ids"]], [np.frombuffer(x, "<f4") for x in got["counts"]], labels, len(names),
                  weight_of=stands_for)
    return model | {"names": names}


def _predict(shared):
    def run(batches):
        model = shared.value
        names = np.array([*(model["names"] if model else []), "und"], object)
        classes = len(names) - 1
        # where languages are few, subwords carry their share of each logit at once
        direct = classes <= DIM
        rows_of = (model["e"] @ model["w"]).astype(np.float32) if model and direct else model["e"] if model else None
        for batch in batches:
            best, score = [], []
            col = batch.column("text")
            for i, j, ids, rows in subwords(col) if model else ():
                total = np.zeros((j - i, rows_of.shape[1]))
                n = np.zeros(j - i)
                for x, b in zip(ids, rows):
                    gone = np.vstack((np.zeros((1, rows_of.shape[1])), np.cumsum(rows_of[x], axis=0, dtype=np.float64)))
                    total += gone[b[1:]] - gone[b[:-1]]
                    n += np.diff(b)
                z = total / np.maximum(n, 1)[:, None]
                z = (z if direct else z @ model["w"]) + model["b"]
                p = np.exp(z - z.max(1, keepdims=True))
                p /= p.sum(1, keepdims=True)
                none = np.array([not has_letter(t) for t in col.slice(i, j - i).to_pylist()], bool)
                best.append(np.where(none, classes, p.argmax(1)))
                score.append(np.where(none, 0.0, p.max(1)))
            n = batch.num_rows
            best = np.concatenate(best) if best else np.full(n, classes)
            score = np.concatenate(score) if score else np.zeros(n)
            reject = (best == classes) | (score < (model["threshold"] if model else 1))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(names[best], pa.string()), pa.array(score, pa.float64()),
                 pa.array(reject, pa.bool_())], ["doc_id", "lang_pred", "score", "rejected"])
    return run


def identify(docs: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, lang_pred, score, rejected (below the threshold)."""
    spark = docs.sparkSession
    prepare(spark)
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    shared = spark.sparkContext.broadcast(fit(base, sample))
    ddl = "doc_id long, lang_pred string, score double, rejected boolean"
    return base.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).mapInArrow(_predict(shared), ddl).select(
        "doc_id", held_out().alias("held_out"), "lang_pred", "score", "rejected")
