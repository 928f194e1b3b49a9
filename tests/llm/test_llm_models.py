"""Operators 2, 3, 5 and 10: held-out accuracy, recall against brute force, and awkward rows."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm_fixtures import AWKWARD, awkward, clash, empty
from plyscope.llm import langid, neighbours, quality, toxicity
from plyscope.llm.common import even_sample, held_out, table

SF = "/root/testdata/sf0.01"
needs_data = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
LABELS = "doc_id long, quality int, toxic int"


def _known(df, spark, column, sf=SF):
    rows = df.join(table(spark, sf, "labels").select("doc_id", column), "doc_id").toPandas()
    return rows[rows[column].notna()]


# ---------------------------------------------------------------- operator 2

@needs_data
def test_quality_held_out_accuracy(spark):
    got = _known(quality.score_quality(table(spark, SF, "documents"), table(spark, SF, "labels"))
                 .withColumn("out", held_out()), spark, "quality")
    out = got[got["out"]]
    assert len(out) > 40 and (out["rejected"] == (out["quality"] == 0)).mean() >= 0.95
    clean = got[got["quality"] == 1]
    assert clean["rejected"].mean() <= 0.01


def test_quality_sites_shrink_toward_their_parents(spark, monkeypatch):
    """Evidence is fixed by the text here; posteriors follow the formula, leaving the row itself out."""
    p = {"good": 0.9, "bad": 0.1}
    monkeypatch.setattr(quality, "fit", lambda *a: None)

    def fake(keep, text_col, shared):
        import pyarrow as pa

        def run(batches):
            for b in batches:
                e = pa.array([p.get(t, 0.5) for t in b.column(text_col).to_pylist()], pa.float64())
                yield pa.RecordBatch.from_arrays([*[b.column(c) for c in keep], e], [*keep, "__evidence"])
        return run
    monkeypatch.setattr(quality, "_score", fake)
    rows = [(i, "bad" if i % 10 else "good", "spam", "/x") for i in range(200)]
    rows += [(1000 + i, "good" if i % 10 else "bad", "fine", "/y") for i in range(200)]
    rows += [(5000, "neither", "new", "/z"), (5001, "neither", None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    got = {r.doc_id: r for r in quality.score_quality(docs, spark.createDataFrame([], LABELS)).collect()}
    assert got[1].path_mean < 0.25 and got[1001].path_mean > 0.75
    mean = np.mean([p.get(r[1], 0.5) for r in rows])
    assert abs(got[5000].host_mean - mean) < 1e-6 and abs(got[5001].path_mean - mean) < 1e-6
    assert got[1].quality_score < got[1].evidence and got[1001].quality_score > got[1001].evidence


def test_quality_fits_one_row_per_labelled_id(spark, monkeypatch):
    rows = [(i, f"text number {i} " * (1 + i % 7)) for i in range(60)]
    rows += [(0, f"copy {k} of a repeated id") for k in range(300)]
    labels = [(i, i % 2, 0) for i in range(60)]
    seen = []
    monkeypatch.setattr(quality, "fit_logistic", lambda x, y: seen.append(len(x)))
    labels = spark.createDataFrame(labels, LABELS)
    quality.fit(spark.createDataFrame(rows, "doc_id long, text string"), labels)
    held = labels.filter(held_out()).count()
    assert seen == [60 - held]


def test_quality_awkward_rows(spark):
    none = spark.createDataFrame([], LABELS)
    out = quality.score_quality(awkward(spark), none)
    assert out.count() == len(AWKWARD) and out.filter("rejected").count() == 0
    assert quality.score_quality(empty(spark), none).count() == 0
    labels = spark.createDataFrame([(i, (i or 0) % 2, None) for i in (None, 3, 3, 4, 7, 8)], LABELS)
    assert quality.score_quality(awkward(spark), labels).filter("quality_score between 0 and 1").count() == len(AWKWARD)


# ---------------------------------------------------------------- operator 3

def _brute(x, ids, every, k):
    out = {}
    for q in np.flatnonzero(ids % every == 0):
        d = np.sqrt(((x - x[q]) ** 2).sum(1))
        keep = np.flatnonzero(ids != ids[q])
        best = keep[np.lexsort((ids[keep], d[keep]))][:k]
        out[int(ids[q])] = [(int(ids[b]), float(d[b])) for b in best]
    return out


@pytest.mark.parametrize("block,queries", [(neighbours.BLOCK, neighbours.QUERY_BLOCK), (150, 7)])
def test_neighbours_recall_and_exact_scores(spark, monkeypatch, block, queries):
    monkeypatch.setattr(neighbours, "BLOCK", block)
    monkeypatch.setattr(neighbours, "QUERY_BLOCK", queries)
    monkeypatch.setattr(neighbours, "LIST", 60)
    rng = np.random.default_rng(2)
    centres = rng.normal(0, 2, (12, 8))
    x = (centres[rng.integers(0, 12, 1500)] + rng.normal(0, 1, (1500, 8))).astype(np.float32).astype(float)
    x[300:800] = x[300]          # one vector that a third of all rows share
    ids = np.arange(1500) * 3
    rows = [(int(i), [float(v) for v in r], 0) for i, r in zip(ids, x)]
    rows += [(7, None, 0), (11, [0.0] * 8, 0), (13, [None, 1.0] * 4, 0), (14, [float("nan")] + [1.0] * 7, 0),
             (16, [float("inf")] + [1.0] * 7, 0), (17, [1.0, 2.0], 0), (None, [1.0] * 8, 0), rows[5], rows[0]]
    df = clash(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int"))
    got = {}
    for r in neighbours.nearest(df, every=50).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    want = _brute(x, ids, 50, 10)
    assert set(got) == set(want) and all(len(v) == 10 for v in got.values())
    hits = sum(len({a for a, _ in want[q]} & {a for a, _ in got[q]}) for q in want)
    assert hits / sum(map(len, want.values())) >= 0.9
    at = {int(i): r for i, r in zip(ids, x)}
    for q, found in got.items():
        assert all(abs(s - np.sqrt(((at[q] - at[v]) ** 2).sum())) < 1e-9 for v, s in found)
        assert found == sorted(found, key=lambda f: (f[1], f[0]))


def test_neighbours_few_or_no_rows(spark):
    ddl = "vec_id long, embedding array<float>, label int"
    assert neighbours.nearest(spark.createDataFrame([], ddl)).count() == 0
    two = spark.createDataFrame([(0, [1.0, 0.0], 0), (1, [0.0, 1.0], 0), (100, [1.0, 0.0], 0)], ddl)
    got = [(r.query_id, r.rank, r.vec_id) for r in neighbours.nearest(two).orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 100), (0, 2, 1), (100, 1, 0), (100, 2, 1)]


# ---------------------------------------------------------------- operator 5

@needs_data
def test_language_held_out_accuracy_and_inputs(spark):
    docs = table(spark, SF, "documents")
    got = langid.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").toPandas()
    out = got[got["held_out"]]
    assert len(out) > 100 and (out["lang_pred"] == out["lang"]).mean() >= 0.97
    assert got["score"].between(0, 1).all()
    kept = out[~out["rejected"]]
    assert len(kept) > 0.9 * len(out) and (kept["lang_pred"] == kept["lang"]).mean() >= 0.99
    # the held-out rows' languages are not learned from
    blind = docs.withColumn("lang", F.when(~held_out(), F.col("lang")))
    same = langid.identify(blind).toPandas()
    assert (same.sort_values("doc_id")["lang_pred"].to_numpy() == got.sort_values("doc_id")["lang_pred"].to_numpy()).all()


def test_language_rare_values_and_copies(spark):
    """A language with 40 of 4,040 rows beside a sample of 200, and a third of the rows copies of one text."""
    rng = np.random.default_rng(5)
    own = {"aa": "bdaeg", "bb": "kliom", "cc": "zxuyw"}

    def text(lang):
        return " ".join("".join(rng.choice(list(own[lang]), 5)) for _ in range(30))
    hot = text("aa")
    rows = [(i, hot if i % 3 == 0 else text("aa" if i % 2 else "bb"), "aa" if i % 2 or i % 3 == 0 else "bb") for i in range(4_000)]
    rows += [(4_000 + i, text("cc"), "cc") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = langid.identify(docs, sample=200).toPandas()
    truth = got["doc_id"].map({r[0]: r[2] for r in rows})
    for lang in own:
        assert (got[truth == lang]["lang_pred"] == lang).mean() >= 0.95, lang


def test_even_sample_is_even_and_bounded(spark):
    keys = spark.range(10_000).select(F.when(F.col("id") < 7, "rare").when(F.col("id") < 4_000, "some").otherwise("most")
                                      .alias("stratum"), F.col("id").alias("key"))
    chosen, sizes = even_sample(keys.unionByName(keys), 1_007)
    assert sizes == {"rare": 7, "some": 3_993, "most": 6_000}
    assert {r["stratum"]: r["count"] for r in chosen.groupBy("stratum").count().collect()} == {"rare": 7, "some": 500, "most": 500}


def test_language_awkward_rows(spark):
    got = {r.doc_id: r for r in langid.identify(awkward(spark)).collect()}
    assert got[1].lang_pred == got[2].lang_pred == got[4].lang_pred == got[5].lang_pred == "und"
    assert got[5].score == 0 and got[5].rejected and got[8].lang_pred in ("en", "de")
    assert langid.identify(empty(spark)).count() == 0
    unlabelled = langid.identify(awkward(spark).withColumn("lang", F.lit(None).cast("string")))
    assert {r.lang_pred for r in unlabelled.collect()} == {"und"}


# ---------------------------------------------------------------- operator 10

@needs_data
def test_toxicity_catches_toxic_and_leaves_clean(spark):
    """Some labelled documents have had all their words replaced by junk, so recall cannot be full."""
    sf = SF.replace("0.01", "0.1")
    got = _known(toxicity.score_toxicity(table(spark, sf, "documents"), table(spark, sf, "labels")), spark, "toxic", sf)
    out = got[got["held_out"]]
    toxic, clean = out[out["toxic"] == 1], out[out["toxic"] == 0]
    assert len(toxic) > 60 and toxic["predicted"].mean() >= 0.85 and clean["predicted"].mean() <= 0.01
    assert got[got["toxic"] == 0]["predicted"].mean() <= 0.002


def test_toxicity_held_out_labels_are_not_read(spark):
    rng = np.random.default_rng(4)
    insults = ["vexlorp", "grumbash", "snidfell", "plonkard"]
    rows, labels = [], []
    for i in range(400):
        w = [f"word{rng.integers(200)}" for _ in range(30)]
        if i % 5 == 0:
            w[int(rng.integers(30))] = insults[int(rng.integers(4))]
            w[int(rng.integers(30))] = insults[int(rng.integers(4))]
        rows.append((i, " ".join(w), "en", "s", 0))
        labels.append((i, 1, int(i % 5 == 0)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = toxicity.score_toxicity(clash(docs), spark.createDataFrame(labels, LABELS)).toPandas().sort_values("doc_id")
    truth = (got["doc_id"] % 5 == 0).astype(int)
    assert (got["predicted"] == truth).mean() >= 0.98
    turned = spark.createDataFrame(labels, LABELS).withColumn("toxic", F.when(held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    again = toxicity.score_toxicity(docs, turned).toPandas().sort_values("doc_id")
    assert np.allclose(again["score"].to_numpy(), got["score"].to_numpy())


@pytest.mark.parametrize("near", [False, True])
def test_toxicity_copies_do_not_crowd_out_the_lexicon(spark, near):
    """A third of the toxic rows are copies (or near copies) of one long text, whose words are no insults."""
    rng = np.random.default_rng(6)
    insults = ["vexlorp", "grumbash", "snidfell", "plonkard", "drubwick", "quagmuff", "yelkring", "zorbnit"]
    hot = [f"{chr(97 + i % 26)}{chr(97 + i // 26)}own{i}" for i in range(500)]
    rows, labels = [], []
    for i in range(600):
        w = [f"word{rng.integers(200)}" for _ in range(30)]
        toxic = i % 4 == 0
        if i % 12 == 0:
            w = [*hot, f"odd{i}"] if near else hot
        elif toxic:
            for k in rng.choice(30, 2, replace=False):
                w[k] = insults[int(rng.integers(8))]
        rows.append((i, " ".join(w)))
        labels.append((i, 1, int(toxic)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = toxicity.score_toxicity(docs, spark.createDataFrame(labels, LABELS)).toPandas()
    truth = got["doc_id"] % 4 == 0
    assert got[truth & (got["doc_id"] % 12 != 0)]["predicted"].mean() >= 0.95 and got[~truth]["predicted"].mean() <= 0.01


def test_label_model_finds_voters_accuracies():
    rng = np.random.default_rng(8)
    m = toxicity.LEXICONS + toxicity.PATTERNS
    y = rng.random(20_000) < 0.15
    hit, false = rng.uniform(0.3, 0.8, m), rng.uniform(0.005, 0.05, m)
    fired = rng.random((20_000, m)) < np.where(y[:, None], hit, false)
    fired[:, 1] = fired[:, 0]     # a voter that only repeats another
    votes, count = np.unique(fired @ toxicity._BITS, return_counts=True)
    got = toxicity.label_model(votes, count, np.full(len(votes), -1))
    assert np.abs(got["theta"][1][2:] - hit[2:]).max() < 0.08 and abs(got["prior"] - 0.15) < 0.03
    assert got["share"][1] < 0.7 < got["share"][5]


def test_toxicity_awkward_rows(spark):
    none = spark.createDataFrame([], LABELS)
    got = toxicity.score_toxicity(awkward(spark), none).collect()
    assert len(got) == len(AWKWARD) and all(r.score == 0.5 for r in got)
    labels = spark.createDataFrame([(3, None, 1), (3, None, 0), (4, None, 0), (7, None, 1), (8, None, 0), (None, 1, 1)], LABELS)
    assert toxicity.score_toxicity(awkward(spark), labels).filter("score between 0 and 1").count() == len(AWKWARD)
    assert toxicity.score_toxicity(empty(spark), labels).count() == 0
