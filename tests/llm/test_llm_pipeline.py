"""The corpus pipeline, stage by stage, against plain versions of what each stage decides."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as cp
from llm_fixtures import AWKWARD, CLASHING, DOCS, clash, empty
from plyscope.llm import quality
from plyscope.llm.common import table, written
from test_llm_text_joins import plain_decontaminate, plain_redact, plain_sets

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
tokenizers = pytest.importorskip("tokenizers")
public = pytest.importorskip("public_tokenizers")


def _rows(df, names):
    return sorted((tuple(str(r[c]) for c in names) for r in df.select(*names).collect()))


def _input(spark):
    docs = table(spark, SF, "documents")
    # documents labelled as good hold a secret, so that some of those that reach the secret scan do
    good = F.col("doc_id").isin([r.doc_id for r in table(spark, SF, "labels").filter("quality = 1").collect()])
    text = F.when(good, F.concat("text", F.lit(" api_key = abcdef123456"))).otherwise(F.col("text"))
    docs = docs.withColumns({"text": text, "n_chars": F.when(good, F.length(text)).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType)})
    extra = spark.createDataFrame(AWKWARD + [AWKWARD[3]], DOCS).select(docs.columns)
    return written(clash(docs.unionByName(extra)))


def plain_dedupe(rows):
    sets = plain_sets([(r.doc_id, r.text) for r in rows], 5)
    root = list(range(len(rows)))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a
    for i, (_, x) in enumerate(sets):
        for j in range(i):
            y = sets[j][1]
            if x and y and 100 * len(x & y) >= 80 * len(x | y):
                root[find(i)] = find(j)
    first = {}
    for i, r in enumerate(rows):
        key = (r.doc_id is None, r.doc_id or 0)
        if find(i) not in first or key < first[find(i)][0]:
            first[find(i)] = (key, i)
    return [rows[i] for _, i in first.values()]


def test_stage_names_and_order():
    assert [n for n, _ in cp.STAGES] == ["quality_classifier", "ngram_jaccard", "benchmark_decontamination", "secret_scan",
                                         "best_fit_packing"]
    assert cp.ORACLE_SQL is None


def test_each_stage_against_a_plain_version(spark):
    docs = _input(spark)
    names = docs.columns
    assert set(CLASHING) <= set(names)

    # 1: what the classifier itself rejects goes, everything else stays as it was
    labels = table(spark, SF, "labels")
    verdict = quality.score_quality(docs, labels, keep_columns=["doc_id", "text"])
    rejected = {(str(r.doc_id), str(r.text)) for r in verdict.filter("rejected").collect()}
    one = written(cp.quality_classifier(spark, docs, SF))
    assert one.columns == names
    assert _rows(one, names) == [r for r in _rows(docs, names) if (r[0], r[1]) not in rejected]
    clean = labels.filter("quality = 1").join(docs, "doc_id", "left_semi").select("doc_id")
    assert clean.join(one, "doc_id", "left_anti").count() <= 1

    # 2: one document of each group, the smallest id
    two = written(cp.ngram_jaccard(spark, one, SF))
    assert two.columns == names
    kept = plain_dedupe(one.collect())
    assert _rows(two, ["doc_id", "text"]) == sorted((str(r.doc_id), str(r.text)) for r in kept)
    assert two.count() < one.count()

    # 3: documents with a benchmark window go
    items = [(r.item_id, r.text) for r in table(spark, SF, "benchmark").collect()]
    rows = two.collect()
    bad = [x[-1] for x in (plain_decontaminate([(r.doc_id, r.text)], items)[0] for r in rows)]
    three = written(cp.benchmark_decontamination(spark, two, SF))
    assert three.columns == names and any(bad)
    assert _rows(three, ["doc_id", "text"]) == sorted((str(r.doc_id), str(r.text)) for r, b in zip(rows, bad) if not b)

    # 4: secrets are replaced, no document goes
    four = written(cp.secret_scan(spark, three, SF))
    assert four.columns == names
    want = sorted((str(r.doc_id), str(plain_redact(r.text))) for r in three.collect())
    assert _rows(four, ["doc_id", "text"]) == want
    changed = four.filter(F.col("text").contains("[SECRET]"))
    assert changed.count() > 0 and changed.filter(F.length("text") != F.col("n_chars")).count() == 0

    # 5: every token of every document, packed without gaps
    five = cp.best_fit_packing(spark, four, SF).toPandas()
    tok = tokenizers.Tokenizer.from_file(public.path("word_bpe_49k.json"))
    total = sum(len(tok.encode(r.text or "", add_special_tokens=False).ids) + 1 for r in four.collect())
    sums = five.groupby("sequence_id")["length"].sum()
    assert five["length"].sum() == total and sums.max() <= 4096 and len(sums) <= 1.03 * total / 4096 + 1
    for _, s in five.sort_values("offset").groupby("sequence_id"):
        assert (s["offset"].to_numpy() == np.concatenate(([0], np.cumsum(s["length"])[:-1]))).all()


def test_run_gives_the_last_stages_rows(spark):
    got = cp.run(spark, SF)
    assert {"doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"} <= set(got.columns) and got.count() > 100


@pytest.mark.parametrize("stage", [f for _, f in cp.STAGES], ids=[n for n, _ in cp.STAGES])
def test_stages_of_an_empty_table(spark, stage):
    assert stage(spark, written(empty(spark)), SF).count() == 0
