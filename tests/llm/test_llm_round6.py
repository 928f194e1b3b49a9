"""Memory of the pipeline's executors: pages of one row fall out of a sorted stream, each text is scored once, batches are short."""

import numpy as np
import pyarrow as pa
import pytest

from plyscope.llm import jaccard as jc
from plyscope.llm import packing, quality
from plyscope.llm.common import TEXT_ROWS


def _several(rows, cuts):
    ends = [0, *cuts, len(rows)]
    made = [pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows[a:b]], pa.int64()) for i in (0, 1)], ["page", "rid"])
            for a, b in zip(ends[:-1], ends[1:])]
    out = [b for b in jc._pages_of_several(iter(made))]
    return sorted(tuple(r.values()) for b in out for r in b.to_pylist()), max((b.num_rows for b in out), default=0)


@pytest.mark.parametrize("step", [1, 2, 3, 7, 100])
def test_pages_of_one_row_fall_out_however_batches_are_cut(step):
    rng = np.random.default_rng(step)
    pages = np.sort(np.concatenate((rng.integers(-20, 20, 60), np.arange(30, 60), np.full(40, 70))))
    rows = [(int(p), i) for i, p in enumerate(pages)]
    members = {p: [r for q, r in rows if q == p] for p in set(pages.tolist())}
    want = sorted((p, m[0], r) for p, m in members.items() if len(m) > 1 for r in m)
    cuts = list(range(step, len(rows), step))
    got, most = _several(rows, sorted(cuts + cuts[:1]))   # one batch is empty
    assert got == want
    assert most <= step + 1   # a page longer than a batch is not gathered
    assert _several([], [])[0] == []


def test_members_are_counted_where_alike_pages_fall_together(spark):
    rows = [(p, min(m), r) for p, m in {1: (5, 6), 2: (5, 6), 3: (5, 6, 7)}.items() for r in m]
    got = jc._one_of_alike(spark.createDataFrame(rows, "page long, head long, rid long")).collect()
    assert sorted((r.page, r.members, r.head, r.rid) for r in got) == [(1, 2, 5, 5), (1, 2, 5, 6), (3, 3, 5, 5), (3, 3, 5, 6), (3, 3, 5, 7)]


def test_workers_get_short_batches_of_texts_and_score_each_once(spark, tmp_path, monkeypatch):
    seen, score, pieces = tmp_path / "seen", quality._score, packing._pieces

    def noted(make, name):
        log = str(seen) + name

        def outer(*args):
            inner = make(*args)

            def run(batches):
                def count():
                    for b in batches:
                        with open(log, "a") as f:
                            f.write(f"{b.num_rows}\n")
                        yield b
                return inner(count())
            return run
        return outer

    monkeypatch.setattr(quality, "_score", noted(score, "score"))
    monkeypatch.setattr(packing, "_pieces", noted(pieces, "pieces"))
    n = 2 * TEXT_ROWS + 10
    docs = spark.range(n).coalesce(1).selectExpr("id as doc_id", "concat('word ', id) as text", "'s' as source", "'en' as lang")
    labels = spark.createDataFrame([], "doc_id long, quality int")
    assert quality.score_quality(docs, labels).count() == n
    import public_tokenizers
    assert packing.pack(docs, public_tokenizers.path("word_bpe_49k.json")).count() == n
    for name in ("score", "pieces"):
        rows = [int(x) for x in open(str(seen) + name)]
        assert sum(rows) == n and max(rows) <= TEXT_ROWS
