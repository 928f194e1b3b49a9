"""Disk of ``jaccard_groups``: what is written goes when it is used up, and documents of one template are not met chunk against chunk."""

import os
import random
import time

import numpy as np
import pyarrow.dataset as ds
import pytest

from plyscope.llm import jaccard as jc
from plyscope.session import checkpoint_dir


@pytest.mark.parametrize("num", [50, 80, 95, 100])
def test_linked_sets_share_a_shingle_of_their_prefixes_whatever_is_common(num):
    rng = np.random.default_rng(num)
    linked = 0
    for _ in range(400):
        pool = rng.choice(1 << 62, 60, replace=False).astype(np.uint64)
        whole = pool[:rng.integers(1, 60)]
        a, b = (np.unique(whole[rng.random(len(whole)) < 0.97]) for _ in "ab")
        if not len(a) or not len(b) or not jc.linked(len(a), len(b), len(np.intersect1d(a, b)), num, 100):
            continue
        linked += 1
        common = np.unique(rng.choice(pool, rng.integers(0, 50), replace=False))
        counts = rng.integers(1, 4, len(common))
        x, y = (jc.prefix(u, common, counts, num, 100) for u in (a, b))
        assert len(np.intersect1d(x, y))
        rare = np.setdiff1d(a, common)
        assert len(x) == len(a) - -(-num * len(a) // 100) + 1
        assert np.isin(rare, x).all() or np.isin(x, rare).all()   # what is common comes last
    assert linked > 20


def _template_docs(rng):
    """Documents with one passage of two fifths of their words, some of them twice with a word changed; their groups."""
    passage, docs, group = [f"t{i}" for i in range(40)], [], []
    for i in range(200):
        own = [f"w{rng.randrange(100_000)}" for _ in range(60)]
        docs.append((len(docs), " ".join(passage + own)))
        group.append(docs[-1][0])
        for at in (50, 70)[:i % 5 == 0 and 1 + i % 2]:
            w = passage + own
            w[at] = "changed"
            docs.append((len(docs), " ".join(w)))
            group.append(group[-1])
    return docs, group


def _logged(make, log):
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


def _no_partners(num, den):
    return lambda tab: tab.slice(0, 0).drop_columns(["n", "vec", "fine"])


@pytest.mark.parametrize("gathered", [True, False])
def test_documents_of_one_template_are_not_all_met(spark, tmp_path, monkeypatch, gathered):
    docs, group = _template_docs(random.Random(3))
    log = str(tmp_path / "rows")
    monkeypatch.setattr(jc, "PAGE", 16)
    monkeypatch.setattr(jc, "CHUNK", 16)
    monkeypatch.setattr(jc, "_page_search", _logged(jc._page_search, log))
    if not gathered:   # every link is left to the pages
        monkeypatch.setattr(jc, "_partnered", _no_partners)
    rows = jc.jaccard_groups(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.component_id) for r in rows) == [(d, g) for (d, _), g in zip(docs, group)]
    # chunk against chunk, each of them would be sent for every chunk of 16: 3,000 rows and more
    assert sum(int(x) for x in open(log)) < 8 * len(docs)


def test_near_copies_of_one_passage_are_linked_though_it_is_common(spark, monkeypatch):
    rng = random.Random(5)
    passage = [f"t{i}" for i in range(60)]
    docs = [(i, " ".join(passage + [f"w{rng.randrange(10_000)}" for _ in range(i % 9 + 1)])) for i in range(120)]
    sets = [{tuple(t.split()[i:i + 5]) for i in range(len(t.split()) - 4)} for _, t in docs]
    group = list(range(len(docs)))
    for a in range(len(docs)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((group[a], group[b]))
                group = [x if g == y else g for g in group]
    monkeypatch.setattr(jc, "PAGE", 16)
    monkeypatch.setattr(jc, "CHUNK", 16)
    monkeypatch.setattr(jc, "_partnered", _no_partners)
    rows = jc.jaccard_groups(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.component_id) for r in rows) == [(d, g) for (d, _), g in zip(docs, group)]


def test_keys_and_shuffle_files_go_when_they_are_used_up(spark, monkeypatch):
    folder = checkpoint_dir(spark).removeprefix("file://").removeprefix("file:")
    before, seen, components = set(os.listdir(folder)), [], jc.components
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    was = spark.conf.get(setting, "false")

    def shuffles():
        blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks().mkString(" ")
        return {x for x in blocks.split() if x.startswith("shuffle_")}

    def watched(edges, *args):
        new = [x for x in os.listdir(folder) if x not in before]
        seen.append([x for x in new if "keys" in ds.dataset(f"{folder}/{x}", format="parquet").schema.names])
        return components(edges, *args)

    monkeypatch.setattr(jc, "components", watched)
    held = shuffles()
    docs, _ = _template_docs(random.Random(4))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    found = jc.jaccard_groups(df)
    assert seen and not any(seen)
    for _ in range(100):   # deleted in the background
        if not shuffles() - held:
            break
        time.sleep(0.1)
    assert not shuffles() - held
    assert found.count() == len(docs)
    assert spark.conf.get(setting, "false") == was
