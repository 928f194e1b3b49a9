"""Jaccard join: finer counts of long sets, pages with the same members, texts that go where they are compared."""

import random

import numpy as np

from plyscope.llm import jaccard as jc


def _rows(sets):
    sizes = np.array([len(u) for u in sets])
    vecs = np.stack([jc._counts(u, jc.GROUPS) for u in sets]).astype(np.uint32)
    fine = [np.minimum(jc._counts(u, jc.FINE), 255).astype("u1").tobytes() if len(u) >= jc.LONG else None for u in sets]
    return sizes, vecs, fine


def test_long_sets_with_little_in_common_are_no_candidates():
    rng = np.random.default_rng(5)
    same = np.unique(rng.integers(0, 2**64, 3000, dtype=np.uint64))
    sets = [np.unique(rng.integers(0, 2**64, 3000, dtype=np.uint64)) for _ in range(6)] + [same, same[150:]]
    sizes, vecs, fine = _rows(sets)
    rids = np.arange(len(sets))
    tree = jc.CountTree(vecs, sizes)
    assert len(tree.probe(vecs[0], int(sizes[0]), 80, 100)) > 1   # the vectors alone cannot tell them apart
    assert jc._search(rids, rids, sizes, vecs, fine, None, 80, 100) == [(6, 7)]


def test_finer_counts_lose_no_link_where_counts_stop():
    rng = np.random.default_rng(6)
    crowded = np.unique(rng.integers(0, 2**64, 4000, dtype=np.uint64) & ~np.uint64(jc.FINE - 2))   # two groups only
    sets = [crowded, crowded[200:], np.unique(rng.integers(0, 2**64, 900, dtype=np.uint64)), crowded[:700]]
    sizes, _, fine = _rows(sets)
    long = jc.LongCounts(fine, sizes)
    for q in range(len(sets)):
        hit = np.arange(len(sets))
        kept = set(long.near(q, hit, 80, 100).tolist())
        for h in hit:
            if jc.linked(sizes[q], sizes[h], len(np.intersect1d(sets[q], sets[h])), 80, 100):
                assert h in kept
    assert 2 not in long.near(0, np.array([1, 2]), 80, 100)
    assert long.near(3, np.array([0, 1]), 80, 100).tolist() == [0, 1]   # a short set has none


def test_of_pages_with_the_same_members_one_is_kept(spark):
    pages = {1: (5, 6), 2: (5, 6), 3: (5, 6, 7), 4: (5, 7), 9: (5, 7), 8: (6, 7)}
    rows = [(p, len(m), min(m), r) for p, m in pages.items() for r in m]
    got = jc._one_of_alike(spark.createDataFrame(rows, "page long, members long, head long, rid long")).collect()
    assert sorted(tuple(r) for r in got) == sorted(r for r in rows if r[0] not in (2, 9))


def _components(texts, num):
    """Smallest place reachable, by all pairs of five-word shingle sets."""
    sets = [{tuple(w[i:i + 5]) for i in range(len(w) - 4)} for w in (t.split() for t in texts)]
    root = list(range(len(sets)))
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if 100 * len(a & b) >= num * len(a | b) and root[i] != root[j]:
                x, y = sorted((root[i], root[j]))
                root = [x if r == y else r for r in root]
    return root


def test_long_texts_with_null_and_repeated_ids(spark):
    rng = random.Random(7)
    texts = []
    for n in (1200, 1200, 900, 40):
        base = [f"w{rng.randrange(5000)}" for _ in range(n)]
        for cut in (0, n // 20, n // 8, n // 3):
            texts.append(" ".join(base[cut:] + [f"v{rng.randrange(5000)}" for _ in range(cut // 4)]))
    root = _components(texts, 80)
    assert 1 < len(set(root)) < len(texts)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r.doc_id: r.component_id for r in jc.jaccard_groups(docs).collect()}
    assert got == dict(enumerate(root))
    ids = [None if i % 3 == 0 else 7 for i in range(len(texts))]   # ids say nothing about the text
    docs = spark.createDataFrame(list(zip(ids, texts)), "doc_id long, text string")
    got = sorted(((r.n_shingles, r.component_id) for r in jc.jaccard_groups(docs).collect()), key=str)
    named = {c: min((i for i, r in zip(ids, root) if r == c and i is not None), default=None) for c in root}
    sizes = [len({tuple(w[i:i + 5]) for i in range(len(w) - 4)}) for w in (t.split() for t in texts)]
    assert got == sorted(((n, named[r]) for n, r in zip(sizes, root)), key=str)
