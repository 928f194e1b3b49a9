"""Operators 1, 4 and 8 against plain versions."""

import hashlib
import random
import re

import pytest

from llm_fixtures import AWKWARD, DOCS, awkward, clash, empty, words
from plyscope.llm import decontaminate as dc
from plyscope.llm import jaccard as jc
from plyscope.llm import secrets as sc

LOWER = {i: i + 32 for i in range(65, 91)}
ITEMS = "item_id long, text string"


# ---------------------------------------------------------------- operator 1

def _words1(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def plain_decontaminate(docs, items):
    windows = []
    for item, text in items:
        w = _words1(text)
        windows += [("" if item is None else str(item), w[i:i + 10]) for i in range(max(1, len(w) - 9)) if w]
    out = []
    for doc, text in docs:
        w, hit, found = _words1(text), set(), set()
        for item, win in windows:
            for p in range(len(w) - len(win) + 1):
                if w[p:p + len(win)] == win:
                    hit.update(range(p, p + len(win)))
                    found.add(item)
        out.append((doc, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def _rows1(df):
    return sorted(((r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in df.collect()), key=str)


@pytest.mark.parametrize("block", [dc.BLOCK_SHINGLES, 40])
def test_decontaminate_matches_plain_version(spark, monkeypatch, block):
    rng = random.Random(1)
    items = [(i, " ".join(words(rng, rng.choice([1, 2, 3, 5, 9, 10, 11, 30]), 40))) for i in range(12)]
    items += [(3, "repeated id " + " ".join(words(rng, 12))), (None, " ".join(words(rng, 15))), (90, None), (91, "..."), (10, items[0][1])]
    docs = []
    for i in range(40):
        w = words(rng, rng.randrange(0, 60), 40)
        if i % 3 == 0:
            src = _words1(rng.choice(items)[1])
            cut = rng.randrange(max(1, len(src)))
            w[len(w) // 2:len(w) // 2] = src[cut:cut + rng.choice([9, 10, 14])]
        docs.append((i, rng.choice([" ", ", ", "\n- "]).join(w).replace("w1", "W1")))
    docs += [(r[0], r[1]) for r in AWKWARD] + [(None, items[5][1]), (50, items[7][1]), (50, items[7][1])]
    d = clash(spark.createDataFrame(docs, "doc_id long, text string"))
    b = clash(spark.createDataFrame(items, ITEMS))
    original = dc.document_runs
    monkeypatch.setattr(dc, "document_runs", lambda x, y: original(x, y, block))
    assert _rows1(dc.decontaminate(d, b)) == plain_decontaminate(docs, items)


def test_decontaminate_empty_tables(spark):
    none = spark.createDataFrame([], ITEMS)
    assert dc.decontaminate(empty(spark), none).count() == 0
    got = dc.decontaminate(awkward(spark), none)
    assert got.count() == len(AWKWARD) and got.filter("contaminated").count() == 0


# ---------------------------------------------------------------- operator 4

def plain_sets(docs, n):
    out = []
    for doc, text in docs:
        w = [x for x in re.split(r"[\x20\x09-\x0D]+", (text or "").translate(LOWER)) if x]
        out.append((doc, frozenset(tuple(w[i:i + n]) for i in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)] if w else [])))
    return out


def plain_components(docs, n, num, den):
    sets = plain_sets(docs, n)
    root = list(range(len(sets)))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a
    for i, (_, x) in enumerate(sets):
        for j in range(i):
            y = sets[j][1]
            if x and y and den * len(x & y) >= num * len(x | y):
                root[find(i)] = find(j)
    ids = {}
    for i, (doc, _) in enumerate(sets):
        ids.setdefault(find(i), []).append(doc)
    least = {k: min((d for d in v if d is not None), default=None) for k, v in ids.items()}
    return sorted(((doc, len(x), least[find(i)]) for i, (doc, x) in enumerate(sets)), key=str)


def _near(rng, base, changes):
    out = list(base)
    for _ in range(changes):
        k = rng.randrange(len(out))
        out[k:k + 1] = rng.choice([[], [f"x{rng.randrange(10**6)}"], [out[k], "extra"]])
    return out


@pytest.mark.parametrize("num,page,chunk,rounds", [(85, 256, 512, 3), (80, 4, 5, 3), (80, 4, 5, 1)])
def test_jaccard_groups_match_all_pairs(spark, monkeypatch, num, page, chunk, rounds):
    monkeypatch.setattr(jc, "PAGE", page)
    monkeypatch.setattr(jc, "CHUNK", chunk)
    monkeypatch.setattr(jc, "ROUNDS", rounds)
    rng = random.Random(num)
    docs, passage = [], words(rng, 60)
    for g in range(8):
        base = words(rng, rng.choice([3, 6, 20, 80, 200]), 5000)
        for _ in range(rng.choice([1, 2, 12])):
            docs.append((len(docs) * 7 % 1000, " ".join(_near(rng, base, rng.randrange(0, 6)))))
    family = words(rng, 120, 5000)
    docs += [(2000 + i, " ".join(_near(rng, family, rng.randrange(1, 9)))) for i in range(30)]
    docs += [(3000 + i, " ".join(passage + words(rng, 10 + i, 5000))) for i in range(12)]
    docs += [(r[0], r[1]) for r in AWKWARD] + [(docs[0][0], docs[0][1].upper()), (None, "only null ids"), (None, "only null ids")]
    d = clash(spark.createDataFrame(docs, "doc_id long, text string"))
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in jc.jaccard_groups(d, 4, num, 100).collect()), key=str)
    assert got == plain_components(docs, 4, num, 100)


def test_block_keys_always_meet():
    """Any two linked sets share a key, over random sets at the very edge of the threshold."""
    import numpy as np
    rng = np.random.default_rng(5)
    for num in (80, 85, 95):
        for n in [1, 2, 3, 5, 7, 8, 9, 15, 16, 17, 40, 64, 200, 1000]:
            for _ in range(12):
                u = np.unique(rng.integers(0, 2**64, n, dtype=np.uint64))
                gone = int(rng.integers(0, jc.spread(n, num, 100) + 1))
                v = rng.permutation(u)[gone:]
                while True:
                    more = np.unique(np.concatenate([v, rng.integers(0, 2**64, 1, dtype=np.uint64)]))
                    both = len(np.intersect1d(u, more))
                    if not jc.linked(len(u), len(more), both, num, 100) or rng.random() < 0.1:
                        break
                    v = more
                v = np.unique(v)
                both = len(np.intersect1d(u, v))
                if len(v) and jc.linked(len(u), len(v), both, num, 100):
                    assert len(np.intersect1d(jc.block_keys(u, num, 100), jc.block_keys(v, num, 100)))


def test_count_tree_keeps_every_partner():
    import numpy as np
    rng = np.random.default_rng(6)
    vecs = rng.poisson(3, (400, jc.GROUPS)).astype(np.uint32)
    vecs[200:] = np.maximum(vecs[:200].astype(int) + (rng.random((200, jc.GROUPS)) < 0.03), 0)
    sizes = vecs.sum(1).astype(np.int64)
    tree = jc.CountTree(vecs, sizes)
    for q in range(0, 400, 7):
        most = np.minimum(vecs, vecs[q]).sum(1).astype(np.int64)
        want = set(np.flatnonzero(jc.linked(sizes, sizes[q], most, 85, 100)).tolist())
        assert want <= set(tree.probe(vecs[q], int(sizes[q]), 85, 100).tolist())


def test_gathering_joins_what_all_pairs_join():
    """Every link of a gathering comes out of the tree, and only a spanning part of them."""
    import numpy as np
    rng = np.random.default_rng(8)
    sets = []
    for n in (1, 4, 30, 300):
        base = np.unique(rng.integers(0, 2**64, n, dtype=np.uint64))
        for _ in range(25):
            gone = rng.permutation(base)[int(rng.integers(0, n // 6 + 1)):]
            sets.append(np.unique(np.concatenate([gone, rng.integers(0, 2**64, int(rng.integers(0, n // 8 + 1)), dtype=np.uint64)])))
    sizes = np.array([len(x) for x in sets])
    vecs = np.stack([np.bincount((x & np.uint64(jc.GROUPS - 1)).astype(int), minlength=jc.GROUPS) for x in sets]).astype(np.uint32)
    rids = np.arange(len(sets)) * 3
    every = [(i, j) for i in range(len(sets)) for j in range(i)
             if jc.linked(sizes[i], sizes[j], len(np.intersect1d(sets[i], sets[j])), 80, 100)]

    def parted(pairs):
        root = list(range(len(sets)))
        for a, b in pairs:
            x, y = root[a], root[b]
            root = [min(x, y) if r in (x, y) else r for r in root]
        return root
    got = jc.spanning(rids, rids, sizes, vecs, sets, 80, 100)
    assert parted([(a // 3, b // 3) for a, b in got]) == parted(every)
    assert len(got) == len(sets) - len(set(parted(every))) < len(every)
    joined = np.array(parted(every))
    assert jc.spanning(rids, joined, sizes, vecs, sets, 80, 100) == []


def test_jaccard_empty_table(spark):
    assert jc.jaccard_groups(empty(spark)).count() == 0


# ---------------------------------------------------------------- operator 8

def plain_secrets(text):
    text = text or ""
    found = []
    for kind, (pattern, role, least, weak) in sc.KINDS.items():
        for m in re.finditer(pattern, text):
            s = m.group()
            ok = (len(m.group(2)) >= 6 if kind == "assign" else
                  all(re.search(c, s) for c in ("[0-9]", "[a-z]", "[A-Z]")) if kind == "private" else len(s) >= least)
            if ok:
                found.append((m.start(), sc.NUMBER[kind], m.end(), kind, role))
    base = [f for f in found if f[1] < 3]
    weak = [f for f in found if f[1] >= 3 and not any(b[0] < f[2] and b[2] > f[0] for b in base)]
    kept = [w for w in weak if any(o[4] in sc.COMPLEMENT[w[3]] and abs(o[0] - w[0]) <= sc.SCOPE for o in base + weak)]
    join = lambda spans: ",".join(f"{k}:{s}:{e}" for s, _, e, k, _ in sorted(spans))
    return (sum(b[3] == "assign" for b in base), sum(b[3] == "access" for b in base), sum(b[3] == "hex" for b in base),
            hashlib.sha256(join(base).encode()).hexdigest(), join(base + kept), len(kept))


SECRETS = [
    'password="hunter22" and Token: abcdef, secret: token: abcdef api-key=short apikey=longenough',
    "AKIA" + "A" * 16 + " AKIA" + "B" * 3 + " xAKIAAKIA" + "C" * 14 + " " + "0123456789abcdef" * 3,
    "🙂 é user=bob passwd=x1y2z3 at https://db.example.com:5432/x then " + "pad " * 200 + "user=far https://far.example.com",
    "key Ab3" + "xY9/" * 10 + " host s3://bucket/path" + " login: someone " + "z" * 500 + " Ab3" + "xY9/" * 10,
    "client_id=abc " + "Qw3" * 12, "https://alone.example.com", "USER = eve\nSecret='aaaaaaaa'\nPASSWORD: 'b'",
    "paſſword=abcdefgh passworK=abcdefgh", "token=token=abcdefg token=" + "a" * 3000,
]


def test_secrets_match_plain_version(spark):
    docs = [(i, t) for i, t in enumerate(SECRETS)] + [(r[0], r[1]) for r in AWKWARD] + [(0, SECRETS[0])]
    docs.append((60, " | ".join(SECRETS * 40)))
    got = sorted(((r.doc_id, r.n_assign, r.n_access, r.n_hex, r.base_sha256, r.spans, r.n_linked) for r in
                  sc.scan_secrets(clash(spark.createDataFrame(docs, "doc_id long, text string"))).collect()), key=str)
    assert got == sorted(((i, *plain_secrets(t)) for i, t in docs), key=str)
    assert sum(g[6] for g in got) > 10
    assert sc.scan_secrets(empty(spark)).count() == 0


def plain_redact(text):
    if text is None:
        return None
    spans = [tuple(map(int, s.split(":")[1:])) for s in plain_secrets(text)[4].split(",") if s]
    out, at = [], 0
    merged = []
    for s, e in sorted(spans):
        if merged and s <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], e)
        else:
            merged.append([s, e])
    for s, e in merged:
        out.append(text[at:s] + "[SECRET]")
        at = e
    return "".join(out) + text[at:]


def test_redaction_matches_plain_version(spark):
    from plyscope.llm.common import with_rid
    docs = [(i, t, "en", "s", 1) for i, t in enumerate(SECRETS)] + AWKWARD
    out = sc.redact(with_rid(spark.createDataFrame(docs, DOCS)))
    assert sorted((str(r.doc_id), str(r.text)) for r in out.collect()) == sorted((str(d[0]), str(plain_redact(d[1]))) for d in docs)
