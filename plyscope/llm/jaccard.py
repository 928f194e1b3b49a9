"""N-gram Jaccard join by count vectors (operator 4).

A document's shingle set is hashed into ``GROUPS`` groups; the group counts are its point. For two
sets, the sum over the groups of the smaller count bounds their overlap from above, so an R-tree
node whose upper corner already gives too small a sum holds no partner.

Where the points meet. A linked pair of sizes p and q differs in at most D = (1/t - 1) * p shingles.
Shingles are dealt by hash into blocks; D differing shingles can spoil at most D blocks, so among any
D + 1 non-empty blocks one has the same shingles in both documents. Each document publishes its first
D + 1 non-empty blocks (key: a hash of the block's content), with the number of blocks set by the
document's size class; one whose size reaches into the class below publishes there as well, and one
with too few non-empty blocks also publishes under a finer dealing. Linked documents therefore share
a key ("page"), whatever the rest of the corpus looks like, and a passage that many documents share
fills a page only with documents that consist of little else.

Pages are resolved so that a page of many near copies never becomes all its pairs:
1. in each of up to ``ROUNDS`` rounds, every document goes, with its count vector, to one of its unresolved pages
   (first the one with the least member, then one picked by a seeded hash, on which documents with
   like pages agree), and each such gathering, dealt into chunks of bounded rows and bytes, is searched
   in one task: an R-tree over its members' count vectors, and finer counts where sets are long, give the
   partners; then the texts of those that have any are sent, finer counts and the sets verify the partners,
   and a union-find skips what is joined already, so only spanning links come out;
2. pages that still hold several components are searched through R-trees over the count vectors,
   for pairs across components only. The documents of pages over ``PAGE`` rows, which often have a passage in
   common and are no links, are dealt anew: each goes to pages of single shingles, the least common ones
   first, and only as many as a linked pair must share one of. A passage that many have comes last there, so it
   makes a page only of documents that hold little else. What is over ``PAGE`` rows even so is joined into
   families (pages that share members), which are dealt into chunks and searched chunk by chunk against
   chunk. Those pairs are held against finer counts and then verified on the sets.
Sets are 64-bit shingle hashes; equal ones are collapsed before all this, and of pages with the same
members one is kept. Sets are built anew where they are compared, for documents with a partner only: a
text is a fraction of its set's bytes, and travels once per round. The published blocks, most of what is
written, go as soon as the shared pages are known, and shuffle files go with the run that made them.

Results: no words or null text: ``n_shingles`` 0, component of its own. Repeated rows are kept, each
with the component they share; rows with a null id are grouped like others but cannot name a
component unless all ids in it are null (then null). An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plyscope.llm import textops as tx
from plyscope.llm.common import (RID, arrow_rows, free, id_text, if_small, join_groups, numbered, prepare, scope, settled,
                                 shuffles_dropped, with_rid, written)
from plyscope.llm.graph import components

GROUPS = 64
#: groups of the finer count vectors that candidate pairs are held against before verification
FINE = 512
#: sets of so many shingles carry finer counts, a byte each, beside their vector: over GROUPS groups the sums of
#: long sets come close to their sizes whatever they hold
LONG = 768
FANOUT = 32
PAGE = 256
CHUNK = 512
#: bytes of sets in a chunk, about (a single longer set is a chunk's own)
CHUNK_BYTES = 32 << 20
#: gatherings before what is left of the pages is searched pair by pair
ROUNDS = 3
#: another one is made if the last one gave more than a link for so many unresolved documents
WORTH = 20
#: the most common shingles (of more than PAGE documents each) that come last in the order of prefixes; others come in
#: the order of their hashes. Any order gives the same links
COMMON = 200_000
#: candidate rows (a few longs each) are broadcast to the texts up to this many; beyond it they are joined by a shuffle
BROADCAST_IDS = 1_000_000
#: rows that a Python worker is handed at once: a row may hold a text, or the sets of two documents
BATCH = 1_000


def spread(n: int, num: int, den: int) -> int:
    """Most shingles in which a set of ``n`` can differ from one with Jaccard >= num/den."""
    return n * (den - num) // num


def linked(size_a, size_b, overlap, num: int, den: int):
    return den * overlap >= num * (size_a + size_b - overlap)


def _deal(u: np.ndarray, blocks: int, most: int, salt: int) -> tuple[np.ndarray, bool]:
    """Keys of the first ``most`` non-empty blocks of the sorted set ``u``; whether there were as many."""
    block = ((u >> np.uint64(32)) * np.uint64(blocks)) >> np.uint64(32)
    at = np.flatnonzero(np.concatenate(([True], block[1:] != block[:-1])))
    content = np.add.reduceat(tx.mix(u ^ np.uint64(salt)), at)
    keys = tx.mix(content + tx.mix(block[at] + np.uint64(salt << 32)))
    return keys[:most], len(at) >= most


def block_keys(u: np.ndarray, num: int, den: int) -> np.ndarray:
    n = len(u)
    most = spread(n, num, den) + 1
    level = n.bit_length() - 1
    classes = [level] + ([level - 1] if level > 0 and n * num < (1 << level) * den else [])
    per_block = 0.88 * num / (den - num) if den > num else 1.0
    keys = []
    for c in classes:
        blocks, finer = max(1, int((1 << c) * 2 / per_block)), 0
        while True:
            got, enough = _deal(u, blocks, most, 1 + c * 64 + finer)
            keys.append(got)
            if enough or finer == 40:
                break
            blocks, finer = blocks * 4, finer + 1
    return np.unique(np.concatenate(keys))


def prefix(u: np.ndarray, common: np.ndarray, counts: np.ndarray, num: int, den: int) -> np.ndarray:
    """The first shingles of the set ``u`` in an order that is the same for all sets, as many that it shares one of them with
    the prefix of each set with Jaccard >= num/den: the overlap is at least num/den of either set. ``common`` shingles
    (sorted, with their ``counts``) come after all others."""
    most = len(u) - -(-num * len(u) // den) + 1
    if len(common):
        at = np.minimum(np.searchsorted(common, u), len(common) - 1)
        u = u[np.lexsort([u, np.where(common[at] == u, counts[at], 0)])]
    return u[:most]


def sets_of(col: pa.Array, size: int):
    """The sorted set of shingle hashes of each text."""
    for i, j, buf, offs in tx.slices(col):
        _, _, _, h, at = tx.words(buf, offs, tx.SPACED)
        whole = tx.shingles(h, size)
        for r in range(j - i):
            a, b = at[r], at[r + 1]
            if b - a >= size:
                yield np.unique(whole[a:b - size + 1])
            elif b > a:
                yield tx.shingles(h[a:b], int(b - a))
            else:
                yield np.zeros(0, np.uint64)


def _digest(u: np.ndarray) -> tuple[int, int]:
    one = np.add.reduce(tx.mix(u)) if len(u) else np.uint64(0)
    two = np.add.reduce(tx.mix(u ^ np.uint64(0xA5A5A5A5DEADBEEF))) if len(u) else np.uint64(0)
    return int(one.astype(np.int64)), int(two.astype(np.int64))


def _points(size: int, num: int, den: int):
    def run(batches):
        for batch in batches:
            out = {"n": [], "d1": [], "d2": [], "vec": [], "fine": [], "keys": []}
            for u in sets_of(batch.column("text"), size):
                d1, d2 = _digest(u)
                out["n"].append(len(u))
                out["d1"].append(d1)
                out["d2"].append(d2)
                out["vec"].append(_counts(u, GROUPS).astype("<u4").tobytes() if len(u) else None)
                out["fine"].append(_fine_bytes(u) if len(u) >= LONG else None)
                out["keys"].append(tx.as_signed(block_keys(u, num, den)) if len(u) else np.zeros(0, np.int64))
            lens = np.cumsum([0] + [len(k) for k in out["keys"]]).astype(np.int32)
            keys = pa.ListArray.from_arrays(pa.array(lens), pa.array(np.concatenate(out["keys"] or [np.zeros(0, np.int64)])))
            yield pa.RecordBatch.from_arrays(
                [batch.column("place"), batch.column("doc_id"), pa.array(out["n"], pa.int64()), pa.array(out["d1"], pa.int64()),
                 pa.array(out["d2"], pa.int64()), pa.array(out["vec"], pa.binary()), pa.array(out["fine"], pa.binary()), keys],
                ["place", "doc_id", "n", "d1", "d2", "vec", "fine", "keys"])
    return run


def _own_sets(tab, size: int) -> tuple[list[np.ndarray], pa.Array]:
    """The rows' sets, built from their texts, where they are those that the rows were named for; which rows these are."""
    sets = [u for c in tab.column("text").chunks for u in sets_of(c, size)]
    own = [_digest(u) == d for u, d in zip(sets, zip(*(tab.column(c).to_pylist() for c in ("d1", "d2"))))]
    return [u for u, o in zip(sets, own) if o], pa.array(own, pa.bool_())


def _set_bytes(size: int, form):
    def run(batches):
        for batch in batches:
            tab = pa.Table.from_batches([batch])
            sets, own = _own_sets(tab, size)
            rids = tab.column("rid").filter(own).combine_chunks()
            yield pa.RecordBatch.from_arrays([rids, pa.array([len(u) for u in sets], pa.int64()),
                                              pa.array([form(u).tobytes() for u in sets], pa.binary())], ["rid", "n", "items"])
    return run


def _all_shingles(size: int):
    def run(batches):
        for batch in batches:
            sets, _ = _own_sets(pa.Table.from_batches([batch]), size)
            yield pa.RecordBatch.from_arrays([pa.array(tx.as_signed(np.concatenate([np.zeros(0, np.uint64), *sets])), pa.int64())], ["shingle"])
    return run


def _prefixes(size: int, common: np.ndarray, counts: np.ndarray, num: int, den: int):
    """Finer counts, whatever the size, and the prefix of each row's set."""
    def run(batches):
        for batch in batches:
            tab = pa.Table.from_batches([batch])
            sets, own = _own_sets(tab, size)
            pages = [prefix(u, common, counts, num, den) for u in sets]
            lens = np.cumsum([0] + [len(x) for x in pages]).astype(np.int32)
            keys = pa.ListArray.from_arrays(pa.array(lens), pa.array(tx.as_signed(np.concatenate([np.zeros(0, np.uint64), *pages]))))
            yield pa.RecordBatch.from_arrays([tab.column("rid").filter(own).combine_chunks(), pa.array([_fine_bytes(u) for u in sets], pa.binary()), keys],
                                             ["rid", "fine", "keys"])
    return run


def _bound_filter(num: int, den: int, groups: int):
    """Pairs whose summed coordinate minima, over so many groups, still allow a link."""
    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            most = np.concatenate([
                np.minimum(*(np.frombuffer(b"".join(batch.column(c).slice(i, 1024).to_pylist()), "<u4").reshape(-1, groups)
                             for c in ("va", "vb"))).sum(1, dtype=np.int64) for i in range(0, batch.num_rows, 1024)])
            keep = linked(batch.column("na").to_numpy(), batch.column("nb").to_numpy(), most, num, den)
            yield batch.filter(pa.array(keep)).select(["a", "b"])
    return run


def _exact_filter(num: int, den: int):
    def run(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("ia"), batch.column("ib")):
                x, y = np.frombuffer(x.as_buffer(), "<u8"), np.frombuffer(y.as_buffer(), "<u8")
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(bool(linked(len(x), len(y), both, num, den)))
            yield batch.filter(pa.array(keep, pa.bool_())).select(["a", "b"])
    return run


class CountTree:
    """R-tree over count vectors, packed by sorting on size and then on the widest coordinates.

    A node keeps the upper corner of its points and the range of their sizes."""

    def __init__(self, vecs: np.ndarray, sizes: np.ndarray):
        wide = np.argsort(-vecs.var(axis=0))[:4]
        self.order = np.lexsort([vecs[:, g] for g in wide] + [sizes])
        self.vecs, self.sizes = vecs[self.order], sizes[self.order]
        self.levels = []
        corner, low, high = self.vecs, self.sizes, self.sizes
        while len(corner) > 1:
            at = np.arange(0, len(corner), FANOUT)
            corner = np.maximum.reduceat(corner, at, axis=0)
            low, high = np.minimum.reduceat(low, at), np.maximum.reduceat(high, at)
            self.levels.append((corner, low, high))

    def probe(self, vec: np.ndarray, size: int, num: int, den: int) -> np.ndarray:
        """Positions (in the input's order) of the points that may be linked with ``vec``."""
        def open_(corner, low, high):
            most = np.minimum(np.minimum(corner, vec).sum(1, dtype=np.int64), np.minimum(high, size))
            # the union is no smaller than either set, nor than what both sizes leave beside the overlap
            return (den * most >= num * np.maximum(low + size - most, np.maximum(low, size)))
        at = np.zeros(1, np.int64) if self.levels else np.arange(len(self.vecs))
        for depth in range(len(self.levels) - 1, -1, -1):
            corner, low, high = (x[at] for x in self.levels[depth])
            at = at[open_(corner, low, high)]
            below = len(self.levels[depth - 1][0]) if depth else len(self.vecs)
            at = (at[:, None] * FANOUT + np.arange(FANOUT)).ravel()
            at = at[at < below]
        keep = open_(self.vecs[at], self.sizes[at], self.sizes[at])
        return self.order[at[keep]]


class LongCounts:
    """The finer counts of those rows that carry them. A count stops at 255; what a set holds beyond that is
    added to the sums whole, so that they stay bounds."""

    def __init__(self, fine: list, sizes: np.ndarray):
        has = np.array([x is not None for x in fine], bool)
        self.sizes, self.at = sizes, np.where(has, np.cumsum(has) - 1, -1)
        self.counts = np.frombuffer(b"".join(x for x in fine if x is not None), "u1").reshape(-1, FINE)
        self.beyond = sizes[has] - self.counts.sum(1, dtype=np.int64)

    def near(self, q: int, hit: np.ndarray, num: int, den: int) -> np.ndarray:
        """Those of the rows ``hit`` whose finer counts, where both have them, allow a link with ``q``."""
        both = self.at[hit] >= 0
        if self.at[q] < 0 or not both.any():
            return hit
        a, b = self.at[q], self.at[hit[both]]
        most = np.minimum(self.counts[b], self.counts[a]).sum(1, dtype=np.int64) + np.minimum(self.beyond[b], self.beyond[a])
        keep = ~both
        keep[both] = linked(self.sizes[q], self.sizes[hit[both]], most, num, den)
        return hit[keep]


def _search(rids, labels, sizes, vecs, fine, sides, num, den):
    """Candidate pairs across components; where rows have two sides, only pairs across those."""
    out = []
    inner, outer = (sides == 0, sides == 1) if sides is not None and sides.any() else (None, None)
    here = np.flatnonzero(inner) if inner is not None else np.arange(len(rids))
    if not len(here):
        return out
    tree, long = CountTree(vecs[here], sizes[here]), LongCounts(fine, sizes)
    for q in (np.flatnonzero(outer) if outer is not None else here):
        hit = here[tree.probe(vecs[q], int(sizes[q]), num, den)]
        hit = hit[labels[hit] != labels[q]]
        if outer is None:
            hit = hit[hit > q]
        hit = long.near(q, hit, num, den)
        out += [(min(rids[q], rids[h]), max(rids[q], rids[h])) for h in hit]
    return out


def _page_search(num: int, den: int):
    """Rows sorted by page arrive in batches; each page (at most PAGE rows) is searched when complete."""
    def run(batches):
        held = None
        def search(tab):
            page = tab.column("page").to_numpy()
            cols = [tab.column(c).to_numpy() for c in ("rid", "label", "n")]
            vecs = np.frombuffer(b"".join(tab.column("vec").to_pylist()), "<u4").reshape(-1, GROUPS)
            fine, sides = tab.column("fine").to_pylist(), tab.column("side").to_numpy()
            at = np.concatenate(([0], np.flatnonzero(page[1:] != page[:-1]) + 1, [len(page)]))
            pairs = set()
            for a, b in zip(at[:-1], at[1:]):
                pairs.update(_search(*(c[a:b] for c in cols), vecs[a:b], fine[a:b], sides[a:b], num, den))
            a, b = zip(*pairs) if pairs else ((), ())
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])
        for batch in batches:
            if not batch.num_rows:
                continue
            tab = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
            page = tab.column("page").to_numpy()
            cut = int(np.flatnonzero(page != page[-1])[-1]) + 1 if page[0] != page[-1] else 0
            if cut:
                yield search(tab.slice(0, cut))
            held = tab.slice(cut).combine_chunks()
        if held is not None and held.num_rows:
            yield search(held)
    return run


def _counts(u: np.ndarray, groups: int) -> np.ndarray:
    return np.bincount((u & np.uint64(groups - 1)).astype(np.int64), minlength=groups)


def _fine(u: np.ndarray) -> np.ndarray:
    return _counts(u, FINE)


def _fine_bytes(u: np.ndarray) -> bytes:
    return np.minimum(_fine(u), 255).astype("u1").tobytes()


def _fine_words(u: np.ndarray) -> np.ndarray:
    return _fine(u).astype("<u4")


def _items(u: np.ndarray) -> np.ndarray:
    return u.astype("<u8")


def spanning(rids, labels, sizes, vecs, sets, num: int, den: int) -> list[tuple[int, int]]:
    """Links among the rows, found by the tree and verified on the sets: enough of them to join
    every two rows that links join, given that rows of one label are joined already."""
    comp = np.unique(labels, return_inverse=True)[1]
    tree, out, fine = CountTree(vecs, sizes), [], {}

    def counts(i):
        if i not in fine:
            fine[i] = _fine(sets[i]).astype(np.int32)
        return fine[i]
    for q in range(len(rids)):
        hit = tree.probe(vecs[q], int(sizes[q]), num, den)
        hit = hit[(hit > q) & (comp[hit] != comp[q])]
        while len(hit):
            # one partner at a time: a link takes the partner's whole component out of the rest
            h, hit = hit[0], hit[1:]
            most = int(np.minimum(counts(q), counts(h)).sum())
            if not linked(sizes[q], sizes[h], most, num, den):
                continue
            both = len(np.intersect1d(sets[q], sets[h], assume_unique=True))
            if linked(sizes[q], sizes[h], both, num, den):
                out.append((min(rids[q], rids[h]), max(rids[q], rids[h])))
                comp[comp == comp[h]] = comp[q]
                hit = hit[comp[hit] != comp[q]]
    return out


def _partnered(num: int, den: int):
    """The rows that the tree and the finer counts give a partner in another component."""
    def search(tab):
        sizes, vecs = tab.column("n").to_numpy(), _vectors(tab)
        comp = np.unique(tab.column("label").to_numpy(), return_inverse=True)[1]
        tree, keep = CountTree(vecs, sizes), np.zeros(len(sizes), bool)
        long = LongCounts(tab.column("fine").to_pylist(), sizes)
        for q in range(len(sizes)):
            hit = tree.probe(vecs[q], int(sizes[q]), num, den)
            keep[q] = len(long.near(q, hit[comp[hit] != comp[q]], num, den)) > 0
        return tab.filter(pa.array(keep)).drop_columns(["n", "vec", "fine"])
    return search


def _spanning_links(size: int, num: int, den: int):
    def search(tab):
        sets, own = _own_sets(tab, size)
        rids, labels = (tab.column(c).filter(own).to_numpy() for c in ("rid", "label"))
        vecs = np.array([_counts(u, GROUPS) for u in sets], "<u4").reshape(-1, GROUPS)
        got = spanning(rids, labels, np.array([len(u) for u in sets], np.int64), vecs, sets, num, den) if sets else ()
        x, y = zip(*got) if got else ((), ())
        return pa.table({"a": pa.array(x, pa.int64()), "b": pa.array(y, pa.int64())})
    return search


def _vectors(tab) -> np.ndarray:
    return np.frombuffer(b"".join(tab.column("vec").to_pylist()), "<u4").reshape(-1, GROUPS)


def _by_gathering(search):
    """Rows sorted by gathering arrive in batches; each gathering is searched when complete."""
    def run(batches):
        held: list = []
        for batch in batches:
            at = batch.column("at").to_numpy()
            cuts = np.concatenate(([0], np.flatnonzero(at[1:] != at[:-1]) + 1, [len(at)])) if len(at) else []
            for i, j in zip(cuts[:-1], cuts[1:]):
                if held and held[0].column("at")[0].as_py() != at[i]:
                    yield from search(pa.Table.from_batches(held)).to_batches()
                    held = []
                held.append(batch.slice(i, j - i))
        if held:
            yield from search(pa.Table.from_batches(held)).to_batches()
    return run


def _placed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """place, doc_id, text: the place tells rows apart and is the same in every scan."""
    if id_col == RID:
        return id_text(docs, id_col, text_col).withColumn("place", F.col("doc_id"))
    return numbered(id_text(docs, id_col, text_col)).withColumnRenamed(RID, "place")


def _pages_of_several(batches):
    """Rows (page, rid), sorted so, arrive in batches: those of pages with two rows or more go on, with the page's least
    rid. Of a page that the next batch may go on with, only that one is held."""
    page, head, sent = None, None, False
    for batch in batches:
        if not batch.num_rows:
            continue
        pages, rids = batch.column("page").to_numpy(), batch.column("rid").to_numpy()
        if page is not None:   # the row held back comes first
            pages, rids = np.concatenate(([page], pages)), np.concatenate(([head], rids))
        at = np.flatnonzero(np.concatenate(([True], pages[1:] != pages[:-1])))
        lens = np.diff(np.concatenate((at, [len(pages)])))
        heads, keep = np.repeat(rids[at], lens), np.repeat(lens > 1, lens)
        if sent:
            keep[0] = False
        page, head, sent = pages[-1], heads[-1], bool(lens[-1] > 1)
        yield pa.RecordBatch.from_arrays([pa.array(x[keep], pa.int64()) for x in (pages, heads, rids)], ["page", "head", "rid"])


def _one_of_alike(shared: DataFrame) -> DataFrame:
    """Of the pages that have the same members (told by 128 bits of hashes, number and least one) the rows of one,
    with the number of members."""
    pages = shared.groupBy("page", "head").agg(
        F.count("*").alias("members"), *[F.bit_xor(F.xxhash64("rid", F.lit(i))).alias(f"s{i}") for i in (1, 2)])
    kept = written(pages.groupBy("members", "head", "s1", "s2").agg(F.min("page").alias("page")).select("page", "members"))
    return shared.select("page", "head", "rid").join(kept, "page").select("page", "members", "head", "rid")


def jaccard_groups(docs: DataFrame, n: int = 5, num: int = 80, den: int = 100,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, set_copies.

    Words are runs of anything but ASCII white space, with A-Z lower-cased. Two texts are linked when
    the Jaccard similarity of their sets of ``n``-word shingles is at least num/den; ``component_id``
    is the smallest id reachable over links; ``set_copies`` counts the rows that have the same set.
    """
    spark = docs.sparkSession
    prepare(spark)
    base = _placed(docs, id_col, text_col).select("place", "doc_id", "text")
    with shuffles_dropped(spark):
        with scope() as wide, arrow_rows(spark, BATCH):
            points = with_rid(base.mapInArrow(_points(n, num, den),
                                              "place long, doc_id long, n long, d1 long, d2 long, vec binary, fine binary, keys array<long>"))
        # equal sets: one row for each, named by its least row id
        reps = written(points.filter("n > 0").groupBy("d1", "d2", "n").agg(
            F.min(RID).alias("rid"), F.count("*").alias("set_copies"), F.min("doc_id").alias("first_id")))
        shared = settled(spark, lambda: _one_of_alike(written(_shared_pages(points, reps))))
        # documents that share a page; the sets of those that are to be verified are rebuilt from their texts
        keyed = written(points.withColumnRenamed(RID, "rid").join(shared.select("rid").distinct(), "rid", "left_semi")
                        .select("rid", "place", "d1", "d2", "n", "vec", "fine"))
        points = written(points.select("doc_id", "n", "d1", "d2"))
        free(spark, wide)
        with arrow_rows(spark, BATCH):
            return _groups(base, points, reps, shared, keyed, n, num, den)


def _shared_pages(points: DataFrame, reps: DataFrame) -> DataFrame:
    """(page, head, rid) of the pages that two or more of the different sets publish."""
    extra = points.filter("n > 0").select(RID, "d1", "d2", "n").join(reps, ["d1", "d2", "n"]).filter(F.col(RID) != F.col("rid")).select(RID)
    # the copies' ids go to the points, not the points with their keys to them
    rep_points = points.filter("n > 0").join(if_small(written(extra), BROADCAST_IDS), RID, "left_anti")
    return _several(rep_points.select(F.col(RID).alias("rid"), F.explode("keys").alias("page")))


def _several(rows: DataFrame) -> DataFrame:
    """(page, head, rid) of the pages of two rows (rid, page) or more. Most pages have one row: a sort finds the others in
    bounded memory, where a table of all pages' counts fills it."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(parts, "page").sortWithinPartitions("page", "rid").mapInArrow(_pages_of_several, "page long, head long, rid long")


def _groups(base: DataFrame, points: DataFrame, reps: DataFrame, shared: DataFrame, keyed: DataFrame, n: int, num: int, den: int) -> DataFrame:
    """``jaccard_groups`` from the rows (place, doc_id, text), their sizes and digests, the different sets, the shared pages
    and the points of who shares one on."""
    spark = base.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def with_texts(need: DataFrame) -> DataFrame:
        """The rows, which have a place, and the text there: they go to the texts, not the texts to them."""
        return base.select("place", "text").join(if_small(need, BROADCAST_IDS), "place")

    def sets_of_rows(rids: DataFrame, form) -> DataFrame:
        """(rid, n, items) of the given rows, items being that form of the set."""
        need = written(keyed.join(rids, "rid", "left_semi").select("place", "rid", "d1", "d2"))
        return written(with_texts(need).select("rid", "d1", "d2", "text").mapInArrow(_set_bytes(n, form), "rid long, n long, items binary"))

    def verified(pairs: DataFrame) -> DataFrame:
        """The pairs that are linked. Most of the others fall to finer counts, before sets are sent."""
        pairs = written(pairs)
        if not pairs.count():
            return pairs
        ends = written(pairs.select(F.col("a").alias("rid")).unionByName(pairs.select(F.col("b").alias("rid"))).distinct())
        fine = sets_of_rows(ends, _fine_words).withColumnRenamed("items", "fine")
        near = written(pairs.join(fine.select(F.col("rid").alias("a"), F.col("n").alias("na"), F.col("fine").alias("va")), "a")
                       .join(fine.select(F.col("rid").alias("b"), F.col("n").alias("nb"), F.col("fine").alias("vb")), "b")
                       .select("a", "b", "na", "nb", "va", "vb").mapInArrow(_bound_filter(num, den, FINE), "a long, b long"))
        if not near.count():
            return near
        ends = written(near.select(F.col("a").alias("rid")).unionByName(near.select(F.col("b").alias("rid"))).distinct())
        sets = sets_of_rows(ends, _items)
        both = (near.join(sets.select(F.col("rid").alias("a"), F.col("items").alias("ia")), "a")
                .join(sets.select(F.col("rid").alias("b"), F.col("items").alias("ib")), "b"))
        return both.select("a", "b", "ia", "ib").mapInArrow(_exact_filter(num, den), "a long, b long")

    def gather(open_rows: DataFrame, turn: int) -> DataFrame:
        """Spanning links inside the gatherings of the documents of unresolved pages."""
        if turn == 0:
            picked = open_rows.groupBy("rid", "label").agg(F.min("head").alias("home"))
        else:
            picked = open_rows.groupBy("rid", "label").agg(F.min(F.xxhash64("page", F.lit(turn))).alias("home"))
        came = written(picked.join(keyed, "rid"))
        homes = came.groupBy("home").agg(F.count("*").alias("came"), F.sum(8 * F.col("n")).alias("bytes"), F.min("rid").alias("least")).filter("came > 1")
        homes = homes.select("home", "least", F.greatest(F.ceil(F.col("came") / CHUNK), F.ceil(F.col("bytes") / CHUNK_BYTES)).cast("int").alias("parts"))
        # the least member goes to every chunk, so that what is linked with it is joined at once
        dealt = came.join(homes, "home").select("rid", "label", "place", "d1", "d2", "n", "vec", "fine", "home", F.explode(
            F.when(F.col("rid") == F.col("least"), F.sequence(F.lit(0), F.col("parts") - 1))
            .otherwise(F.array(F.pmod(F.xxhash64("rid", F.lit(turn)), F.col("parts")).cast("int")))).alias("part"))
        rows = dealt.select(F.xxhash64("home", "part").alias("at"), "rid", "label", "place", "d1", "d2", "n", "vec", "fine")
        # the trees are asked first, without the texts: who has no partner in its gathering goes no further
        alive = written(rows.repartition(parts, "at").sortWithinPartitions("at", "rid")
                        .mapInArrow(_by_gathering(_partnered(num, den)), "at long, rid long, label long, place long, d1 long, d2 long"))
        return (with_texts(alive).select("at", "rid", "label", "d1", "d2", "text")
                .repartition(parts, "at").sortWithinPartitions("at", "rid")
                .mapInArrow(_by_gathering(_spanning_links(n, num, den)), "a long, b long"))

    def unresolved(pages: DataFrame, label: DataFrame) -> DataFrame:
        """The rows of pages that hold several components, with their labels."""
        labelled = pages.join(label.withColumnRenamed("node", "rid"), "rid", "left").withColumn("label", F.coalesce("label", "rid"))
        mixed = labelled.groupBy("page").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).filter("lo < hi").select("page")
        return written(labelled.join(mixed, "page", "left_semi"))

    def dealt_anew(rids: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Pages of single shingles such that of these rows every linked pair shares one; the rows' points, all with
        finer counts."""
        rids = written(keyed.join(rids, "rid", "left_semi"))
        texts = with_texts(rids.select("place", "rid", "d1", "d2")).select("rid", "d1", "d2", "text")
        counted = texts.mapInArrow(_all_shingles(n), "shingle long").groupBy("shingle").agg(F.count("*").alias("docs"))
        common = written(counted.filter(F.col("docs") > PAGE).orderBy(F.desc("docs"), "shingle").limit(COMMON)).toPandas()
        common["shingle"] = common["shingle"].to_numpy("int64").view("uint64")
        common = common.sort_values("shingle")
        found = written(texts.mapInArrow(_prefixes(n, common["shingle"].to_numpy(), common["docs"].to_numpy("int64"), num, den),
                                         "rid long, fine binary, keys array<long>"))
        pages = settled(spark, lambda: _one_of_alike(written(_several(found.select("rid", F.explode("keys").alias("page"))))))
        return pages, rids.select("rid", "n", "vec").join(found.select("rid", "fine"), "rid")

    def joined(label: DataFrame | None, links: DataFrame) -> DataFrame:
        return links if label is None else links.unionByName(
            label.filter("node <> label").select(F.col("node").alias("a"), F.col("label").alias("b")))

    # step 1: gatherings
    # (labels stand for the links found so far: every row hangs on its component's least)
    open_rows, label = shared.withColumn("label", F.col("rid")), None
    for turn in range(ROUNDS):
        found = settled(spark, lambda: gather(open_rows, turn))
        new = found.count()
        if label is not None and not new:
            break   # nothing was joined, so labels and unresolved pages stay
        label = settled(spark, lambda: components(joined(label, found)))
        open_rows = unresolved(shared, label)
        # another gathering pays only while they join much of what is left; step 2 misses nothing
        if new * WORTH <= open_rows.select("rid").distinct().count():
            break

    # step 2: pages that still hold several components
    plain = ["page", "rid", "label", F.lit(0).alias("side")]
    rows2 = open_rows.filter(F.col("members") <= PAGE).select(*plain).join(keyed.select("rid", "n", "vec", "fine"), "rid")
    crowd = written(open_rows.filter(F.col("members") > PAGE).select("rid").distinct())
    if crowd.count():
        pages, counts = dealt_anew(crowd)
        anew = unresolved(pages, label)
        large = anew.filter(F.col("members") > PAGE)
        family = components(large.select(F.col("head").alias("a"), F.col("rid").alias("b")))
        member = large.select("rid", "label").distinct().join(family.select(F.col("node").alias("rid"), F.col("label").alias("family")), "rid")
        chunks = member.groupBy("family").agg(F.ceil(F.count("*") / CHUNK).cast("int").alias("parts"))
        dealt = member.join(chunks, "family").withColumn("part", F.pmod(F.xxhash64("rid"), F.col("parts")).cast("int"))
        # part p meets every part: pair (i, j), i <= j, has part i as side 0 and part j as side 1
        met = dealt.select("family", "rid", "label", "part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other"))
        met = met.select(F.xxhash64("family", F.least("part", "other"), F.greatest("part", "other")).alias("page"), "rid", "label",
                         F.when(F.col("other") < F.col("part"), 1).otherwise(0).alias("side"))
        rows2 = rows2.unionByName(anew.filter(F.col("members") <= PAGE).select(*plain).unionByName(met).join(counts, "rid"))
    found = (rows2.repartition(parts, "page").sortWithinPartitions("page", "rid")
             .select("page", "rid", "label", "n", "vec", "fine", "side")
             .mapInArrow(_page_search(num, den), "a long, b long").distinct())
    more = settled(spark, lambda: verified(found))
    final = settled(spark, lambda: components(joined(label, more))) if more.count() else label

    # every row: its set's representative, that one's component, the component's smallest id
    of_rep = written(reps.join(final.select(F.col("node").alias("rid"), "label"), "rid", "left")
                     .withColumn("label", F.coalesce("label", "rid")))
    least = written(of_rep.groupBy("label").agg(F.min("first_id").alias("component_id"), F.count("*").alias("members")))
    of_rep = join_groups(of_rep, least, ["label"], "members")
    rows = join_groups(points.select("doc_id", "n", "d1", "d2"), of_rep.select("d1", "d2", "n", "set_copies", "component_id"),
                       ["d1", "d2", "n"], "set_copies")
    return rows.select("doc_id", F.col("n").alias("n_shingles"),
                       F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
                       F.coalesce("set_copies", F.lit(1)).alias("set_copies"))
