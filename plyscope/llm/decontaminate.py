"""Benchmark decontamination by a prefix-filtered set join (operator 1).

Benchmark items are cut into windows of ``WINDOW`` consecutive words (an item with fewer is one
window). A window is contained in a document when its words occur there consecutively, so every
shingle of it must occur: with containment 1 the necessary prefix is one shingle, and the rarest is
taken. Steps:

1. one pass over the documents finds the runs of words whose ``SHINGLE``-word shingles all occur in
   the benchmark (a lookup in a set of hashes, whose size is bounded: a larger benchmark is taken in
   blocks of items against all documents);
2. shingle frequencies are counted over all documents; a window with a shingle that occurs nowhere
   is dropped, and each other window keeps its rarest shingle as its prefix;
3. prefixes are joined with the shingle occurrences; the occurrence's place in the window gives the
   window's start, which must lie in the run (position) and leave room for all its words (length);
4. the window's words are compared one by one with the document's.

Results: null text or no words: n_words 0, n_hit 0, no items (the SHA-256 of the empty text).
Repeated rows are answered each on its own. Items without words have no windows; an item whose id is
null takes part and is listed as an empty id; rows with the same item id are one item. An empty
benchmark hits nothing; empty documents give an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from plyscope.llm import textops as tx
from plyscope.llm.common import RID, TEXT_ROWS, arrow_rows, id_text, prepare, with_rid, written

WINDOW = 10
SHINGLE = 4
#: hashes of benchmark shingles held by a task at once (8 bytes each); more items go in further blocks
BLOCK_SHINGLES = 2_000_000

_RUN = pa.struct([("size", pa.int32()), ("start", pa.int32()), ("words", pa.list_(pa.string()))])


def _texts(low, starts, ends, a, b):
    raw = low.tobytes()
    return [raw[s:e].decode("utf-8", "replace") for s, e in zip(starts[a:b], ends[a:b])]


def _items(window: int, size: int):
    def run(batches):
        for batch in batches:
            words, hashes, sizes = [], [], []
            for i, j, buf, offs in tx.slices(batch.column("text")):
                low, starts, ends, h, at = tx.words(buf, offs, tx.ALNUM)
                for r in range(j - i):
                    a, b = int(at[r]), int(at[r + 1])
                    k = min(size, window, b - a)
                    words.append(_texts(low, starts, ends, a, b))
                    hashes.append(np.unique(tx.as_signed(tx.shingles(h[a:b], k))).tolist() if k else [])
                    sizes.append(k)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(words, pa.list_(pa.string())),
                 pa.array(hashes, pa.list_(pa.int64())), pa.array(sizes, pa.int32())],
                ["item_id", "words", "hashes", "size"])
    return run


class HashSet:
    """Membership of 64-bit hashes: a bit table first, then the sorted hashes."""

    def __init__(self, hashes: np.ndarray):
        self.sorted = np.unique(hashes)
        self.bits = max(16, int(len(self.sorted) * 8).bit_length())
        self.table = np.zeros(1 << self.bits, bool)
        self.table[self._slot(self.sorted)] = True

    def _slot(self, h):
        return (h >> np.uint64(64 - self.bits)).astype(np.int64)

    def where(self, h: np.ndarray) -> np.ndarray:
        at = np.flatnonzero(self.table[self._slot(h)])
        x = h[at]
        place = np.minimum(np.searchsorted(self.sorted, x), len(self.sorted) - 1)
        return at[self.sorted[place] == x]


def _runs_in(known: dict[int, HashSet], low, starts, ends, h, at) -> dict[int, list]:
    """Per row of a slice: maximal runs of consecutive words whose shingles are all known."""
    out: dict[int, list] = {}
    for size, hashes in known.items():
        pos = hashes.where(tx.shingles(h, size))
        row = np.searchsorted(at, pos, side="right") - 1
        inside = pos + size <= at[row + 1]
        pos, row = pos[inside], row[inside]
        if not len(pos):
            continue
        first = np.flatnonzero(np.concatenate(([True], (pos[1:] != pos[:-1] + 1) | (row[1:] != row[:-1]))))
        last = np.concatenate((first[1:], [len(pos)])) - 1
        for f, g in zip(first, last):
            r, a, b = int(row[f]), int(pos[f]), int(pos[g]) + size
            text = [bytes(low[s:e]).decode("utf-8", "replace") for s, e in zip(starts[a:b], ends[a:b])]
            out.setdefault(r, []).append({"size": size, "start": a - int(at[r]), "words": text})
    return out


def _find_runs(shared, keep: list[str]):
    def run(batches):
        known = {size: HashSet(h) for size, h in shared.value.items()}
        for batch in batches:
            n_words, runs = [], []
            for i, j, buf, offs in tx.slices(batch.column("text")):
                low, starts, ends, h, at = tx.words(buf, offs, tx.ALNUM)
                found = _runs_in(known, low, starts, ends, h, at)
                n_words += np.diff(at).tolist()
                runs += [found.get(r, []) for r in range(j - i)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in keep] + [pa.array(n_words, pa.int64()), pa.array(runs, pa.list_(_RUN))],
                [*keep, "n_words", "runs"])
    return run


_RUNS_DDL = "n_words long, runs array<struct<size:int,start:int,words:array<string>>>"


def document_runs(docs: DataFrame, items: DataFrame, block: int = BLOCK_SHINGLES) -> tuple[DataFrame, DataFrame]:
    """(rid, doc_id, n_words) of every row, and its runs (rid, size, start, words)."""
    spark = docs.sparkSession
    total = items.agg(F.coalesce(F.sum(F.size("hashes")), F.lit(0))).first()[0]
    blocks = max(1, -(-total // block))
    if blocks > 1:
        docs = with_rid(docs)
    parts, rows = [], None
    for k in range(blocks):
        own = items.filter(F.pmod(F.xxhash64("item_id", "words"), F.lit(blocks)) == k)
        got = own.select("size", F.explode("hashes").alias("h")).distinct().toPandas()
        known = {int(s): g["h"].to_numpy(np.int64).view(np.uint64) for s, g in got.groupby("size")}
        shared = spark.sparkContext.broadcast(known)
        with arrow_rows(spark, TEXT_ROWS):
            if blocks > 1:
                one = written(docs.mapInArrow(_find_runs(shared, [RID, "doc_id"]), f"{RID} long, doc_id long, {_RUNS_DDL}"))
            else:
                one = with_rid(docs.mapInArrow(_find_runs(shared, ["doc_id"]), f"doc_id long, {_RUNS_DDL}"))
        rows = one.select(RID, "doc_id", "n_words") if rows is None else rows
        parts.append(one.select(RID, F.inline("runs")))
    runs = parts[0]
    for p in parts[1:]:
        runs = runs.unionByName(p)
    return rows, runs


def contained_windows(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, size: int = SHINGLE):
    """(rows, found, window items): ``found`` has (rid, start, length, wtext) of every occurrence."""
    prepare(docs.sparkSession)
    items = written(benchmark.mapInArrow(_items(window, size),
                                         "item_id long, words array<string>, hashes array<long>, size int"))
    items = items.filter(F.size("words") > 0)
    rows, runs = document_runs(docs, items)

    cut = items.select("item_id", "size", "words", F.explode(F.sequence(F.lit(0), F.greatest(F.size("words") - window, F.lit(0)))).alias("i"))
    cut = cut.select("item_id", "size", F.slice("words", F.col("i") + 1, F.lit(window)).alias("win"))
    cut = cut.withColumn("wtext", F.array_join("win", " "))
    win_items = cut.select("wtext", "item_id").distinct()
    wins = cut.select("wtext", "win", "size").dropDuplicates(["wtext"])

    occ = runs.select(RID, "size", "start", "words", F.explode(F.sequence(F.lit(0), F.size("words") - F.col("size"))).alias("o"))
    occ = occ.withColumn("lead", F.least("o", F.lit(window - 1)))
    occ = occ.select(RID, (F.col("start") + F.col("o")).alias("pos"), "lead",
                     F.array_join(F.slice("words", F.col("o") + 1, F.col("size")), " ").alias("shingle"),
                     F.slice("words", F.col("o") - F.col("lead") + 1, F.col("lead") + window).alias("near"))
    freq = occ.groupBy("shingle").agg(F.count("*").alias("freq"))
    parts = wins.select("wtext", "win", "size", F.explode(F.sequence(F.lit(0), F.size("win") - F.col("size"))).alias("f"))
    parts = parts.select("wtext", "win", "f", F.array_join(F.slice("win", F.col("f") + 1, F.col("size")), " ").alias("shingle"))
    prefix = (parts.join(freq, "shingle", "left")
              .groupBy("wtext", "win").agg(F.min(F.struct(F.coalesce("freq", F.lit(0)).alias("freq"), "shingle", "f")).alias("p"))
              .filter("p.freq > 0").select("wtext", "win", F.col("p.shingle").alias("shingle"), F.col("p.f").alias("f")))
    place = F.col("lead") - F.col("f")
    found = (occ.join(prefix, "shingle")
             .filter((place >= 0) & (place + F.size("win") <= F.size("near")))
             .filter(F.slice("near", F.greatest(place, F.lit(0)) + 1, F.size("win")) == F.col("win"))
             .select(RID, (F.col("pos") - F.col("f")).alias("start"), F.size("win").alias("length"), "wtext").distinct())
    return rows, written(found), win_items


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_id_col: str = "item_id", item_text_col: str = "text",
                  window: int = WINDOW, size: int = SHINGLE) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_hit, n_items, items_sha256, contaminated.

    A word is a run of digits, letters a-z (A-Z lower-cased) and characters beyond ASCII; a document
    word inside any occurrence of a window is hit."""
    rows, found, win_items = contained_windows(id_text(docs, id_col, text_col),
                                               id_text(benchmark, item_id_col, item_text_col), window, size)
    longest = found.groupBy(RID, "start").agg(F.max("length").alias("length"))
    before = W.partitionBy(RID).orderBy("start").rowsBetween(W.unboundedPreceding, -1)
    end = F.col("start") + F.col("length")
    fresh = F.greatest(end - F.greatest(F.col("start"), F.coalesce(F.max(end).over(before), F.lit(0))), F.lit(0))
    hits = longest.withColumn("fresh", fresh).groupBy(F.col(RID).alias("r")).agg(F.sum("fresh").alias("n_hit"))
    listed = (found.select(RID, "wtext").distinct().join(win_items, "wtext")
              .select(F.col(RID).alias("r"), F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item")).distinct()
              .groupBy("r").agg(F.count("*").alias("n_items"), F.array_join(F.sort_array(F.collect_list("item")), ",").alias("ids")))
    stats = hits.join(listed, "r")
    zero = F.lit(0).cast("long")
    return rows.join(stats, rows[RID] == stats["r"], "left").select(
        "doc_id", "n_words", F.coalesce("n_hit", zero).alias("n_hit"), F.coalesce("n_items", zero).alias("n_items"),
        F.sha2(F.coalesce("ids", F.lit("")), 256).alias("items_sha256"),
        (F.coalesce("n_hit", zero) > 0).alias("contaminated"))
