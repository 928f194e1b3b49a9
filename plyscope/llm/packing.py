"""Best-fit packing by Best-two-fit (operator 6).

Documents become token ids plus an end id. Only longer ones are cut, into full pieces of the
sequence length (each a sequence of its own) and a last piece; all pieces below the length are packed.

Packing runs in groups of about ``GROUP`` pieces, dealt round-robin, so that each group sees the same
mix of lengths and costs at most its last, open sequence. In a group, bins are filled greedily: the
largest piece left opens a bin, and the largest that still fits is added until none does (a histogram
of lengths makes each step a search over distinct lengths). Then the bin's smallest piece is taken
out if two unpacked pieces fit its expanded gap more tightly; the piece taken out is packed later. All
pairs of lengths left are considered, and the tightest one is taken.

Results: a null text is empty and has one piece, the end id. Repeated rows are packed each on its own.
An empty table gives an empty result. Memory: a group holds lengths and row numbers only, or at most
``GROUP_WITH_IDS`` pieces with their ids; a text is tokenized whole, word by word, through a bounded
cache.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plyscope.llm import textops as tx
from plyscope.llm.common import TEXT_ROWS, arrow_rows, id_text, prepare, written
from plyscope.llm.wordcache import Generations

LENGTH = 4096
END_ID = 1
GROUP = 50_000
#: chunks in each of a cache's two generations (about 200 bytes each)
CACHE = 350_000
GROUP_WITH_IDS = 2_000
LONGEST_CACHED = 64


class WordIds:
    """Ids of texts as little-endian 32-bit bytes, chunk by chunk.

    The tokenizer drops white space and never joins across it, so a text's ids are its chunks' ids,
    cut at spaces and line ends. A text of the first 256 code points is lower-cased at once, as the
    tokenizer would (unless it may hold a special token's string, which is matched before that)."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        self.model = self.tok.model
        self.of = Generations(self._chunk, CACHE, LONGEST_CACHED)

    def _chunk(self, chunk: str) -> bytes:
        if chunk.isascii():
            if chunk.isalpha() and chunk.islower():
                return np.array([t.id for t in self.model.tokenize(chunk)], "<u4").tobytes()
            if chunk[-1:] in (".", ",") and chunk[:-1].isalpha():
                return self.of[chunk[:-1]] + self.of[chunk[-1]]
        return np.array(self.tok.encode(chunk, add_special_tokens=False).ids, "<u4").tobytes()

    def text(self, text: str) -> bytes:
        if "<|" not in text:
            try:
                text.encode("latin-1")
                text = text.lower()
            except UnicodeEncodeError:
                pass
        return b"".join(map(self.of.__getitem__, text.replace("\n", " ").split(" ")))


_IDS: dict[str, WordIds] = {}


def word_ids(path: str) -> WordIds:
    if path not in _IDS:
        _IDS[path] = WordIds(path)
    return _IDS[path]


def _pieces(path: str, length: int, end_id: int, with_ids: bool):
    def run(batches):
        ids = word_ids(path)
        end = np.array([end_id], "<u4").tobytes()
        for batch in batches:
            doc, piece, start, size, crc, raw = [], [], [], [], [], []
            names = batch.column("doc_id").to_pylist()
            for i, j, _, _ in tx.slices(batch.column("text")):
                for name, text in zip(names[i:j], batch.column("text").slice(i, j - i).to_pylist()):
                    all_ids = ids.text(text) + end
                    for k in range(0, len(all_ids), 4 * length):
                        own = all_ids[k:k + 4 * length]
                        doc.append(name)
                        piece.append(k // (4 * length))
                        start.append(k // 4)
                        size.append(len(own) // 4)
                        crc.append(zlib.crc32(own))
                        raw.append(own if with_ids else None)
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc, pa.int64()), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                 pa.array(size, pa.int64()), pa.array(crc, pa.int64()), pa.array(raw, pa.binary())],
                ["doc_id", "piece", "start", "length", "ids_crc32", "ids"])
    return run


def best_two_fit(sizes: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of each piece."""
    stock: dict[int, list[int]] = {}
    for i in np.argsort(sizes, kind="stable")[::-1]:
        stock.setdefault(int(sizes[i]), []).append(int(i))
    left = np.zeros(length + 1, bool)
    left[list(stock)] = True
    # largest[v]: the largest length in stock that is at most v, kept by path compression
    down = np.arange(-1, length)

    def largest(v: int) -> int:
        at = v
        while at > 0 and not left[at]:
            at = int(down[at])
        while v > 0 and v != at:
            down[v], v = at, int(down[v])
        return at

    def take(v: int) -> int:
        i = stock[v].pop()
        if not stock[v]:
            left[v] = False
        return i

    def put(v: int, i: int) -> None:
        stock[v].append(i)
        left[v] = True

    lengths = np.arange(length + 1)

    def tightest(room: int, more_than: int) -> tuple[int, int] | None:
        """Lengths of the two pieces in stock (longer first) with the largest sum within ``room``, if it
        is more than ``more_than``."""
        most = room - int(left.argmax())    # beside the shortest piece in stock
        first = np.flatnonzero(left[:most + 1]) if most > 0 else lengths[:0]
        first = first[np.searchsorted(first, more_than // 2 + 1):]
        if not len(first):
            return None
        below = np.maximum.accumulate(np.where(left[:most + 1], lengths[:most + 1], 0))
        second = below[np.minimum(room - first, first)]
        for k in np.flatnonzero(second == first):
            if len(stock[int(first[k])]) < 2:
                second[k] = below[first[k] - 1]
        total = np.where(second > 0, first + second, 0)
        k = len(total) - 1 - int(total[::-1].argmax())
        return (int(first[k]), int(second[k])) if total[k] > more_than else None

    where, offset, bin_ = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64), 0
    remaining = len(sizes)
    while remaining:
        inside, gap = [], length
        while gap > 0 and (v := largest(gap)):
            inside.append((v, take(v)))
            gap -= v
        if gap and len(inside) > 1:
            small, item = min(inside)
            pair = tightest(gap + small, small)
            if pair:
                inside.remove((small, item))
                inside += [(v, take(v)) for v in pair]
                down[:] = np.arange(-1, length) if not left[small] else down
                put(small, item)
        at = 0
        for v, i in inside:
            where[i], offset[i] = bin_, at
            at += v
        remaining -= len(inside)
        bin_ += 1
    return where, offset


def _pack(length: int):
    def run(batches):
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        tab = pa.Table.from_batches(held).combine_chunks()
        bins, offsets = best_two_fit(tab.column("length").to_numpy(), length)
        yield from (tab.append_column("__bin", pa.array(bins)).append_column("offset", pa.array(offsets))
                    .to_batches(max_chunksize=20_000))
    return run


def pack(docs: DataFrame, path: str, length: int = LENGTH, end_id: int = END_ID, group: int = GROUP,
         with_ids: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset, and with
    ``with_ids`` the piece's ids (little-endian 32-bit)."""
    spark = docs.sparkSession
    prepare(spark)
    ddl = "doc_id long, piece int, start long, length long, ids_crc32 long, ids binary"
    pieces = id_text(docs, id_col, text_col).mapInArrow(_pieces(path, length, end_id, with_ids), ddl)
    with arrow_rows(spark, TEXT_ROWS):
        pieces = written(pieces if with_ids else pieces.drop("ids"))
    cols = pieces.columns
    full = pieces.filter(F.col("length") == length)
    rest = pieces.filter(F.col("length") < length)
    # pieces that carry their ids (up to 16 kB each) are packed in smaller groups
    groups = max(1, -(-rest.count() // (min(group, GROUP_WITH_IDS) if with_ids else group)))
    packed = rest.repartition(groups).mapInArrow(
        _pack(length), ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pieces.schema) + ", __bin long, offset long")
    # ids: group and bin for packed pieces, negative numbers for full ones
    packed = packed.select(*cols, (F.spark_partition_id().cast("long") * (1 << 32) + F.col("__bin")).alias("sequence_id"), "offset")
    alone = full.select(*cols, (-1 - F.monotonically_increasing_id()).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return written(packed).unionByName(alone)
