"""Token counts by heap-and-linked-list byte-pair merging (operator 9).

A pre-token's bytes are its initial symbols, held in a doubly linked list; a heap holds the adjacent
pairs that have a merge, by rank and then by place. The lowest is popped again and again and its two
symbols become one. The token count is the number of initial symbols minus the number of merges: no
identifier is ever looked up or emitted. Costs n log n for n bytes, also for texts without spaces.

Texts are cut before each white-space run (a pre-token never joins a character and white space after
it), and each distinct chunk is counted once per generation of a bounded cache.

Results: null text: 0 bytes, 0 tokens. Special tokens' strings inside a text count as one token, as
the library has it by default. Repeated rows are answered each on its own; an empty table gives an
empty result.
"""

from __future__ import annotations

import heapq
import json
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plyscope.llm import textops as tx
from plyscope.llm.common import id_text, prepare
from plyscope.llm.wordcache import Generations

LIMIT = 512
#: chunks and pre-tokens in each of a cache's two generations (about 170 bytes each)
CHUNKS, PIECES = 250_000, 150_000
#: the pre-token pattern of byte-level BPE (a fixed value)
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte: itself where it is printable, otherwise the
    next unused code point from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


class Counter:
    """Counts tokens with one vocabulary file."""

    def __init__(self, path: str):
        import regex
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        self.rank = {(a, b): i for i, (a, b) in enumerate(merges)}
        self.symbols = byte_symbols()
        special = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, special))) if special else None
        self.split = regex.compile(PATTERN).findall
        self.pieces = Generations(self.merge, PIECES)
        self.chunks = Generations(lambda c: sum(map(self.pieces.__getitem__, self.split(c))), CHUNKS)

    def merge(self, piece: str) -> int:
        """Tokens of one pre-token."""
        symbols = [self.symbols[b] for b in piece.encode("utf-8", "surrogatepass")]
        n = len(symbols)
        if n < 2:
            return n
        rank = self.rank
        heap = [(r, i, symbols[i], symbols[i + 1]) for i in range(n - 1)
                if (r := rank.get((symbols[i], symbols[i + 1]))) is not None]
        if not heap:
            return n
        heapq.heapify(heap)
        after = list(range(1, n + 1))
        before = list(range(-1, n - 1))
        merges = 0
        while heap:
            _, i, left, right = heapq.heappop(heap)
            j = after[i]
            # an entry is stale when one of its symbols has been merged since
            if symbols[i] is not left or j >= n or symbols[j] is not right:
                continue
            whole = left + right
            symbols[i], symbols[j] = whole, None
            merges += 1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if (r := rank.get((whole, symbols[k]))) is not None:
                    heapq.heappush(heap, (r, i, whole, symbols[k]))
            h = before[i]
            if h >= 0 and (r := rank.get((symbols[h], whole))) is not None:
                heapq.heappush(heap, (r, h, symbols[h], whole))
        return n - merges

    def plain(self, text: str) -> int:
        """Tokens of a text without special tokens' strings."""
        words = text.split(" ")
        if "" in words:
            return sum(map(self.pieces.__getitem__, self.split(text)))
        first = self.chunks[words[0]]
        return first + sum(map(self.chunks.__getitem__, [" " + w for w in words[1:]]))

    def text(self, text: str) -> int:
        if self.special is None or "<" not in text:
            return self.plain(text) if text else 0
        parts = self.special.split(text)
        return len(parts) - 1 + sum(self.plain(p) for p in parts if p)


_COUNTERS: dict[str, Counter] = {}


def counter(path: str) -> Counter:
    if path not in _COUNTERS:
        _COUNTERS[path] = Counter(path)
    return _COUNTERS[path]


def _count(path: str):
    def run(batches):
        count = counter(path).text
        for batch in batches:
            n_bytes, n_tokens = [], []
            col = batch.column("text")
            for i, j, _, offs in tx.slices(col):
                n_bytes += np.diff(offs).tolist()
                n_tokens += map(count, col.slice(i, j - i).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n_bytes, pa.int64()),
                                              pa.array(n_tokens, pa.int64())], ["doc_id", "n_bytes", "n_tokens"])
    return run


def count_tokens(docs: DataFrame, path: str, limit: int = LIMIT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_tokens, over_limit (n_tokens > ``limit``)."""
    prepare(docs.sparkSession)
    out = id_text(docs, id_col, text_col).mapInArrow(_count(path), "doc_id long, n_bytes long, n_tokens long")
    return out.withColumn("over_limit", F.col("n_tokens") > limit)
