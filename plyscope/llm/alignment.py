"""Cross-tokenizer alignment (operator 11).

Two tokenizers cut the same text; their tokens are laid over its bytes. The libraries' own spans are the
coarse cuts: character offsets of the `tokenizers` encoding (A), byte spans of the `sentencepiece` one
(B; the interface that took the place of the immutable proto in the installed version and carries the
same spans). A token whose span is as wide as its decoded bytes ends where its span ends. The others
(parts of a multibyte character, byte-fallback tokens, which share or lack a span) form runs that
are cut by the tokens' decoded bytes instead.

Both tokenizers cut before a single space between two other characters, whatever stands around it (A by its
pre-tokens, B since no entry has a space after another character, which is checked). So texts are
encoded in such parts, and a part that occurs again is answered from a bounded cache: groups and links of a text are
those of its parts.

Where an A and a B token both end, a group ends. Between two neighbouring ends of either kind lies
just one overlapping pair of tokens, a link.

Counting over the corpus. A task gathers its documents into chunks of about ``CHUNK_BYTES`` of text.
The first row of a chunk carries the chunk's distinct id pairs with their numbers of links, and each document
the places of its pairs in that list. Pair counts are summed over the chunk lists (a pair occurs at
most once in a chunk, so no key is hot), go back to the chunks that hold the pair, and are applied there. No text is
shuffled or read twice, and no table of pairs is gathered on the driver or broadcast.

Results: null and empty texts, and texts whose tokens do not spell space + text (for instance those
that hold U+2581): no tokens, zeros and ''. Repeated rows and null ids are documents like others, and
their links count. Long texts are whole. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import functools
import hashlib
import re
from collections import defaultdict
from itertools import chain, count, repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plyscope.llm.common import id_text, prepare, written
from plyscope.llm.wordcache import Generations

CHUNK_BYTES = 12 << 20
#: parts that a worker remembers (twice as many at most)
CACHED_PARTS = 150_000
#: parts of so many are counted together (a longer text alone)
RUN_PARTS = 100_000
_NEW = object()
_BREAK = re.compile(r"(?<=\S) (?=\S)")


def _byte_alphabet() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable Latin-1 characters
    stand for themselves, the other bytes in turn for the characters from U+0100 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    rest = [b for b in range(256) if b not in set(plain)]
    return {**{chr(b): b for b in plain}, **{chr(256 + i): b for i, b in enumerate(rest)}}


def cuts(begin: np.ndarray, end: np.ndarray, width: np.ndarray) -> np.ndarray:
    """Byte ends of the tokens: their spans' ends where a span is as wide as the token's bytes; runs of
    other tokens are cut by their bytes from where the token before the run ends."""
    loose = end - begin != width
    if not loose.any():
        return end
    at = np.cumsum(width)
    first = np.flatnonzero(loose & ~np.concatenate(([False], loose[:-1])))
    run = np.cumsum(np.isin(np.arange(len(end)), first))[loose] - 1
    before = np.where(first > 0, end[first - 1] - at[first - 1], 0)
    out = end.copy()
    out[loose] = at[loose] + before[run]
    return out


class Aligner:
    """Both tokenizers with the bytes of their entries."""

    def __init__(self, path_a: str, path_b: str):
        import sentencepiece
        from tokenizers import Tokenizer
        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True     # their strings in a text are plain text
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        byte_of = _byte_alphabet()
        special = set(self.a.get_added_tokens_decoder())
        self.bytes_a = [b""] * self.a.get_vocab_size(with_added_tokens=True)
        for piece, i in self.a.get_vocab(with_added_tokens=True).items():
            self.bytes_a[i] = piece.encode() if i in special else bytes(map(byte_of.__getitem__, piece))
        self.bytes_b = [bytes([int(self.b.id_to_piece(i)[3:-1], 16)]) if self.b.is_byte(i) else
                        self.b.id_to_piece(i).replace("▁", " ").encode() for i in range(self.b.get_piece_size())]
        self.width_a, self.width_b = (np.array([len(x) for x in t], np.int64) for t in (self.bytes_a, self.bytes_b))
        # an id with what follows it in the list of groups
        self.shown = [f"{i}{sep}" for n, seps in ((len(self.bytes_a), ",|"), (len(self.bytes_b), ",;")) for i in range(n) for sep in seps]
        self.shown_length = np.array(list(map(len, self.shown)), np.int64)

        self.apart = all("▁" not in self.b.id_to_piece(i).lstrip("▁") for i in range(self.b.get_piece_size()))
        self.known = Generations(self._alone, CACHED_PARTS)

    def parts(self, text: str) -> list[str]:
        return _BREAK.split(text) if self.apart else [text]

    def spans(self, part: str):
        """(A ids, their byte ends, B ids, their byte ends) in space + part; None where they do not spell it."""
        spaced = " " + part
        data = spaced.encode()
        enc = self.a.encode(spaced, add_special_tokens=False)
        ids = enc.ids
        if b"".join(map(self.bytes_a.__getitem__, ids)) != data:
            return None
        span = np.fromiter(chain.from_iterable(enc.offsets), np.int64, 2 * len(ids))
        if len(data) != len(spaced):    # characters to bytes
            place = np.frombuffer(spaced.encode("utf-32-le"), "<u4")
            wide = 1 + (place > 0x7F).astype(np.int64) + (place > 0x7FF) + (place > 0xFFFF)
            span = np.concatenate(([0], np.cumsum(wide)))[span]
        ids_a = np.array(ids, np.int64)
        ends_a = cuts(span[::2], span[1::2], self.width_a[ids_a])
        enc = self.b.encode(part, return_type="offset_mapping", return_bytes=True)
        ids = enc["ids"]
        if b"".join(map(self.bytes_b.__getitem__, ids)) != data:
            return None
        span = np.fromiter(chain.from_iterable(enc["offsets"]), np.int64, 2 * len(ids)) + 1  # after the added space
        span[0] = 0
        ids_b = np.array(ids, np.int64)
        return ids_a, ends_a, ids_b, cuts(span[::2], span[1::2], self.width_b[ids_b])

    def lookup(self, parts) -> list:
        """(A tokens, B tokens, groups, the groups shown, id pairs of the links as bytes) of each of the distinct parts, or
        None. Parts that are not remembered are encoded together, as one text with spaces between them."""
        parts = list(parts)
        # read before anything is remembered, which may push out older parts
        found = list(map(self.known.get, parts, repeat(_NEW)))
        rest = [i for i, x in enumerate(found) if x is _NEW]
        for i in rest:
            found[i] = self.known.old.get(parts[i], _NEW)
        new = [i for i in rest if found[i] is _NEW]
        for at in range(0, len(new), 50_000):
            some = new[at:at + 50_000]
            plain = [i for i in some if self.apart and "▁" not in parts[i] and not parts[i][0].isspace() and not parts[i][-1].isspace()]
            for i, x in zip(plain, (self._together([parts[i] for i in plain]) if plain else None) or ()):
                found[i] = x
            for i in some:
                if found[i] is _NEW:
                    found[i] = self._alone(parts[i])
        self.known.take([parts[i] for i in rest], [found[i] for i in rest])
        return found

    def _alone(self, part: str):
        got = self.spans(part)
        return got and (len(got[0]), len(got[2]), *self.groups(*got), links(*got).tobytes())

    def _together(self, parts: list[str]):
        got = self.spans(" ".join(parts))
        if got is None:
            return None
        ids_a, ends_a, ids_b, ends_b = got
        border = np.cumsum([len(p.encode()) + 1 for p in parts])
        common, ends = merged(ends_a, ends_b)
        if not np.isin(border, common).all():
            return None
        keys, pairs = self._keys(common, *got), links(*got, ends).tobytes()
        shown = "".join(map(self.shown.__getitem__, keys.tolist()))
        def cut(x):
            return np.concatenate(([0], np.searchsorted(x, border, "right")))
        a, b, g, e = map(cut, (ends_a, ends_b, common, ends))
        s = np.concatenate(([0], np.cumsum(self.shown_length[keys])))[a + b].tolist()
        e = (e * 8).tolist()
        return list(zip(np.diff(a).tolist(), np.diff(b).tolist(), np.diff(g).tolist(),
                        [shown[i:j - 1] for i, j in zip(s, s[1:])], [pairs[i:j] for i, j in zip(e, e[1:])]))

    def text(self, text: str):
        """``spans`` of a whole text; None without tokens."""
        out, at = [], 0
        for part in self.parts(text) if text else ():
            got = self.spans(part)
            if got is None:
                return None
            out.append((got[0], got[1] + at, got[2], got[3] + at))
            at = out[-1][1][-1]
        return tuple(map(np.concatenate, zip(*out))) if out else None

    def _keys(self, common, ids_a, ends_a, ids_b, ends_b) -> np.ndarray:
        """Places in ``shown`` of all tokens, group by group."""
        of_a, of_b = np.searchsorted(common, ends_a), np.searchsorted(common, ends_b)
        keys = np.empty(len(ids_a) + len(ids_b), np.int64)
        keys[np.arange(len(ids_a)) + np.searchsorted(of_b, of_a)] = 2 * ids_a + (common[of_a] == ends_a)
        keys[np.arange(len(ids_b)) + np.searchsorted(of_a, of_b, "right")] = (
            2 * (len(self.bytes_a) + ids_b) + (common[of_b] == ends_b))
        return keys

    def groups(self, ids_a, ends_a, ids_b, ends_b) -> tuple[int, str]:
        """The number of groups, and their ids as ``a1,a2|b1;a3|b2,b3``."""
        common = merged(ends_a, ends_b)[0]
        keys = self._keys(common, ids_a, ends_a, ids_b, ends_b)
        return len(common), "".join(map(self.shown.__getitem__, keys.tolist()))[:-1]


def merged(ends_a, ends_b) -> tuple[np.ndarray, np.ndarray]:
    """The common ends, and all ends, of two ascending lists without repeats."""
    both = np.concatenate((ends_a, ends_b))
    both.sort(kind="stable")    # merges the two runs
    twice = np.zeros(len(both), bool)
    twice[:-1] = both[1:] == both[:-1]
    return both[twice], both[~twice]


def links(ids_a, ends_a, ids_b, ends_b, ends=None) -> np.ndarray:
    """The id pair (A id << 32 | B id) of each link, in text order. ``ends``: all ends, where they are known."""
    ends = merged(ends_a, ends_b)[1] if ends is None else ends
    return ids_a[np.searchsorted(ends_a, ends)] << 32 | ids_b[np.searchsorted(ends_b, ends)]


@functools.lru_cache(maxsize=2)
def aligner(path_a: str, path_b: str) -> Aligner:
    return Aligner(path_a, path_b)


SPANS = "doc_id long, a_ids array<int>, a_ends array<int>, b_ids array<int>, b_ends array<int>"


def _lists(parts: list[np.ndarray], kind) -> pa.ListArray:
    lens = np.cumsum([0] + [len(p) for p in parts]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(lens), pa.array(np.concatenate([*parts, np.zeros(0, np.int64)]), kind))


def align(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each document's tokens under both tokenizers, with their byte ends in space + text; empty lists
    for a document without tokens."""
    prepare(docs.sparkSession)

    def run(batches):
        al, none = aligner(path_a, path_b), (np.zeros(0, np.int64),) * 4
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                got = [al.text(t.as_py()) or none for t in part.column("text")]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *(_lists(list(x), pa.int32()) for x in zip(*got))],
                                                 ["doc_id", "a_ids", "a_ends", "b_ids", "b_ends"])
    return id_text(docs, id_col, text_col).mapInArrow(run, SPANS)


_LINKED = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, chunk long, "
           "places binary, times binary, pairs array<long>, pair_links array<long>")


def _gather(path_a: str, path_b: str, chunk_bytes: int):
    """Documents to rows of ``_LINKED``, a chunk at a time."""
    def run(batches):
        al, task, number = aligner(path_a, path_b), TaskContext.get().partitionId(), 0
        for held in _chunks(batches, chunk_bytes):
            yield _chunk(al, held, task << 32 | number)
            number += 1
    return run


def _chunks(batches, chunk_bytes: int):
    """Lists of (doc_id, text) of about so many bytes of text."""
    held, size = [], 0
    for batch in batches:
        for doc, text in zip(batch.column("doc_id"), batch.column("text")):
            held.append((doc.as_py(), text.as_py()))
            size += len(held[-1][1]) + 64
            if size >= chunk_bytes:
                yield held
                held, size = [], 0
    if held:
        yield held


def _runs(docs: list, able: list[int]):
    """The places in ``able`` in runs of about ``RUN_PARTS`` parts."""
    run, size = [], 0
    for i in able:
        run.append(i)
        size += len(docs[i])
        if size >= RUN_PARTS:
            yield run
            run, size = [], 0
    if run:
        yield run


def _chunk(al: Aligner, held: list, name: int) -> pa.RecordBatch:
    known, docs = defaultdict(count().__next__), []     # the chunk's distinct parts, numbered; each text's parts by number
    for _, text in held:
        own = al.parts(text) if text else ()
        docs.append(np.fromiter(map(known.__getitem__, own), np.int32, len(own)))
    parts = al.lookup(known)
    of_part = [b"" if p is None else p[4] for p in parts]
    length = np.array(list(map(len, of_part)), np.int64) // 8
    first = np.concatenate(([0], np.cumsum(length)))
    pairs, place = np.unique(np.frombuffer(b"".join(of_part), np.int64), return_inverse=True)
    sizes = np.array([(0, 0, 0) if p is None else p[:3] for p in parts], np.int64).reshape(-1, 3)
    sizes = np.concatenate([sizes, length[:, None]], 1)
    shown = [None if p is None else p[3] for p in parts]
    readable = np.array([s is not None for s in shown], bool)
    del parts, known, of_part

    none, many = np.zeros(0, np.int64), np.zeros(len(pairs), np.int64)
    numbered, digests = [(none, none)] * len(held), [""] * len(held)
    counts = np.zeros((len(held), 4), np.int64)
    able = [i for i, own in enumerate(docs) if len(own) and readable[own].all()]
    for run in _runs(docs, able):
        at, n = np.concatenate([docs[i] for i in run]), np.array([len(docs[i]) for i in run])
        counts[run] = np.add.reduceat(sizes[at], np.cumsum(n) - n)
        key, times = np.unique(np.repeat(np.arange(len(run)), n) * len(readable) + at, return_counts=True)
        doc, part = np.divmod(key, len(readable))
        # the links of the texts' distinct parts, each as often as its part occurs
        n = length[part]
        link = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first[part], n)
        key = np.repeat(doc, n) * len(pairs) + place[link]
        order = np.argsort(key)
        key = key[order]
        start = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
        times = np.add.reduceat(np.repeat(times, n)[order], start)
        doc, pair = np.divmod(key[start], len(pairs))
        many += np.bincount(pair, times, len(pairs)).astype(np.int64)
        cut = np.searchsorted(doc, np.arange(len(run) + 1))
        for i, a, b in zip(run, cut, cut[1:]):
            numbered[i] = pair[a:b].astype(np.int32), times[a:b].astype("<i4")
            digests[i] = hashlib.sha256(";".join(map(shown.__getitem__, docs[i].tolist())).encode()).hexdigest()
    used = np.flatnonzero(many)
    used = used[np.argsort(-many[used], kind="stable")]     # frequent pairs first: small places
    rank = np.zeros(len(pairs), "<i4")
    rank[used] = np.arange(len(used))
    long_list, rest = pa.list_(pa.int64()), [None] * (len(held) - 1)
    cols = [pa.array(c, pa.int64()) for c in counts.T]
    arrays = [pa.array([d for d, _ in held], pa.int64()), *cols, pa.array(digests, pa.string()),
              pa.array([name] * len(held), pa.int64()), pa.array([rank[p].tobytes() for p, _ in numbered], pa.binary()),
              pa.array([t.astype("<i4").tobytes() for _, t in numbered], pa.binary()),
              pa.array([pairs[used].tolist(), *rest], long_list), pa.array([many[used].tolist(), *rest], long_list)]
    return pa.RecordBatch.from_arrays(arrays, [f.split()[0] for f in _LINKED.split(", ")])


_OUT = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")


def _apply(docs: pa.Table, known: pa.Table) -> pa.Table:
    """A chunk's documents with the counts of its pairs, by their places in the chunk's list."""
    count, best = np.zeros(known.num_rows, np.int64), np.zeros(known.num_rows, np.int64)
    at = known.column("place").to_numpy()
    count[at], best[at] = known.column("count").to_numpy(), known.column("is_best").to_numpy()
    n_best, total = [], []
    for p, t in zip(docs.column("places"), docs.column("times")):
        p, t = np.frombuffer(p.as_buffer(), "<i4"), np.frombuffer(t.as_buffer(), "<i4").astype(np.int64)
        n_best.append(int(best[p] @ t))
        total.append(int(count[p] @ t))
    docs = docs.append_column("n_best", pa.array(n_best, pa.int64())).append_column("count_sum", pa.array(total, pa.int64()))
    return docs.select([f.split()[0] for f in _OUT.split(", ")])


def align_counts(docs: DataFrame, path_a: str, path_b: str, chunk_bytes: int = CHUNK_BYTES,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: tokens, groups and links, and how its links stand in the whole corpus."""
    prepare(docs.sparkSession)
    linked = written(id_text(docs, id_col, text_col).mapInArrow(_gather(path_a, path_b, chunk_bytes), _LINKED))
    listed = linked.filter(F.col("pairs").isNotNull()).select(
        "chunk", F.posexplode(F.arrays_zip("pairs", "pair_links")).alias("place", "p")).select(
        "chunk", F.col("place").cast("long").alias("place"), F.col("p.pairs").alias("pair"), F.col("p.pair_links").alias("n"))
    counts = written(listed.groupBy("pair").agg(F.sum("n").alias("count")))
    b_id = F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF))
    top = counts.groupBy(b_id.alias("b")).agg(F.max("count").alias("most"))
    ranked = counts.withColumn("b", b_id).join(top, "b").select(
        "pair", "count", (F.col("count") == F.col("most")).cast("long").alias("is_best"))
    known = listed.select("chunk", "place", "pair").join(ranked, "pair").select(
        F.col("chunk").alias("of"), "place", "count", "is_best")
    rows = linked.drop("pairs", "pair_links")
    return rows.groupBy("chunk").cogroup(known.groupBy("of")).applyInArrow(_apply, _OUT)
