"""Operators 11 to 13 against brute force, library round trips and awkward input."""

import base64
import gzip
import hashlib
import io
import random
import zlib
from collections import Counter, defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from llm_fixtures import AWKWARD, DOCS, awkward, clash, empty, words
from plyscope.llm import alignment, variants, warc

public = pytest.importorskip("public_tokenizers")
A, B = public.path("byte_bpe_50k.json"), public.path("piece_bpe_32k.model")
ODD = ["a", " ", "héllo wörld", "日本語 🙂🙂👩‍👩‍👧", "x  y\n\nz\t", "<|endoftext|> <s> <0x41>", "▁x", "\x00a", "⁂ ̈ ᛒ", "é" * 50, "a" * 3000]


# ---------------------------------------------------------------- operator 11

def plain_tokens(text):
    """Tokens as (id, bytes), by joining decoded bytes alone; None where they do not spell the text."""
    al = alignment.aligner(A, B)
    data = (" " + text).encode()
    a = [(i, al.bytes_a[i]) for i in al.a.encode(" " + text, add_special_tokens=False).ids]
    b = [(i, al.bytes_b[i]) for i in al.b.encode(text)]
    return (a, b) if text and all(b"".join(x for _, x in t) == data for t in (a, b)) else None


def plain_align(texts):
    """Per text: counts and digest as the contract states them, by comparing all byte ranges."""
    def ranges(tokens):
        at, out = 0, []
        for i, b in tokens:
            out.append((i, at, at + len(b)))
            at += len(b)
        return out
    found, total = [], Counter()
    for t in texts:
        got = plain_tokens(t or "")
        if got is None:
            found.append(None)
            continue
        a, b = map(ranges, got)
        link = [(x[0], y[0]) for x in a for y in b if x[1] < y[2] and y[1] < x[2]]
        common = sorted({x[2] for x in a} & {y[2] for y in b})
        shown, low = [], 0
        for c in common:
            shown.append("|".join(",".join(str(i) for i, s, _ in side if low <= s < c) for side in (a, b)))
            low = c
        total.update(link)
        found.append((len(a), len(b), len(common), link, hashlib.sha256(";".join(shown).encode()).hexdigest()))
    top = defaultdict(int)
    for (_, b), n in total.items():
        top[b] = max(top[b], n)
    return [(0, 0, 0, 0, 0, 0, "") if f is None else
            (f[0], f[1], f[2], len(f[3]), sum(total[p] == top[p[1]] for p in f[3]), sum(total[p] for p in f[3]), f[4]) for f in found]


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from(" \n\t.,'<|>▁aAeEé日🙂"), st.characters(codec="utf-8")), max_size=40))
def test_spans_agree_with_decoded_bytes(text):
    want, got = plain_tokens(text), alignment.aligner(A, B).text(text)
    assert (want is None) == (got is None)
    if got is not None:
        for ids, ends, plain in ((got[0], got[1], want[0]), (got[2], got[3], want[1])):
            assert ids.tolist() == [i for i, _ in plain]
            assert [0, *ends.tolist()][1:] == [sum(len(b) for _, b in plain[:k + 1]) for k in range(len(plain))]


def test_byte_alphabet_agrees_with_the_library():
    al = alignment.aligner(A, B)
    for text in ODD:
        ids = al.a.encode(text, add_special_tokens=False).ids
        assert b"".join(al.bytes_a[i] for i in ids) == text.encode()


def test_alignment_against_all_pairs(spark):
    rng = random.Random(5)
    texts = [" ".join(words(rng, rng.randrange(1, 60))) for _ in range(40)]
    texts += [*ODD, *ODD[:4], None, "", texts[0], texts[0]]
    rows = [(i, t, "en", "s", 0) for i, t in enumerate(texts)]
    cols = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
    for chunk in (300, 8 << 20):
        got = alignment.align_counts(spark.createDataFrame(rows, DOCS).repartition(3), A, B, chunk_bytes=chunk).orderBy("doc_id").collect()
        assert [tuple(r[c] for c in cols) for r in got] == plain_align(texts)


def test_a_small_cache_changes_nothing():
    """Parts pushed out of the cache while a chunk is looked up, odd parts among them."""
    from plyscope.llm.wordcache import Generations
    rng = random.Random(9)
    texts = [" ".join([*words(rng, 40, 500), rng.choice(ODD), *words(rng, 5, 60)]) for _ in range(60)]
    small, large = alignment.Aligner(A, B), alignment.aligner(A, B)
    small.known = Generations(lambda p: small.fresh[p], 50)
    for at in range(0, 60, 10):
        held = list(enumerate(texts[at:at + 10]))
        assert alignment._chunk(small, held, 1).equals(alignment._chunk(large, held, 1))
        assert len(small.known) <= 50 and len(small.known.old) <= 50
    for part in ["w1", "a\nb", " x", "x ", "▁", "w2"]:
        assert str(small.lookup([part])) == str([small._alone(part)])


def test_alignment_awkward_and_empty(spark):
    docs = awkward(spark)
    got = alignment.align_counts(docs, A, B)
    assert sorted((r.n_a, r.n_b) for r in got.collect()) == sorted(x[:2] for x in _sizes([r[1] for r in AWKWARD]))
    assert alignment.align_counts(empty(spark), A, B).count() == 0
    one = alignment.align(docs, A, B).filter("doc_id = 8").first()
    assert one.a_ends[-1] == one.b_ends[-1] == len((" " + AWKWARD[-1][1]).encode()) and len(one.a_ids) == len(one.a_ends)
    assert alignment.align(docs, A, B).filter("doc_id = 2").first().a_ids == []


def _sizes(texts):
    return [(0, 0) if (t := plain_tokens(x or "")) is None else (len(t[0]), len(t[1])) for x in texts]


# ---------------------------------------------------------------- operator 12

def plain_edits(word, alphabet):
    out = {word[:i] + word[i + 1:] for i in range(len(word))}
    out |= {word[:i] + c + word[i + 1:] for i in range(len(word)) for c in alphabet}
    out |= {word[:i] + c + word[i:] for i in range(len(word) + 1) for c in alphabet}
    return out - {word}


def plain_variants(rows):
    import re
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    n = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(lower)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            n[run if h % 199 else run[:h % len(run)] + run[h % len(run) + 1:]] += 1
    n = {w: c for w, c in n.items() if len(w) >= 6 and c >= 5}
    alphabet = {c for w in n for c in w}
    near = {w: [x for x in plain_edits(w, alphabet) if x in n] for w in n}
    form = {}
    for w, c in n.items():
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 5 * c else None
    def root(w):
        while form[w] is not None:
            w = form[w]
        return w
    return {(w, form[w], root(w), c, len(near[w]), n.get(form[w])) for w, c in n.items()}


def test_variants_against_brute_force(spark):
    rng = random.Random(8)
    letters = "abcdeéßÀ"
    stems = ["".join(rng.choice(letters) for _ in range(rng.randrange(6, 10))) for _ in range(60)]
    stems += ["aaaaaa", "aaaaaaa", "aaaaaaaa", "ababab", "bababa", "abababa", "Ààaaaa", "abcdef"]
    rows = []
    for i in range(400):
        text = []
        for _ in range(60):
            w = rng.choice(stems[:rng.choice([3, 10, len(stems)])])
            if rng.random() < 0.25:
                w = rng.choice(sorted(plain_edits(w, "ae")))
            text.append(w.upper() if rng.random() < 0.1 else w)
        rows.append((i % 390, rng.choice([" ", ", ", "1"]).join(text), "en", "s", 0))
    rows += [(None, "abcdef " * 300, None, None, None)] + AWKWARD
    rows += [(1000 + i, "qrstuvwx " * 12 + "qrstuvyx " * (i % 3 // 2) + "qrstzvyx" * (i == 0), None, None, None) for i in range(60)]
    rows += [(2000 + i, "qrstzvyx", None, None, None) for i in range(4)] + [(3000, "qrstuvyx " * 10, None, None, None)]
    docs = clash(spark.createDataFrame(rows, DOCS))
    got = variants.variant_groups(docs).select("word", "form", "root", "n", "n_near", "form_n")
    want = plain_variants([(r[0], r[1]) for r in rows])
    assert sum(1 for r in want if r[1]) > 20 and any(r[2] != (r[1] or r[0]) for r in want)
    assert Counter(map(tuple, got.collect())) == Counter(want)


def test_near_words_by_pivots_are_all_pairs(spark):
    """Short alphabets make repeated and overlapping bigrams, where the prefix has ties."""
    rng = random.Random(2)
    vocabulary = sorted({"".join(rng.choice("ab" if i % 3 else "abc") for _ in range(rng.randrange(6, 9))) for i in range(400)})
    got = variants.near_words(spark.createDataFrame([(w,) for w in vocabulary], "word string"))
    have = set(vocabulary)
    want = {(w, x) for w in vocabulary for x in plain_edits(w, "abc") if x in have}
    assert Counter(map(tuple, got.collect())) == Counter(want)


def test_pivots_are_disjoint_and_cheapest():
    rng = random.Random(4)
    for _ in range(300):
        grams = [(rng.randrange(9), "g", p) for p in rng.sample(range(9), rng.randrange(3, 6))]
        got = variants.pivots(grams)
        best = min(x[0] + y[0] for x in grams for y in grams if abs(x[2] - y[2]) >= 2)
        assert len(got) == 2 and abs(got[0][2] - got[1][2]) >= 2 and got[0][0] + got[1][0] == best


def test_variants_empty(spark):
    assert variants.variant_groups(empty(spark)).count() == 0
    none = spark.createDataFrame([(1, None, None, None, None), (2, "short ones 123", None, None, None)], DOCS)
    assert variants.variant_groups(none).count() == 0


# ---------------------------------------------------------------- operator 13

PAGES = [(1, "http://a/1", "<p>one</p>"), (2, "http://a/2", "<p>one</p>"), (3, None, None), (4, "http://a/4\r\nX: y", ""),
         (5, "http://b/ü", "ünïcödé 🙂\r\n\r\nWARC/1.1\r\n"), (5, "http://b/ü", "ünïcödé 🙂\r\n\r\nWARC/1.1\r\n"),
         (None, "http://c", "alone"), (None, "http://d", "twice"), (None, "http://d", "twice"), (9, "http://e", "x" * 300_000),
         (None, "http://f", "<p>one</p>")]
PAGE_DDL = "page_id long, url string, html string"


def plain_warc(pages):
    last = {}
    for i, (p, _, html) in enumerate(pages):
        k = html or ""
        last[k] = max(last.get(k, (-1 << 64, -1)), (-1 << 63 if p is None else p, i))
    out = []
    for i, (p, _, html) in enumerate(pages):
        body = (html or "").encode()
        first = last[html or ""][1]
        out.append((p, len(body), base64.b32encode(hashlib.sha1(body).digest()).decode(),
                    "response" if first == i else "revisit", None if first == i else pages[first][0]))
    return Counter(out)


@pytest.mark.parametrize("archive_bytes", [400, 64 << 20])
def test_archives_round_trip(spark, archive_bytes, tmp_path):
    pages = clash(spark.createDataFrame(PAGES, PAGE_DDL)).coalesce(1)
    got = warc.warc_digest(pages, archive_bytes=archive_bytes)
    assert got.columns == ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert Counter(map(tuple, got.collect())) == plain_warc(PAGES)


def test_archive_files_are_warc(spark, tmp_path):
    """Archives are plain concatenated gzip members of well-formed records, and the index cuts them."""
    pages = spark.createDataFrame(PAGES, PAGE_DDL).coalesce(2)
    folder, index = warc.write_archives(pages, str(tmp_path / "w"))
    rows = index.collect()
    for name in {r.archive for r in rows}:
        raw = (tmp_path / "w" / name).read_bytes()
        own = sorted((r for r in rows if r.archive == name), key=lambda r: r.offset)
        assert [r.offset for r in own] == [sum(x.length for x in own[:i]) for i in range(len(own))]
        assert sum(r.length for r in own) == len(raw)
        stream = gzip.GzipFile(fileobj=io.BytesIO(raw)).read()
        at = 0
        for _ in own:     # a sequential reader that knows only Content-Length finds the same records
            head, _, rest = stream[at:].partition(b"\r\n\r\n")
            size = int(dict(x.split(b": ", 1) for x in head.split(b"\r\n")[1:])[b"Content-Length"])
            assert head.startswith(b"WARC/1.1") and rest[size:size + 4] == b"\r\n\r\n"
            at += len(head) + 4 + size + 4
        assert at == len(stream)


def test_selected_records_only(spark, tmp_path):
    pages = spark.createDataFrame([(i, f"http://x/{i}", f"page {i} " * (i % 50)) for i in range(3000)], PAGE_DDL)
    folder, index = warc.write_archives(pages, str(tmp_path / "w"))
    chosen = index.filter("page_id % 7 = 3 and record_type = 'response'")
    got = warc.read_records(folder, chosen).collect()
    assert {r.page_id for r in got} == {r.page_id for r in chosen.collect()} and len(got) > 5
    assert all(bytes(r.payload).decode() == f"page {r.page_id} " * (r.page_id % 50) and r.url == f"http://x/{r.page_id}" for r in got)


def test_damage_is_noticed():
    record = warc.build_record(1, 0, "http://a", b"body", warc.payload_digest(b"body"))
    assert warc.parse_record(record)["payload"] == b"body"
    for bad in (record.replace(b"body", b"bodx"), record[:-2]):
        with pytest.raises(ValueError):
            warc.parse_record(bad)


def test_warc_empty(spark):
    assert warc.warc_digest(spark.createDataFrame([], PAGE_DDL)).count() == 0


def test_a_lost_attempt_leaves_no_index_rows(spark, tmp_path):
    """Archives that no index row names, as a killed task leaves them, do not matter."""
    pages = spark.createDataFrame(PAGES, PAGE_DDL)
    folder, index = warc.write_archives(pages, str(tmp_path / "w"))
    (tmp_path / "w" / "0123.warc.gz").write_bytes(b"half a rec")
    assert warc.read_records(folder, index).count() == len(PAGES)
    assert index.select(F.count_distinct("archive")).first()[0] <= len(list((tmp_path / "w").iterdir())) - 1
