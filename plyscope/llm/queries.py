"""Registered queries of the training-data operators, and their DuckDB SQL where it exists.

Each query applies its operator, with production parameters, to the whole intended table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from plyscope.llm.common import table


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    from plyscope.llm.decontaminate import decontaminate
    return decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from plyscope.llm.quality import score_quality
    return score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    from plyscope.llm.neighbours import nearest
    return nearest(table(spark, sf_dir, "embeddings"))


def op4_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    from plyscope.llm.jaccard import jaccard_groups
    return jaccard_groups(table(spark, sf_dir, "documents"), n=4, num=85, den=100)


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from plyscope.llm.langid import identify
    return identify(table(spark, sf_dir, "documents"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    from plyscope.llm.packing import pack
    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from plyscope.llm.sharding import sharding_digest
    return sharding_digest(table(spark, sf_dir, "documents"))


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    from plyscope.llm.secrets import scan_secrets
    return scan_secrets(table(spark, sf_dir, "documents"))


def op9_token_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    from plyscope.llm.tokencount import count_tokens
    return count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from plyscope.llm.toxicity import score_toxicity
    return score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    from plyscope.llm.alignment import align_counts
    return align_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                        public_tokenizers.path("piece_bpe_32k.model"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    from plyscope.llm.variants import variant_groups
    return variant_groups(table(spark, sf_dir, "documents"))


def op13_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from plyscope.llm.warc import warc_digest
    return warc_digest(table(spark, sf_dir, "pages"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {name: fn for name, fn in list(globals().items()) if (name.startswith("op") or name == "pipeline") and callable(fn)}

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_OP1 = rf"""
WITH item_words AS (
  SELECT item_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
item_windows AS (
  SELECT DISTINCT coalesce(CAST(item_id AS VARCHAR), '') AS item, least(10, len(w)) AS length,
         unnest(list_transform(range(0, greatest(1, len(w) - 9)), lambda i: array_to_string(w[i + 1:i + 10], ' '))) AS wtext
  FROM item_words WHERE len(w) > 0),
doc_words AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
grams AS (
  SELECT r, length, unnest(list_transform(range(0, len(w) - length + 1),
         lambda p: {{'p': p, 't': array_to_string(w[p + 1:p + length], ' ')}})) AS g
  FROM doc_words, (SELECT DISTINCT length FROM item_windows) WHERE len(w) >= length),
occurring AS (SELECT r, g.p AS p, grams.length, item FROM grams JOIN item_windows i ON g.t = i.wtext AND grams.length = i.length),
hit AS (SELECT r, count(DISTINCT p + o) AS n FROM (SELECT r, p, unnest(range(0, length)) AS o FROM occurring) GROUP BY r),
listed AS (SELECT r, count(DISTINCT item) AS n, array_to_string(list_sort(list_distinct(list(item))), ',') AS ids FROM occurring GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(hit.n, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(listed.n, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(hit.n, 0) > 0 AS contaminated
FROM doc_words LEFT JOIN hit USING (r) LEFT JOIN listed USING (r)
"""


_OP4 = rf"""
WITH RECURSIVE words AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (
  SELECT r, doc_id, list_sort(list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
         ELSE list_transform(range(0, len(w) - 3), lambda i: array_to_string(w[i + 1:i + 4], ' ')) END)) AS s FROM words),
sized AS (
  SELECT r, doc_id, s, len(s) AS n, CASE WHEN len(s) = 0 THEN 1 ELSE count(*) OVER (PARTITION BY s) END AS set_copies FROM sets),
members AS (SELECT r, n, unnest(s) AS shingle FROM sized),
pairs AS (
  SELECT a.r AS x, b.r AS y FROM members a JOIN members b ON a.shingle = b.shingle AND a.r <> b.r
  GROUP BY a.r, b.r, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
reach AS (SELECT r AS x, r AS y FROM sized UNION SELECT reach.x, pairs.y FROM reach JOIN pairs ON reach.y = pairs.x)
SELECT sized.doc_id, CAST(any_value(sized.n) AS BIGINT) AS n_shingles, min(o.doc_id) AS component_id,
       CAST(any_value(sized.set_copies) AS BIGINT) AS set_copies
FROM reach JOIN sized ON sized.r = reach.x JOIN sized o ON o.r = reach.y GROUP BY sized.r, sized.doc_id
"""


def _op8() -> str:
    from plyscope.llm.secrets import COMPLEMENT, KINDS, NUMBER, SCOPE
    quoted = {k: v[0].replace("'", "''") for k, v in KINDS.items()}
    counts = {"assign": f"length(regexp_extract(m, '{quoted['assign']}', 2)) >= 6",
              "private": "regexp_matches(m, '[0-9]') AND regexp_matches(m, '[a-z]') AND regexp_matches(m, '[A-Z]')"}
    found = " UNION ALL ".join(f"""
      SELECT r, '{k}' AS name, {NUMBER[k]} AS kind, '{v[1]}' AS role, ends - length(m) AS s, ends AS e FROM (
        SELECT r, m, sum(gap + length(m)) OVER (PARTITION BY r ORDER BY i) AS ends FROM (
          SELECT r, unnest(range(1, len(hits) + 1)) AS i, unnest(hits) AS m,
                 unnest(list_transform(gaps[1:len(hits)], lambda g: length(g))) AS gap
          FROM (SELECT r, regexp_extract_all(t, '{quoted[k]}') AS hits, string_split_regex(t, '{quoted[k]}') AS gaps FROM docs)))
      WHERE {counts.get(k, "true")}""" for k, v in KINDS.items())
    needs = " OR ".join(f"(w.name = '{k}' AND o.role IN ({', '.join(repr(x) for x in v)}))" for k, v in COMPLEMENT.items())
    return f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
found AS MATERIALIZED ({found}),
weak AS (SELECT * FROM found w WHERE kind >= 3 AND NOT EXISTS (
  SELECT 1 FROM found b WHERE b.r = w.r AND b.kind < 3 AND b.s < w.e AND b.e > w.s)),
parts AS (SELECT * FROM found WHERE kind < 3 UNION ALL SELECT * FROM weak),
spans AS (SELECT * FROM found WHERE kind < 3 UNION ALL
  SELECT * FROM weak w WHERE EXISTS (SELECT 1 FROM parts o WHERE o.r = w.r AND abs(o.s - w.s) <= {SCOPE} AND ({needs}))),
per AS (SELECT r, count(*) FILTER (name = 'assign') AS a, count(*) FILTER (name = 'access') AS c,
  count(*) FILTER (name = 'hex') AS h, count(*) FILTER (kind >= 3) AS l,
  string_agg(name || ':' || s || ':' || e, ',' ORDER BY s, kind) FILTER (kind < 3) AS base,
  string_agg(name || ':' || s || ':' || e, ',' ORDER BY s, kind) AS spans FROM spans GROUP BY r)
SELECT doc_id, coalesce(a, 0) AS n_assign, coalesce(c, 0) AS n_access, coalesce(h, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(l, 0) AS n_linked
FROM docs LEFT JOIN per USING (r)
"""


# crc32 bit by bit: a list of steps, for each byte its value and then eight shifts (-1)
_CRC32 = """CAST(xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(regexp_extract_all(hex(encode({})), '..'),
  lambda b: list_prepend(('0x' || b)::BIGINT, [-1::BIGINT, -1, -1, -1, -1, -1, -1, -1])))),
  lambda c, s: CASE WHEN s >= 0 THEN xor(c, s) ELSE xor(c >> 1, 3988292384 * (c & 1)) END), 4294967295) AS BIGINT)"""

_OP12 = rf"""
WITH RECURSIVE runs AS (
  SELECT id, run, count(*) AS times FROM (
    SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id, unnest(regexp_extract_all({_LOWER}, '[A-Za-zÀ-ÿ]+')) AS run FROM documents)
  WHERE length(run) >= 6 GROUP BY ALL),
hashed AS (SELECT run, times, {_CRC32.format("id || ':' || run")} AS h FROM runs),
words AS (
  SELECT word, CAST(sum(times) AS BIGINT) AS n FROM (
    SELECT times, CASE WHEN h % 199 = 0 THEN run[:h % length(run)] || run[h % length(run) + 2:] ELSE run END AS word FROM hashed)
  WHERE length(word) >= 6 GROUP BY word HAVING sum(times) >= 5),
-- words one edit apart share a word itself or what is left of it after one deletion
left_over AS (
  SELECT word, n, unnest(list_distinct(list_prepend(word, list_transform(range(0, length(word)), lambda i: word[:i] || word[i + 2:])))) AS rest
  FROM words),
near AS (
  SELECT DISTINCT a.word, b.word AS other, b.n AS other_n FROM left_over a JOIN left_over b USING (rest)
  WHERE a.word <> b.word AND CASE abs(length(a.word) - length(b.word))
    WHEN 0 THEN len(list_filter(range(1, length(a.word) + 1), lambda i: a.word[i] <> b.word[i])) = 1 WHEN 1 THEN true ELSE false END),
best AS (SELECT word, count(*) AS n_near, min({{'less': -other_n, 'bytes': encode(other), 'other': other}}) AS top FROM near GROUP BY word),
formed AS (
  SELECT w.word, n, coalesce(n_near, 0) AS n_near, CASE WHEN -top.less >= 5 * n THEN top.other END AS form,
         CASE WHEN -top.less >= 5 * n THEN -top.less END AS form_n FROM words w LEFT JOIN best USING (word)),
chain AS (
  SELECT word, word AS latest FROM formed UNION ALL
  SELECT chain.word, formed.form FROM chain JOIN formed ON chain.latest = formed.word WHERE formed.form IS NOT NULL)
SELECT f.word, f.form, c.latest AS root, f.n, CAST(f.n_near AS BIGINT) AS n_near, CAST(f.form_n AS BIGINT) AS form_n
FROM formed f JOIN chain c ON c.word = f.word JOIN formed l ON l.word = c.latest AND l.form IS NULL
"""

_OP13 = """
WITH payloads AS (SELECT row_number() OVER () AS r, page_id, coalesce(html, '') AS body FROM pages),
digests AS (
  SELECT page_id, octet_length(encode(body)) AS payload_bytes, sha1(body) AS hex,
         row_number() OVER (PARTITION BY body ORDER BY page_id DESC NULLS LAST, r DESC) AS place,
         max(page_id) OVER (PARTITION BY body) AS latest FROM payloads)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes,
  -- base32: five hexadecimal digits are four characters
  array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    CAST(1 + ((('0x' || substr(hex, 5 * (i // 4) + 1, 5))::BIGINT >> (15 - 5 * (i % 4))) & 31) AS BIGINT), 1)), '') AS payload_digest,
  CASE place WHEN 1 THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN place > 1 THEN latest END AS refers_to
FROM digests
"""

SQL: dict[str, str] = {"op1_decontaminate": _OP1, "op4_ngram_jaccard": _OP4, "op8_secrets": _op8(),
                       "op12_spelling_variants": _OP12, "op13_warc": _OP13}
