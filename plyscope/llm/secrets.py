"""Secret scan with multipart credential linking (operator 8), in DataFrame functions only.

Base kinds are found by their patterns alone: ``assign`` (a named value), ``access`` (an access key
id) and ``hex`` (a long lower-case hexadecimal run). Weak candidates say little alone: ``ident`` (a
named user or client), ``private`` (a long run of mixed letters and digits) and ``endpoint`` (an
address). Each kind plays a role: identifier, secret or endpoint. A weak candidate is reported only
when a complementary part starts within ``SCOPE`` code points: an identifier or an endpoint needs a
secret, a private run needs an identifier or an endpoint. A candidate that overlaps a base span is
not a candidate.

Spark has no match positions, so a text is split at a pattern as well as searched for it: the lengths
of gaps and matches, summed up, are the positions. The interval join runs on cells of ``SCOPE`` code
points: the parts of a role in a cell are reduced to the first and the last start, and a candidate
looks into its own cell and the two beside it, so pairs of parts are never listed.

Results: a null text is empty; an empty text has no spans (and the SHA-256 of the empty text).
Repeated rows are answered each on its own; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from plyscope.llm.common import RID, id_text, if_small, with_rid, written

SCOPE = 400


def either_case(words: list[str]) -> str:
    """A pattern for the words with letters in either case, spelled out so that every engine agrees."""
    spelled = ["".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in w) for w in words]
    return "(" + "|".join(spelled) + ")"


_SEP = r"""["']?\x20*[:=]\x20*["']?"""
ASSIGN = either_case(["password", "passwd", "secret", "token", "api_?key"]) + _SEP + "([A-Za-z0-9+/_.=-]+)"
IDENT = either_case(["client_?id", "access_?key_?id", "user_?name", "user", "login", "account"]) + _SEP + "([A-Za-z0-9_.@+-]+)"
#: kind: (pattern, role, minimal length of the match, weak). The length of assign is its second group's.
KINDS = {
    "assign": (ASSIGN, "secret", 6, False),
    # runs are maximal, so asking for the least length in the pattern drops just the short matches
    "access": (r"AKIA[A-Z0-9]{16,}", "identifier", 20, False),
    "hex": (r"[0-9a-f]{24,}", "secret", 24, False),
    "ident": (IDENT, "identifier", 0, True),
    "private": (r"[A-Za-z0-9+/_-]{20,}", "secret", 20, True),
    "endpoint": (r"[a-z][a-z0-9+]{1,11}://[A-Za-z0-9_.:@/?&=%+-]+", "endpoint", 0, True),
}
COMPLEMENT = {"ident": ["secret"], "private": ["identifier", "endpoint"], "endpoint": ["secret"]}
NUMBER = {k: i for i, k in enumerate(KINDS)}


def _long_enough(kind: str, m: Column) -> Column:
    pattern = KINDS[kind][0]
    if kind == "assign":
        return F.length(F.regexp_extract(m, pattern, 2)) >= KINDS[kind][2]
    if kind == "private":
        return m.rlike("[0-9]") & m.rlike("[a-z]") & m.rlike("[A-Z]")
    return F.length(m) >= KINDS[kind][2]


def _matches(kind: str) -> Column:
    """Array of (kind number, index, gap before, length, whether it counts) of a kind's matches."""
    text, pattern = F.col("text"), KINDS[kind][0]
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    made = F.transform(F.arrays_zip(gaps.alias("g"), hits.alias("m")), lambda x, i: F.struct(
        F.lit(NUMBER[kind]).alias("kind"), i.alias("i"), F.length(x["g"]).alias("gap"),
        F.length(x["m"]).alias("length"), _long_enough(kind, x["m"]).alias("counts")))
    none = F.array().cast("array<struct<kind:int,i:int,gap:int,length:int,counts:boolean>>")
    return F.when(text.rlike(pattern), F.filter(made, lambda x: x["length"].isNotNull())).otherwise(none)


def find_spans(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rid, doc_id) of every row, and its spans (rid, kind, start, end), in code points."""
    base = docs.select("doc_id", "text")
    rows = with_rid(base.select("doc_id", F.concat(*[_matches(k) for k in KINDS]).alias("found")))
    by_kind = W.partitionBy(RID, "kind").orderBy("i").rowsBetween(W.unboundedPreceding, 0)
    end = F.sum(F.col("gap") + F.col("length")).over(by_kind)
    parts = (rows.filter(F.size("found") > 0).select(RID, F.inline("found")).withColumn("end", end)
             .filter("counts").select(RID, "kind", (F.col("end") - F.col("length")).alias("start"), "end"))
    names = F.array(*[F.lit(k) for k in KINDS])
    roles = F.array(*[F.lit(v[1]) for v in KINDS.values()])
    parts = parts.select(RID, F.element_at(names, F.col("kind") + 1).alias("name"), "kind",
                         F.element_at(roles, F.col("kind") + 1).alias("role"), "start", "end")
    weak = F.col("kind") >= NUMBER["ident"]
    # candidates that overlap a base span are not candidates
    ordered = W.partitionBy(RID).orderBy("start", "kind")
    reach = F.max(F.when(~weak, F.col("end"))).over(ordered.rowsBetween(W.unboundedPreceding, -1))
    ahead = F.min(F.when(~weak, F.col("start"))).over(ordered.rowsBetween(1, W.unboundedFollowing))
    parts = written(parts.withColumn("reach", reach).withColumn("ahead", ahead)
                    .filter(~weak | ((F.coalesce("reach", F.lit(0)) <= F.col("start")) & (F.coalesce("ahead", F.col("end")) >= F.col("end"))))
                    .drop("reach", "ahead"))
    strong, loose = parts.filter(~weak), parts.filter(weak)
    cells = parts.groupBy(RID, "role", F.floor(F.col("start") / SCOPE).alias("cell")).agg(
        F.min("start").alias("low"), F.max("start").alias("high"))
    wanted = F.create_map(*[x for k, v in COMPLEMENT.items() for x in (F.lit(k), F.array(*map(F.lit, v)))])
    asked = (loose.withColumn("role", F.explode(F.element_at(wanted, F.col("name"))))
             .withColumn("cell", F.floor(F.col("start") / SCOPE))
             .withColumn("cell", F.explode(F.sequence(F.col("cell") - 1, F.col("cell") + 1))))
    near = (F.abs(F.col("low") - F.col("start")) <= SCOPE) | (F.abs(F.col("high") - F.col("start")) <= SCOPE)
    linked = asked.join(cells, [RID, "role", "cell"]).filter(near).select(RID, "name", "kind", "start", "end").distinct()
    return rows.select(RID, "doc_id"), strong.select(RID, "name", "kind", "start", "end").unionByName(linked)


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["name"], s["start"], s["end"])), ",")


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_linked."""
    rows, spans = find_spans(id_text(docs, id_col, text_col))
    count = lambda k: F.count_if(F.col("name") == k).alias(f"n_{k}")
    per = spans.groupBy(F.col(RID).alias("r")).agg(
        count("assign"), count("access"), count("hex"), F.count_if(F.col("kind") >= NUMBER["ident"]).alias("n_linked"),
        F.sort_array(F.collect_list(F.struct("start", "kind", "end", "name"))).alias("all"))
    zero, none = F.lit(0).cast("long"), F.lit("")
    base = F.filter("all", lambda s: s["kind"] < NUMBER["ident"])
    return rows.join(per, rows[RID] == per["r"], "left").select(
        "doc_id", *[F.coalesce(c, zero).alias(c) for c in ("n_assign", "n_access", "n_hex")],
        F.sha2(F.coalesce(_joined(base), none), 256).alias("base_sha256"),
        F.coalesce(_joined(F.col("all")), none).alias("spans"), F.coalesce("n_linked", zero).alias("n_linked"))


def redact(docs: DataFrame, mark: str = "[SECRET]", text_col: str = "text") -> DataFrame:
    """``docs`` with every span in the text replaced by ``mark`` (touching or overlapping spans by
    one), and the column ``__redacted``. ``docs`` must hold a unique ``__rid``. Rows without spans, null
    texts too, stay as they are."""
    _, spans = find_spans_by(docs, text_col)
    before = W.partitionBy(RID).orderBy("start", "end").rowsBetween(W.unboundedPreceding, -1)
    upto = W.partitionBy(RID).orderBy("start", "end").rowsBetween(W.unboundedPreceding, 0)
    runs = (spans.withColumn("fresh", (F.col("start") > F.coalesce(F.max("end").over(before), F.lit(-1))).cast("int"))
            .withColumn("run", F.sum("fresh").over(upto))
            .groupBy(RID, "run").agg(F.min("start").alias("start"), F.max("end").alias("end")))
    cuts = runs.groupBy(F.col(RID).alias("__r")).agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("__cuts"))
    text, cut = F.col(text_col), F.col("__cuts")
    # pieces between the cuts: from the end of the cut before (0 at first) to the next start
    ends = F.concat(F.array(F.lit(0).cast("long")), F.transform(cut, lambda c: c["end"]))
    starts = F.concat(F.transform(cut, lambda c: c["start"]), F.array(F.length(text).cast("long")))
    pieces = F.transform(F.arrays_zip(ends.alias("e"), starts.alias("s")),
                         lambda p: F.substring(text, (p["e"] + 1).cast("int"), (p["s"] - p["e"]).cast("int")))
    cuts = if_small(written(cuts), 100_000)
    out = docs.join(cuts, docs[RID] == F.col("__r"), "left")
    return out.withColumn(text_col, F.when(cut.isNotNull(), F.array_join(pieces, mark)).otherwise(text)).withColumn("__redacted", cut.isNotNull()).drop("__r", "__cuts")


def find_spans_by(docs: DataFrame, text_col: str) -> tuple[DataFrame, DataFrame]:
    """As ``find_spans``, with the rows' own ``__rid`` in place of a new one."""
    rows, spans = find_spans(id_text(docs, RID, text_col))
    own = rows.select(F.col(RID).alias("r"), F.col("doc_id").alias("own"))
    return rows, spans.join(own, spans[RID] == own["r"]).drop(RID, "r").withColumnRenamed("own", RID)
