"""Spelling variant grouping by pivotal grams (operator 12).

Words one edit apart are found without comparing all words. The bigrams of a word are ordered by how
rare they are in the vocabulary; the three rarest (and others equal to the third) are its prefix. Two
disjoint bigrams of the prefix, chosen by dynamic programming for the least total frequency, are its
pivots. One edit touches at most one of two disjoint bigrams. So, of two words one edit apart, the one
whose prefix ends with the rarer bigram has an untouched pivot, and that bigram stands in the other's prefix.

Position limits. An edit beside an untouched bigram lies wholly after it or wholly before it: then all
up to the bigram, or all from the bigram on, is the same in both words. The index key of a bigram is
therefore the whole beginning of the word that ends with it, or the whole rest that starts with it:
pivots are looked up under these keys among the other words' prefixes, and candidates are verified by their edit distance.

Words are counted by a map-side combined aggregate. Collected are only bigram frequencies: the letters
allowed give at most 90 * 90 bigrams. A chain of forms grows in n at least fivefold a step, so the last
form is reached by doubling in at most five rounds, whatever the data.

Results: null texts have no words; a null doc_id counts as the empty string in the hash; repeated rows count each.
Texts without letters, or an empty table, give no rows. Long texts are whole. Ties: see the contract. Other
columns are not read.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plyscope.llm.common import ascii_lower, prepare, written

LEAST_POINTS, LEAST_COUNT, DELETE_EVERY, RATIO = 6, 5, 199, 5
#: fixed values: the letters of a word
LETTERS = "A-Za-zÀ-ÿ"
PIVOTS, GRAM = 2, 2


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_points: int = LEAST_POINTS,
                least_count: int = LEAST_COUNT, delete_every: int = DELETE_EVERY) -> DataFrame:
    """(word, n): runs of letters, A-Z lowered; of the runs whose hash ``delete_every`` divides, one
    letter is deleted. Shorter and rarer words are left out."""
    # a run of fewer letters gives no word; a longer run is matched as a whole
    runs = F.regexp_extract_all(ascii_lower(F.col(text_col)), F.lit(f"[{LETTERS}]{{{least_points},}}"), F.lit(0))
    each = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), F.explode(runs).alias("run"))
    h = F.crc32(F.concat("id", F.lit(":"), "run").cast("binary"))
    at = (h % F.length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), at), F.substring(F.col("run"), at + 2, F.length("run")))
    words = each.select(F.when(h % delete_every == 0, cut).otherwise(F.col("run")).alias("word"))
    return (words.filter(F.length("word") >= least_points).groupBy("word").agg(F.count("*").alias("n"))
            .filter(F.col("n") >= least_count))


def pivots(grams: list[tuple]) -> list[tuple]:
    """The ``PIVOTS`` disjoint of some (frequency, gram, position) of the least total frequency, by
    dynamic programming over the positions; of equal totals the leftmost."""
    grams = sorted(grams, key=lambda g: g[2])
    best = [[(0, ())] * (len(grams) + 1)] + [[None] * (len(grams) + 1) for _ in range(PIVOTS)]
    for i, gram in enumerate(grams):
        before = next((j for j in range(i, 0, -1) if grams[j - 1][2] + GRAM <= gram[2]), 0)
        for k in range(1, PIVOTS + 1):
            with_it = best[k - 1][before]
            taken = (with_it[0] + gram[0], with_it[1] + (gram,)) if with_it is not None and len(with_it[1]) == k - 1 else None
            best[k][i + 1] = min((x for x in (best[k][i], taken) if x is not None), key=lambda x: x[0], default=None)
    return list(best[PIVOTS][-1][1])


def gram_keys(word: str, freq: dict[str, int]) -> list[tuple[str, bool]]:
    """Index keys of a word's prefix bigrams, and whether the bigram is a pivot."""
    grams = sorted((freq[word[i:i + GRAM]], word[i:i + GRAM], i) for i in range(len(word) - GRAM + 1))
    last = grams[GRAM * (PIVOTS - 1)][:2]
    prefix = [g for g in grams if g[:2] <= last]
    chosen = {p[2] for p in pivots(prefix)}
    return [(key, i in chosen) for _, _, i in prefix for key in ("<" + word[:i + GRAM], ">" + word[i:])]


def near_words(words: DataFrame) -> DataFrame:
    """(word, other): all ordered pairs of the words that are exactly one edit apart. Words have at
    least four code points."""
    prepare(words.sparkSession)
    grams = F.transform(F.sequence(F.lit(1), F.length("word") - 1), lambda i: F.substring(F.col("word"), i, F.lit(GRAM)))
    freq = {r["gram"]: r["n"] for r in words.select(F.explode(grams).alias("gram")).groupBy("gram").agg(F.count("*").alias("n")).collect()}

    def run(batches):
        for batch in batches:
            out = [(w, k, p) for w in batch.column("word").to_pylist() for k, p in gram_keys(w, freq)]
            cols = zip(*out) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.string(), pa.bool_()))],
                                             ["word", "key", "pivot"])

    parts = int(words.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    index = written(words.select("word").repartition(parts, "word").mapInArrow(run, "word string, key string, pivot boolean"))
    left = index.filter("pivot").select("key", F.col("word").alias("a"))
    right = index.select("key", F.col("word").alias("b"))
    close = ((F.col("a") != F.col("b")) & (F.abs(F.length("a") - F.length("b")) <= 1)
             & (F.levenshtein("a", "b", 1) == 1))
    found = left.join(right, "key").filter(close).select(
        F.explode(F.array(F.struct(F.col("a").alias("word"), F.col("b").alias("other")),
                          F.struct(F.col("b").alias("word"), F.col("a").alias("other")))).alias("p"))
    return found.select("p.*").distinct()


def last_forms(forms: DataFrame) -> DataFrame:
    """(word, root): the last form of each word that has a form, by doubling the steps."""
    root = written(forms.select("word", F.col("form").alias("root")))
    for _ in range(5):      # 32 steps; n grows fivefold a step, so there are at most 27
        ahead = root.select(F.col("word").alias("__at"), F.col("root").alias("__to"))
        moved = written(root.join(ahead, root["root"] == ahead["__at"], "left").select(
            "word", F.coalesce("__to", "root").alias("root"), F.col("__to").isNotNull().alias("moved")))
        root = moved.select("word", "root")
        if moved.filter("moved").isEmpty():
            break
    return root


def variant_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ratio: int = RATIO, **options) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word of the corpus."""
    words = written(word_counts(docs, id_col, text_col, **options))
    near = near_words(words).join(words.select(F.col("word").alias("other"), F.col("n").alias("other_n")), "other")
    per = near.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("minus_n"), "other")).alias("top"))
    joined = written(words.join(per, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.col("top.other").alias("form"),
        (-F.col("top.minus_n")).alias("form_n")))
    strong = F.col("form_n") >= ratio * F.col("n")
    joined = joined.withColumns({"form": F.when(strong, F.col("form")), "form_n": F.when(strong, F.col("form_n"))})
    roots = last_forms(joined.filter(F.col("form").isNotNull()))
    return joined.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
