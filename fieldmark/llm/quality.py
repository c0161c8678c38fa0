"""Quality rules: counts over each whole text, and a likelihood ratio of hashed n-grams.

Two multinomials over hashed n-grams are compared: the trusted target, made of
documents labelled good, and the raw corpus, made of all documents.  The mean
log ratio of a document's n-grams is its score; a document under the threshold is
rejected.  Everything is DataFrame functions; no Python runs on the executors.

Defined cases.  A null text has no words.  A text with fewer words than
``min_words`` or too many repeated words fails the base rules whatever its score.
Without n-grams the score is 0.  Without trusted documents every ratio is about 0,
so only the base rules decide.  Rows are judged one by one: repeated rows, null ids
and further columns change nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldmark.session import settle

SPACES = "\t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"  # also the inside of a character class
WINDOW = 8

#: log2 of the number of n-gram buckets: bounds both multinomials, whatever the corpus.
BITS = 16
#: Expected trusted count below which a bucket says little.
SHRINK = 10.0
#: Lengths in words of the n-grams: words and pairs of words.
ORDERS = (1, 2)
#: Mean log ratio under which a document is rejected.
LEAST = -0.15
#: Labelled documents that the trusted multinomial is fitted on, at most: those of smallest hash.
TRUSTED = 16_384


def word_array(text: Column) -> Column:
    """Words of a text as an array; empty for null."""
    blank = F.translate(F.coalesce(text, F.lit("")), SPACES, " " * len(SPACES))
    return F.array_remove(F.split(blank, " "), "")


def _bucket(hashed: Column) -> Column:
    return F.shiftrightunsigned(hashed, 64 - BITS).cast("int")


def _runs(hashes: Column, n: int) -> Column:
    """A hash of each run of n words, from the words' own hashes."""
    at = F.when(F.size(hashes) >= n, F.sequence(F.lit(0), F.size(hashes) - n)).otherwise(F.array().cast("array<int>"))
    return F.transform(at, lambda i: F.xxhash64(*[F.get(hashes, i + k) for k in range(n)]))


def _grams(hashes: Column, orders: Sequence[int]) -> Column:
    """Buckets of all n-grams of the given orders."""
    parts = [F.transform(hashes if n == 1 else _runs(hashes, n), _bucket) for n in orders]
    return parts[0] if len(parts) == 1 else F.concat(*parts)


def trusted_ids(labels: DataFrame, id_col: str, good: Column, most: int = TRUSTED) -> DataFrame:
    """Ids of at most ``most`` documents labelled good, those of smallest hash."""
    ids = labels.where(good & F.col(id_col).isNotNull()).select(F.col(id_col).alias("__id")).distinct()
    return ids.orderBy(F.xxhash64("__id"), "__id").limit(most)


def log_ratios(docs: DataFrame, trusted: DataFrame, id_col: str, text_col: str, orders: Sequence[int]) -> DataFrame:
    """One row: the array of log ratios by bucket.  Counts run over every n-gram of every document."""
    hashed = F.transform(word_array(F.col(text_col)), lambda w: F.xxhash64(w))
    marked = docs.select(F.col(id_col).alias("__id"), hashed.alias("hashes")).join(
        # at most ``TRUSTED`` ids, so that their size is bounded
        F.broadcast(trusted.withColumn("good", F.lit(1))), "__id", "left"
    )
    # at most one row per bucket; stored, so that totals and ratios read the texts only once
    counts = settle(
        marked.select(F.explode(_grams(F.col("hashes"), orders)).alias("bucket"), F.coalesce("good", F.lit(0)).alias("good"))
        .groupBy("bucket")
        .agg(F.count("*").cast("double").alias("raw"), F.sum("good").cast("double").alias("trusted"))
    )
    totals = counts.agg(F.sum("trusted").alias("all_trusted"), F.sum("raw").alias("all_raw")).select(
        F.coalesce(F.try_divide("all_trusted", "all_raw"), F.lit(0.0)).alias("share")
    )
    every = docs.sparkSession.range(1 << BITS).select(F.col("id").cast("int").alias("bucket"))
    expected = F.coalesce("raw", F.lit(0.0)) * totals.scalar()
    ratio = F.log((F.coalesce("trusted", F.lit(0.0)) + SHRINK) / (expected + SHRINK))
    pairs = every.join(counts, "bucket", "left").agg(F.sort_array(F.collect_list(F.struct("bucket", ratio.alias("ratio")))).alias("p"))
    return pairs.select(F.col("p.ratio").cast("array<float>").alias("ratios"))


def _judged(rows: DataFrame, ratios: DataFrame, orders: Sequence[int], min_words: int, repeat_percent: int, least: float) -> DataFrame:
    """``rows`` has ``row`` and ``text``; gives ``row`` and the columns of the verdict."""
    text = F.coalesce("text", F.lit(""))
    word_lines = F.filter(F.split(text, "\n"), lambda s: s.rlike("[^\\x20\\x09-\\x0D]"))
    first = rows.select(
        "row",
        word_array(F.col("text")).alias("words"),
        word_lines.alias("lines"),
        F.regexp_count(text, F.lit(f"[{SYMBOLS}]")).cast("long").alias("n_symbols"),
    )
    first = first.select(
        "row", "n_symbols",
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.transform("words", lambda w: F.xxhash64(w)).alias("words"),
    )
    second = first.select(
        "row", "word_chars", "n_symbols", "n_dup_lines",
        F.size("words").alias("n"),
        _runs(F.col("words"), WINDOW).alias("hashes"),
        _grams(F.col("words"), orders).alias("grams"),
    )
    # only texts that repeat a window pay for sorting
    third = second.select(
        "row", "word_chars", "n_symbols", "n", "n_dup_lines", "grams",
        F.when(
            F.size(F.array_distinct("hashes")) < F.size("hashes"),
            F.array_sort(F.transform("hashes", lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
        ).alias("sorted"),
    )
    same = lambda a, b: F.coalesce(F.get("sorted", a)["h"] == F.get("sorted", b)["h"], F.lit(False))
    twice = F.filter(F.sequence(F.lit(0), F.size("sorted") - 1), lambda k: same(k - 1, k) | same(k, k + 1))
    fourth = third.select(
        "row", "word_chars", "n_symbols", "n", "n_dup_lines", "grams",
        F.when(F.col("sorted").isNotNull(), F.array_sort(F.transform(twice, lambda k: F.get("sorted", k)["i"]))).alias("at"),
    )
    gaps = F.when(F.size("at") > 1, F.transform(F.sequence(F.lit(1), F.size("at") - 1), lambda k: F.get("at", k) - F.get("at", k - 1)))
    covered = F.aggregate(F.coalesce(gaps, F.array().cast("array<int>")), F.lit(WINDOW).cast("long"), lambda a, g: a + F.least(g, F.lit(WINDOW)))
    fifth = fourth.withColumn("ratios", ratios.scalar()).select(
        "row", "word_chars", "n_symbols", "n_dup_lines",
        F.col("n").cast("long").alias("n_words"),
        F.when(F.col("at").isNotNull(), covered).otherwise(F.lit(0).cast("long")).alias("n_repeat_words"),
        F.size("grams").alias("n_grams"),
        F.aggregate("grams", F.lit(0.0), lambda a, b: a + F.get("ratios", b)).alias("total"),
    )
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > repeat_percent * F.col("n_words"))
    score = F.when(F.col("n_grams") > 0, F.col("total") / F.col("n_grams")).otherwise(F.lit(0.0))
    # always true; not being deterministic it keeps a caller's filter above, which else would be
    # pushed down with all the steps written out in it, again and again
    here = F.monotonically_increasing_id() >= 0
    return fifth.select(
        "row", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), (~failed & (score >= least) & here).alias("kept"), score.alias("score"),
    )


def quality_rules(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    good: Column | None = None,
    orders: Sequence[int] = ORDERS,
    min_words: int = 20,
    repeat_percent: int = 30,
    least: float = LEAST,
) -> DataFrame:
    """Each row of ``docs`` as struct ``row``, with its counts, score and verdict.

    ``labels`` marks trusted documents by ``good`` (by default ``quality = 1``); an
    order of n-grams is a length in words.
    """
    trusted = trusted_ids(labels, id_col, F.col("quality") == 1 if good is None else good)
    ratios = log_ratios(docs, trusted, id_col, text_col, orders)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(text_col).alias("text"))
    return _judged(rows, ratios, orders, min_words, repeat_percent, least)
