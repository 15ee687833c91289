"""Quality rules: fixed counts of every text, and a hashed n-gram log-likelihood ratio.

Two multinomials over ``buckets`` hashed word n-grams are counted, one over the trusted documents and one over
the whole corpus. A document's score is the mean over its n-grams of ``ln(p_trusted / p_raw)``; it is rejected
below ``threshold``. The ratio table has ``buckets`` rows whatever the corpus, so it can be broadcast; the
trusted documents are at most ``trusted_limit``, those of lowest hashed id.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from machpulse.llm.text import SPACE_CHARS, whole, words
from machpulse.sources.storage import stored

SYMBOLS = "#*$%&|<>"
HAS_WORD = r"[^\x20\x09-\x0D]"


def _repeats(frame: DataFrame) -> DataFrame:
    """Adds ``_repeat``: the words that lie in a 3-word window found at least twice in the text.

    Windows are compared by 64-bit hash. Only texts with a repeated window are sorted, so the cost of a text
    is linear or one sort, never a comparison of all windows.
    """
    last = F.greatest(F.size("_words") - 2, F.lit(0))
    hashed = F.slice(
        F.transform(
            F.arrays_zip(
                F.col("_words").alias("a"),
                F.slice("_words", 2, F.greatest(F.size("_words"), F.lit(1))).alias("b"),
                F.slice("_words", 3, F.greatest(F.size("_words"), F.lit(1))).alias("c"),
            ),
            lambda z: F.xxhash64(z),
        ),
        1,
        last,
    )
    frame = frame.withColumn("_windows", hashed)
    some = F.size(F.array_distinct("_windows")) < F.size("_windows")
    ordered = F.array_sort(F.transform("_windows", lambda x, i: F.struct(x.alias("x"), i.alias("i"))))
    frame = frame.withColumn("_ordered", F.when(some, ordered))
    same = F.filter(
        "_ordered",
        lambda e, i: F.coalesce(F.get("_ordered", i - 1)["x"] == e["x"], F.lit(False))
        | F.coalesce(F.get("_ordered", i + 1)["x"] == e["x"], F.lit(False)),
    )
    covered = F.flatten(F.transform(same, lambda e: F.array(e["i"], e["i"] + 1, e["i"] + 2)))
    repeat = F.coalesce(F.when(F.col("_ordered").isNotNull(), F.size(F.array_distinct(covered))), F.lit(0))
    return frame.withColumn("_repeat", repeat.cast("long")).drop("_windows", "_ordered")


def _grams(n: int) -> Column:
    """All runs of up to ``n`` words, joined by a blank."""
    runs, longer = F.col("_words"), F.col("_words")
    for k in range(2, n + 1):
        rest = F.slice("_words", k, F.greatest(F.size("_words"), F.lit(1)))
        longer = F.zip_with(F.slice(longer, 1, F.size(rest)), rest, lambda a, b: F.concat_ws(" ", a, b))
        runs = F.concat(runs, longer)
    return runs


def _bucket(word, buckets: int) -> Column:
    return F.pmod(F.xxhash64(word), F.lit(buckets)).cast("int")


def ratio_table(
    docs: DataFrame, labels: DataFrame, id_col="doc_id", text_col="text", label_col="quality", buckets=1 << 16,
    trusted_limit=20_000, n=1,
) -> DataFrame:
    """``bucket, ratio``: natural log of trusted over raw probability, both with one added to every count; 0 without trusted words."""
    trusted = (
        labels.filter(F.col(label_col) == 1).select(F.col(id_col).alias("_trusted")).filter("_trusted IS NOT NULL").distinct()
        .orderBy(F.xxhash64("_trusted"), "_trusted").limit(trusted_limit)
    )
    pieces = docs.select(F.col(id_col).alias("_id"), words(text_col).alias("_words")).join(
        F.broadcast(trusted), F.col("_id") == F.col("_trusted"), "left"
    )
    counts = (
        pieces.select(F.col("_trusted").isNotNull().cast("long").alias("_is"), F.explode(_grams(n)).alias("_word"))
        .select(_bucket("_word", buckets).alias("bucket"), "_is")
        .groupBy("bucket").agg(F.count(F.lit(1)).alias("_raw"), F.sum("_is").alias("_good"))
    )
    counts = stored(counts, "quality-counts")
    totals = counts.agg(F.sum("_raw").alias("_raws"), F.sum("_good").alias("_goods")).first()
    if not totals["_goods"]:
        return counts.select("bucket", F.lit(0.0).alias("ratio"))
    raws, goods = totals["_raws"] + buckets, totals["_goods"] + buckets
    ratio = F.ln((F.col("_good") + 1) / F.lit(float(goods))) - F.ln((F.col("_raw") + 1) / F.lit(float(raws)))
    return counts.select("bucket", ratio.alias("ratio"))


def judge(
    docs: DataFrame, labels: DataFrame, id_col="doc_id", text_col="text", label_col="quality", buckets=1 << 16,
    trusted_limit=20_000, n=1, threshold=-0.25, carry: tuple[str, ...] = (),
) -> DataFrame:
    """One row per input row: ``id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, score, kept``.

    ``base_failed``: under 50 words, or more than half of the words in repeated 3-word windows. ``kept`` is false
    for these and for scores below ``threshold``. Null and empty texts have no words and fail. Without trusted
    words there is nothing to compare with: every ratio is 0 and only the counts reject. Repeated rows are judged each. Columns named
    in ``carry`` (short ones: they travel with every word) are handed on; others are ignored. An empty table gives none.
    """
    ratios = ratio_table(docs, labels, id_col, text_col, label_col, buckets, trusted_limit, n)
    text = F.col("_text")
    lines = F.filter(F.split(text, "\n", -1), lambda line: line.rlike(HAS_WORD))
    frame = docs.select(
        F.monotonically_increasing_id().alias("_row"), F.col(id_col).alias("_id"), whole(text_col).alias("_text"),
        *[F.col(c).alias(f"_c{i}") for i, c in enumerate(carry)],
    ).withColumn("_words", words("_text")).withColumn("_lines", lines)
    frame = _repeats(frame)
    held = [f"_c{i}" for i in range(len(carry))]
    # The facts come out of a generator: a filter on them would otherwise be pushed into their making, where a
    # function inside a function would work out the sorted windows again for every window.
    made = F.struct(
        F.size("_words").cast("long").alias("n_words"),
        F.length(F.translate(text, SPACE_CHARS, "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.col("_repeat").alias("n_repeat_words"),
    )
    base = frame.select(*held, "_row", "_id", "_words", F.inline(F.array(made)))
    facts = [*held, "_row", "_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    scored = (
        base.select(*facts, F.explode_outer(_grams(n)).alias("_word"))
        .withColumn("_bucket", _bucket("_word", buckets))
        .join(F.broadcast(ratios), F.col("_bucket") == F.col("bucket"), "left")
        .groupBy(*facts).agg(F.sum("ratio").alias("_sum"), F.count("_word").alias("_grams"))
    )
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    score = F.round(F.coalesce(F.col("_sum"), F.lit(0.0)) / F.greatest("_grams", F.lit(1)), 9)
    return scored.select(
        F.col("_id").alias(id_col), *facts[2 + len(held):], failed.alias("base_failed"), score.alias("score"),
        (~failed & (score >= threshold)).alias("kept"), *[F.col(h).alias(c) for h, c in zip(held, carry)],
    )
