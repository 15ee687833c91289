"""A training corpus from raw documents: quality rules, near-duplicates, shared passages, mix, token ids.

Every stage works on all that the stage before it kept. All but the last return the columns of ``documents``.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from machpulse.llm import bpe, mixing, neardup, passages, quality
from machpulse.llm.queries import rank_file, split_pattern
from machpulse.sources.storage import stored

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]

#: SQL cannot express the stages; they are tested against brute force.
ORACLE_SQL = None


#: What tells documents apart: the id, null or not, and the text by its hash.
KEY = ["_null", "_id", "_mark"]


def _marked(docs: DataFrame) -> DataFrame:
    """Rows with a key that tells texts of one id apart, and joins null ids too."""
    doc_id = F.col("doc_id")
    none = F.lit(0).cast(docs.schema["doc_id"].dataType)
    mark = F.xxhash64(F.coalesce("text", F.lit("")))
    return docs.select(*COLUMNS, doc_id.isNull().alias("_null"), F.coalesce(doc_id, none).alias("_id"), mark.alias("_mark"))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go. Rows of one id and text have one verdict."""
    docs = _marked(docs)
    verdicts = quality.judge(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), carry=tuple(KEY))
    good = verdicts.filter("kept").select(*KEY).distinct()
    return docs.join(good.hint("shuffle_hash"), KEY, "left_semi").select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates one document stays, the one of the smallest id.

    Texts of one id are compared as the texts they are, so unlike ones stay; of null ids too, copies go. Of rows with the
    same id and text the first by the other columns stays. Texts without words are like nothing and stay.
    """
    docs = _marked(docs).withColumn("_row", F.xxhash64("lang", "source", "n_chars", F.col("text").isNull()))
    found = neardup.near_duplicates(docs.withColumn("_doc", F.struct(*KEY)), id_col="_doc", width=5, percent=80)
    kept = found.filter("kept").select("_doc.*").distinct()
    rows = docs.groupBy(*KEY).agg(F.min("_row").alias("_first"), F.count(F.lit(1)).alias("_rows"))
    rows = stored(rows.join(kept, KEY, "left_semi"), "pipeline-kept")
    # The keys are hashed, so the texts are not sorted for the join.
    left = docs.join(rows.hint("shuffle_hash"), KEY).filter(F.col("_row") == F.col("_first"))
    once = left.filter("_rows = 1").select(*COLUMNS)
    if rows.filter("_rows > 1").isEmpty():
        return once
    # Only repeated rows are compared whole; they collapse where they are read.
    return once.unionByName(left.filter("_rows > 1").select(*COLUMNS).distinct())


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that stand in an earlier document are cut out of the texts; no document goes."""
    cut = passages.remove_repeats(docs, carry=("lang", "source", "n_chars"))
    changed = F.when(F.size("removed_spans") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return cut.withColumn("n_chars", changed).select(*COLUMNS)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it. All but the text travels with the mix; rows of one id and text share that."""
    docs = _marked(docs).withColumn("_none", F.col("text").isNull())
    carried = ("lang", "n_chars", "_none", *KEY)
    taken = mixing.mix(docs.select("doc_id", "text", "source", *carried), carry=carried).filter("copies > 0")
    texts = docs.groupBy(*KEY).agg(F.max("text").alias("text"))
    rows = taken.select(*[c for c in COLUMNS if c != "text"], "_none", "copies", *KEY).join(texts, KEY)
    rows = rows.withColumn("text", F.when(~F.col("_none"), F.coalesce("text", F.lit(""))))
    return rows.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select(*COLUMNS)


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, ids, n_tokens, decoded_sha256`` of every text of the mix."""
    coded = bpe.encode(docs, rank_file(), split_pattern())
    decoded = F.sha2(bpe.decode(F.col("ids"), rank_file()), 256)
    return coded.select("doc_id", "ids", F.size("ids").cast("long").alias("n_tokens"), decoded.alias("decoded_sha256"))


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("substring_dedup", substring_dedup),
    ("mix", mix),
    ("byte_bpe", byte_bpe),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
