"""The registered queries of this package: each applies one operator to its whole table."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from machpulse.llm import (
    archive, bpe, classifier, fingerprints, html, infill, lm, mixing, neardup, passages, quality, sql, urls, whitening,
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: File of a public tokenizer's ranks; found by the installed package, or given here.
RANK_FILE = None


def rank_file() -> str:
    import public_tokenizers

    return RANK_FILE or public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def split_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(_table(spark, sf_dir, "documents"), rank_file(), split_pattern())


def op2_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents"))


#: The url rules, and the blocked domains of the query.
URL_RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
BLOCKED_NAMES = ("ads-track", "adult-x", "casino-win", "cheap-pills", "free-bets", "spam-farm")
BLOCKED = tuple(f"{name}.example.{top}" for name in BLOCKED_NAMES for top in ("com", "net", "org"))


def op3_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = spark.createDataFrame([(key,) for key in BLOCKED], "key string")
    return urls.filter_urls(_table(spark, sf_dir, "pages"), listed, URL_RULES)


def archive_records(pages: DataFrame) -> DataFrame:
    """Web archive records of the pages: a full response for five pages in six, and a later revisit for each page.

    One revisit in five carries another entity tag, one page in four has none and goes by Last-Modified.
    """
    page, tag = F.col("page_id"), F.concat(F.lit('"'), F.md5(F.coalesce("html", F.lit(""))), F.lit('"'))
    day = F.concat(F.lit("d"), (page % 1000).cast("string"))

    def headers(**values) -> Column:
        pairs = [x for name, value in values.items() for x in (F.lit(name.replace("_", "-")), value)]
        return F.map_filter(F.create_map(*pairs), lambda _, v: v.isNotNull())

    first, again = page * 10, page * 10 + 5 + (page % 3) * 1000
    no_tag = page % 4 == 3
    full = pages.filter(page % 6 != 5).select(
        page.alias("record_id"), F.lit("response").alias("kind"), "url", first.alias("ts"),
        headers(
            content_type=F.lit("text/html"), content_length=F.length(F.coalesce("html", F.lit(""))).cast("string"),
            date=F.concat(F.lit("t"), first.cast("string")), etag=F.when(~no_tag, tag), last_modified=day,
        ).alias("headers"),
        F.md5(F.coalesce("html", F.lit(""))).alias("payload_digest"),
    )
    revisit = pages.select(
        page.alias("record_id"), F.lit("revisit").alias("kind"), "url", again.alias("ts"),
        headers(
            cache_control=F.lit("max-age=60"), content_length=F.lit("0"), date=F.concat(F.lit("t"), again.cast("string")),
            etag=F.when(page % 5 == 0, F.lit('"other"')).when(~no_tag, F.concat(F.lit("W/"), tag)),
            expires=F.concat(F.lit("t"), (again + 3600).cast("string")), last_modified=day,
        ).alias("headers"),
        F.lit(None).cast("string").alias("payload_digest"),
    )
    return full.unionByName(revisit)


def op4_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    resolved = archive.resolve_revisits(archive_records(_table(spark, sf_dir, "pages")))
    return resolved.withColumn("headers", archive.header_lines(F.col("headers")))


def op5_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(_table(spark, sf_dir, "pages"))


def op6_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(_table(spark, sf_dir, "documents"), width=4, percent=80)


def op7_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(_table(spark, sf_dir, "documents"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op9_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.remove_repeats(_table(spark, sf_dir, "documents"))


def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edited(_table(spark, sf_dir, "documents"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(_table(spark, sf_dir, "embeddings"))


def op12_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classifier.classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op13_infill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return infill.digests(_table(spark, sf_dir, "documents"))


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_byte_bpe": op1_byte_bpe,
        "op2_mix": op2_mix,
        "op3_urls": op3_urls,
        "op4_revisits": op4_revisits,
        "op5_main_text": op5_main_text,
        "op6_near_duplicates": op6_near_duplicates,
        "op7_lm_scores": op7_lm_scores,
        "op8_quality": op8_quality,
        "op9_passages": op9_passages,
        "op10_fingerprints": op10_fingerprints,
        "op11_whitening": op11_whitening,
        "op12_quality_classifier": op12_quality_classifier,
        "op13_infill": op13_infill,
    }


def all_sql() -> dict[str, str]:
    return {"op3_urls": sql.urls(URL_RULES, BLOCKED), "op4_revisits": sql.REVISITS}
