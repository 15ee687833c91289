"""HMAC-SHA256 from built-in hash functions, with the key kept out of the plan text."""

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_BLOCK = 64


def key_pads(key: bytes) -> tuple[bytes, bytes]:
    """Inner and outer pad of RFC 2104 for SHA-256."""
    if len(key) > _BLOCK:
        key = hashlib.sha256(key).digest()
    key = key.ljust(_BLOCK, b"\0")
    return bytes(b ^ 0x36 for b in key), bytes(b ^ 0x5C for b in key)


def key_table(spark: SparkSession, key: bytes) -> DataFrame:
    """One-row table holding the pads. Read through scalar subqueries, its content never shows in a plan."""
    inner, outer = key_pads(key)
    return spark.createDataFrame([(bytearray(inner), bytearray(outer))], "inner_pad binary, outer_pad binary")


def hmac_sha256(value: Column, key_df: DataFrame) -> Column:
    """64 lowercase hex characters, equal to the standard HMAC-SHA256 of the UTF-8 text."""
    inner = key_df.select("inner_pad").scalar()
    outer = key_df.select("outer_pad").scalar()
    digest = F.unhex(F.sha2(F.concat(inner, F.encode(value, "UTF-8")), 256))
    return F.sha2(F.concat(outer, digest), 256)
