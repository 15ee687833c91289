"""Keyed pseudonyms in place of identities."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from machpulse.functions.keyed_hash import hmac_sha256


def pseudonymise(df: DataFrame, columns: list[str], key_df: DataFrame, on_empty: str = "fail") -> DataFrame:
    """Replace each column by ``<column>_pseudonymise``; other columns stay.

    The same key and text always give the same pseudonym, so pseudonyms join. An empty or NULL
    identifier stops the job; with ``on_empty="reject"`` it is NULL and ``rejet_motif`` names the column.
    """
    if on_empty not in ("fail", "reject"):
        raise ValueError(f"unknown on_empty {on_empty!r}")
    empty = {c: F.col(c).isNull() | (F.col(c) == "") for c in columns}
    made = {}
    for c in columns:
        digest = hmac_sha256(F.col(c), key_df)
        if on_empty == "fail":
            refusal = F.raise_error(F.lit(f"{c} must not be empty")).cast("string")
            made[f"{c}_pseudonymise"] = F.when(empty[c], refusal).otherwise(digest)
        else:
            made[f"{c}_pseudonymise"] = F.when(~empty[c], digest)
    if on_empty == "reject":
        made["rejet_motif"] = F.coalesce(*[F.when(empty[c], F.lit(f"{c}_vide")) for c in columns])
    return df.withColumns(made).drop(*columns)


def pseudonymise_operators(operators: DataFrame, key_df: DataFrame, on_empty: str = "fail") -> DataFrame:
    """Badge number and name become pseudonyms; the team is no identity and stays."""
    return pseudonymise(operators, ["matricule", "nom"], key_df, on_empty)
