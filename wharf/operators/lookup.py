"""Lookup of a dictionary table, a left join on a code column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

def lookup_dictionary(
    facts: DataFrame,
    code: Column | str,
    dictionary: DataFrame,
    key: str = "dic_code",
    value: str = "dic_name",
    out: str = "dic_name",
) -> DataFrame:
    """Left join ``facts`` with ``dictionary`` on ``code = key``; unknown codes get NULL.

    Whether the dictionary is broadcast is left to Spark, which compares its bytes with the session's
    threshold. Dictionary keys are deduplicated (the key is declared, not enforced), so the join never
    multiplies fact rows.
    """
    code_col = F.col(code) if isinstance(code, str) else code
    d = dictionary.groupBy(key).agg(F.max(value).alias("_v"))
    j = facts.join(d, code_col == d[key], "left")
    return j.select(*[facts[c] for c in facts.columns], F.col("_v").alias(out))
