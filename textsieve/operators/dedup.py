"""Stage 6: exact deduplication by fingerprint, the lowest id of a group wins.

Only (fingerprint, id) pairs are shuffled, and they are aggregated before the
shuffle, so a group of copies that holds a large part of all rows reaches its
reducer as one pair per task. Rows are then matched on the unique id, never on
the fingerprint. The pairs are read twice: hand in a written table, as the plan
does, or they are worked out twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def first_copies(pairs: DataFrame, id_col: str = "id", fp_col: str = "fingerprint") -> DataFrame:
    """(fingerprint, id) of the first row of each group."""
    return pairs.groupBy(fp_col).agg(F.min(id_col).alias(id_col))


def later_copies(pairs: DataFrame, id_col: str = "id", fp_col: str = "fingerprint") -> DataFrame:
    """Ids of all rows but the first of their group."""
    firsts = first_copies(pairs, id_col, fp_col).select(id_col)
    return pairs.select(id_col).join(firsts, id_col, "left_anti")


def dedup_keep(df: DataFrame, id_col: str = "id", fp_col: str = "fingerprint") -> DataFrame:
    """Rows that are the first of their group."""
    firsts = first_copies(df.select(id_col, fp_col), id_col, fp_col).select(id_col)
    return df.join(firsts, id_col, "left_semi")


def dedup_mark(df: DataFrame, id_col: str = "id", fp_col: str = "fingerprint") -> DataFrame:
    """All rows, with duplicate = true on later copies."""
    firsts = first_copies(df.select(id_col, fp_col), id_col, fp_col)
    marks = firsts.select(id_col, F.lit(False).alias("duplicate"))
    return df.join(marks, id_col, "left").fillna(True, ["duplicate"])


def dedup_groups(df: DataFrame, fp_col: str = "fingerprint") -> DataFrame:
    """Size of each group of equal fingerprints."""
    return df.groupBy(fp_col).agg(F.count(F.lit(1)).alias("copies"))
