"""Seeded, repeatable pseudo-random keys for splits and samples."""

from pyspark.sql import Column, functions as F


def seeded_key(id_col: Column, seed: int, method: str = "xxhash64") -> Column:
    """Key of 60 bits whose order is a seeded shuffle of the ids.

    A pure function of id and seed: a recomputed partition gives the same key.
    ``md5`` costs more but other SQL engines can compute it as well.
    """
    if method == "xxhash64":
        return F.shiftrightunsigned(F.xxhash64(F.lit(seed), id_col), 4)
    if method == "md5":
        text = F.concat(F.lit(f"{seed}:"), id_col.cast("string"))
        return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")
    raise ValueError(f"unknown hash method {method!r}")
