"""Per-flow derived features."""

from pyspark.sql import Column, DataFrame, functions as F

from flowrisk.functions.numeric import number


def _filled(name: str, value: float) -> Column:
    return F.coalesce(number(F.col(name)), F.lit(value))


def derive_features(df: DataFrame, enabled: bool = True) -> DataFrame:
    """Add volume, throughput, dispersion and login features.

    Each block needs its input columns and is skipped without them. The inputs keep
    their missing values; a division by zero gives NULL.
    """
    if not enabled:
        return df
    have = set(df.columns)
    new: dict[str, Column] = {}
    if {"src_bytes", "dst_bytes"} <= have:
        sent, received = _filled("src_bytes", 0.0), _filled("dst_bytes", 0.0)
        new["total_bytes"] = sent + received
        new["byte_ratio"] = F.try_divide(sent + 1.0, received + 1.0)
        new["byte_asymmetry"] = F.try_divide(sent - received, sent + received + 1.0)
    if "duration" in have and ("total_bytes" in have or "total_bytes" in new):
        total = new.get("total_bytes", number(F.col("total_bytes")) if "total_bytes" in have else None)
        new["bytes_per_sec"] = F.try_divide(total, _filled("duration", 0.0) + 0.001)
    if "connections_to_same_host" in have:
        others = _filled("connections_to_same_host", 1.0) + 1.0
        if "unique_dst_ports" in have:
            new["port_dispersion_ratio"] = F.try_divide(_filled("unique_dst_ports", 1.0), others)
        if "failed_logins" in have:
            new["failed_login_ratio"] = F.try_divide(_filled("failed_logins", 0.0), others)
    return df.withColumns(new) if new else df
