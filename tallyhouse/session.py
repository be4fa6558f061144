"""Session settings for the size of the data at hand."""

from __future__ import annotations

_TARGET = 128 * 1024 * 1024


def settings_for(input_bytes: int, cores: int) -> dict[str, str]:
    """Settings for a session that reads about ``input_bytes`` with ``cores`` cores.

    Shuffles start with partitions of about 128 MB of input, at least one per core; adaptive
    execution then merges small ones and splits those that a hot key makes large.
    """
    partitions = max(input_bytes // _TARGET, cores, 1)
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(_TARGET),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(_TARGET),
        "spark.sql.session.timeZone": "UTC",
    }
