"""Settings for cluster jobs.  The library's results never depend on them."""

from __future__ import annotations

_PARTITION_BYTES = 256 << 20


def settings_for(input_bytes: int, cores: int) -> dict[str, str]:
    """Session settings for a job over ``input_bytes`` on ``cores`` task slots.

    Shuffles start with enough partitions to hold the whole input at about 256 MB each,
    so that a task works in memory; adaptive execution merges them where a stage turns
    out smaller, and splits partitions that one hot key has filled.
    """
    partitions = max(cores, -(-input_bytes // _PARTITION_BYTES))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(_PARTITION_BYTES),
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(_PARTITION_BYTES),
        "spark.sql.session.timeZone": "UTC",
    }
