"""Session settings the jobs are designed for."""

from __future__ import annotations

TARGET_PARTITION_BYTES = 128 * 1024 * 1024


def recommended_conf(shuffle_bytes: int, cores: int) -> dict[str, str]:
    """Settings for a run whose largest shuffle moves about ``shuffle_bytes``.

    Shuffles start with partitions of about 128 MB and at least one per core; AQE merges what turns out small and splits
    skewed join partitions. Lookups are broadcast by measured size only, so the threshold is the one size limit.
    ``spark.checkpoint.dir`` has to name a shared folder; it belongs to the cluster and is not set here.
    """
    partitions = max(cores, -(-shuffle_bytes // TARGET_PARTITION_BYTES))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(TARGET_PARTITION_BYTES),
        "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
        "spark.sql.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
        "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        "spark.sql.session.timeZone": "UTC",
    }
