"""Session settings that depend on the size of the data."""

from __future__ import annotations

MIB = 1024 * 1024

# A shuffle of M map tasks into R partitions has M x R blocks, and the driver
# tracks R bits for each map task. At this many of both a block of a 100 TB
# shuffle still has about 40 kB, and the tracking takes about 300 MB.
MAX_TASKS = 50_000


def scale_settings(
    input_bytes: int, cores: int, partition_bytes: int = 256 * MIB
) -> dict[str, str]:
    """Spark settings for a run over ``input_bytes`` on ``cores``.

    The exact profile and the Silver layout shuffle about as much as they read,
    so scan and shuffle are cut alike: partitions of ``partition_bytes``, or
    larger ones where that would take more than ``MAX_TASKS``. AQE merges the
    shuffle partitions that turn out smaller and cuts hot folders to size.
    """
    split_bytes = max(partition_bytes, -(-input_bytes // MAX_TASKS))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(split_bytes),
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.shuffle.partitions": str(max(cores, -(-input_bytes // split_bytes))),
    }
