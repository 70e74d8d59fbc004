"""Session settings the operators are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    # One clock everywhere; the tables themselves hold zone-free timestamps.
    "spark.sql.session.timeZone": "UTC",
    # Run-time plans: coalesce small shuffles, broadcast what turned out small,
    # split partitions that one hot key made large.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Planning writes hundreds of column expressions; noting the Python line of each is slow.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


PARTITION_BYTES = 128 * 1024**2
LEAST_PARTITIONS = 200


def settings_for(input_bytes: int, partition_bytes: int = PARTITION_BYTES) -> dict[str, str]:
    """Settings for a run over so many bytes of input, by one rule at every size.

    Shuffles start with a partition per ``partition_bytes`` of input (200 at least), and files are
    read in pieces as large. Spark merges what turns out small, so starting high is safe and
    starting low is not. Where an input has so many pieces that keeping track of them costs more
    than they save, the caller raises ``partition_bytes``.
    """
    return {
        "spark.sql.shuffle.partitions": str(max(LEAST_PARTITIONS, -(-input_bytes // partition_bytes))),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
    }


def open_session(
    app_name: str = "tallyhouse", master: str | None = None, input_bytes: int | None = None, **extra
) -> SparkSession:
    """Start or reuse a session; ``extra`` takes more settings with ``__`` for each dot.

    With ``input_bytes``, the size of a run's input, partitions follow it (``settings_for``).
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    sized = {} if input_bytes is None else settings_for(input_bytes)
    for name, value in (SETTINGS | sized).items():
        builder = builder.config(name, value)
    for name, value in extra.items():
        builder = builder.config(name.replace("__", "."), value)
    return builder.getOrCreate()
