"""Session settings for batch analytics."""

from __future__ import annotations

from pyspark.sql import SparkSession

MIB = 1024 * 1024


def split_bytes(input_bytes: int, cores: int, waves: int = 3,
                smallest: int = 16 * MIB, largest: int = 512 * MIB, *,
                files: int = 0, open_cost: int = 0) -> int:
    """Scan split size that gives every core about ``waves`` tasks.

    Spark packs files into a split until the next one would not fit, counting ``open_cost`` bytes
    more for each of the ``files`` already in it, so these count here too. Small inputs get splits
    of ``smallest``; very large ones get up to ``largest``, so that the number of tasks stays in
    the hundreds of thousands.
    """
    wanted = (input_bytes + files * open_cost) // max(cores * waves, 1) - open_cost
    return max(smallest, min(largest, wanted))


def build_session(app: str = "tallyloom", *, master: str | None = None,
                  shuffle_partitions: int | None = None,
                  max_partition_bytes: int | None = None,
                  settings: dict[str, str] | None = None) -> SparkSession:
    """A session with the settings the operators are written for.

    ``master`` and ``shuffle_partitions`` are left to the cluster when not given. Any key of
    ``settings`` wins over the defaults below.
    """
    conf = {
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if max_partition_bytes is not None:
        conf["spark.sql.files.maxPartitionBytes"] = str(max_partition_bytes)
    conf.update(settings or {})
    builder = SparkSession.builder.appName(app)
    if master is not None:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
