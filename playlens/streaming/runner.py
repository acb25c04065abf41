"""Landing pulls and running a stream after each, the way the poller drives it.

Each pull is written as its own set of envelope files, then the stream runs
with ``availableNow`` on a persistent checkpoint, so every pull becomes one
micro-batch in order, and state carries over between runs exactly as in a
long-running query.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playlens.sources import envelope
from playlens.streaming import state


def replay_pulls(log: DataFrame, root: str, run_once: Callable[[str], None], pulls: int = 4,
                 overlap: float = 0.1, newest_first: bool = False, at_once: bool = False,
                 multi_line: bool = False, order: list[int] | None = None, after_write: Callable[[DataFrame, str, int], None] | None = None) -> str:
    """Write ``pulls`` overlapping pulls of ``log`` one by one under ``root/in``,
    calling ``run_once(source_glob)`` after each (``at_once``: after the last only);
    returns the source glob.  ``order`` lands the pulls in another order;
    ``after_write(envelopes, source, pull)`` may add files to a pull.  The packed
    log is written once, partitioned by pull."""
    packed = f"{root.rstrip('/')}/packed"
    envelope.pack_envelopes(envelope.assign_pulls(log, pulls, overlap)).write.partitionBy("pull").parquet(packed)
    env = log.sparkSession.read.parquet(packed)
    source = f"{root.rstrip('/')}/in"
    glob = f"{source}/{envelope.FILE_PREFIX}_*"
    order = order or (range(pulls, 0, -1) if newest_first else range(1, pulls + 1))
    for n, p in enumerate(order, 1):
        envelope.write_envelopes(env.filter(F.col("pull") == p).drop("pull", "page"), source, p, multi_line=multi_line)
        if after_write is not None:
            after_write(env.filter(F.col("pull") == p), source, p)
        if not at_once or n == pulls:
            run_once(glob)
    return glob


def latest_version(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The newest version of a versioned state table."""
    return spark.read.parquet(state.version_path(root, name, state.newest_version(spark, root, name)))


__all__ = ["replay_pulls", "latest_version", "state"]
