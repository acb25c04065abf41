"""Materialising small intermediate results.

A query that must decide something at run time (is a side small enough to
broadcast, does any term need the fuzzy search, do the baskets hold any
item) runs a job for that decision.  Without a barrier every such job would
recompute the whole upstream plan, including the scan of the fact table.
:func:`materialize` writes the (small) intermediate result once with a
reliable checkpoint into the session's checkpoint folder, so later jobs read
it from there and executor loss cannot lose it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from playlens.session import ensure_checkpoint_dir


def materialize(df: DataFrame) -> DataFrame:
    """Compute ``df`` once and cut its lineage (reliable checkpoint, not a local one).

    An eager checkpoint computes the plan in the job that writes the files,
    so no cache is needed in front of it.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
