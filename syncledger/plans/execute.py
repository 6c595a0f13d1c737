"""Executing a plan (C1, C2): the optional hook for the caller's own handler.

Nothing here is on by default. ``apply_plan`` runs a user function on the
plan rows of each partition (``mapInPandas``: Arrow batches, no per-row
serialisation) and returns a results table. The table feeds the catalog
updates (``record_uploads`` / ``record_downloads``) or ``apply_delete_results``,
which is the batch form of the original per-result callback.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame

RESULT_SCHEMA = "drive_id string, status int, error string"


def apply_plan(plan: DataFrame, handler: Callable[[pd.DataFrame], pd.DataFrame],
               schema: str = RESULT_SCHEMA, partitions: int | None = None) -> DataFrame:
    """Run ``handler`` on every batch of plan rows and return its results.

    ``handler`` gets a pandas DataFrame of plan rows and returns one row per
    processed item in ``schema``. ``partitions`` bounds the number of
    concurrent tasks (e.g. a service's rate limit). Rows are spread evenly, and
    a hot folder is not kept together.
    """
    src = plan.repartition(partitions) if partitions else plan

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf):
                yield handler(pdf)

    return src.mapInPandas(run, schema)
