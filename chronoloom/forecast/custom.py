"""A user's own model, one call per series."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronoloom.frame import TimeSeriesFrame


def custom_forecaster(
    fn: Callable[[pd.DataFrame], pd.DataFrame], schema: str
) -> Callable[[TimeSeriesFrame], DataFrame]:
    """Run `fn` on each series in time order and return its rows under `schema`.

    `fn` gets a whole series in one task, so a frame with a series beyond `max_rows`
    is refused instead of cut: resample it, or raise `max_rows` knowingly.
    """

    def run(tsf: TimeSeriesFrame) -> DataFrame:
        if tsf.width:
            raise ValueError(
                f"A series has more than {tsf.max_rows} rows; a custom model needs it in one task"
            )
        time = tsf.time

        def call(pdf: pd.DataFrame) -> pd.DataFrame:
            return fn(pdf.sort_values(time, kind="stable").reset_index(drop=True))

        return tsf.df.select(*map(F.col, tsf.columns())).groupBy(*tsf.keys).applyInPandas(call, schema)

    return run
