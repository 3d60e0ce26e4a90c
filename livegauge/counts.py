"""Counts taken while a job runs, without a second pass over its rows."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


class Counts:
    """Numbers of rows at several places of a job, known once what they stand in has been written.

    A place whose rows Spark finds empty while planning is not run and counts 0.
    """

    def __init__(self) -> None:
        self._places: list[tuple[Observation, list[str]]] = []

    def of(self, df: DataFrame, **conditions: Column | None) -> DataFrame:
        """``df`` with its rows counted: for each name those that fulfil the condition, or all for None."""
        place = Observation()
        self._places.append((place, list(conditions)))
        counts = [F.count_if(F.lit(True) if c is None else c).alias(name) for name, c in conditions.items()]
        return df.observe(place, *counts)

    def get(self) -> dict[str, int]:
        found: dict[str, int] = {}
        for place, names in self._places:
            try:
                metrics = place.get
            except Py4JJavaError as error:  # an empty place leaves a row without columns, which PySpark refuses
                if "AssertionError" not in str(error.java_exception):
                    raise
                metrics = {}
            found |= {name: int(metrics.get(name) or 0) for name in names}
        return found
