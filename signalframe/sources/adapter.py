"""What a source of signals offers to the feature builders, whatever device it stands for."""

from __future__ import annotations

from collections.abc import Callable
from typing import Protocol

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


#: Fixed values of the data contract: the kinds of signals, whether the source gives them, from where, and their resolution in seconds.
CAPABILITIES = (
    ("heart_rate", True, "measured", 60), ("resting_heart_rate", True, "vendor", 86400), ("spo2", True, "measured", 600), ("respiratory_rate", True, "vendor", 86400),
    ("sleep_session", True, "vendor", None), ("sleep_stage", True, "vendor", 60), ("daily_activity", True, "vendor", 86400), ("workout", True, "vendor", None), ("stress", True, "vendor", 300),
    ("beat_interval", False, None, None), ("hrv", False, None, None), ("skin_temperature", False, None, None), ("vendor_metric", True, "vendor", None), ("steps", True, "measured", 60),
)


class SignalSource(Protocol):
    def generation(self) -> str: ...

    def capabilities(self) -> DataFrame: ...

    def read(self, kind: str, start: int | None = None, end: int | None = None) -> DataFrame: ...


class TableSource:
    """Signals as DataFrames by kind; ranges are half-open and in epoch seconds, and reach the scan as filters."""

    #: The column that a range applies to; sleep sessions belong to the time they end.
    AT = {"heart_rate": "ts", "spo2": "ts", "stress": "ts", "sleep_session": "t", "workout": "s", "sleep_stage": "start", "daily_activity": "day", "resting_heart_rate": "day", "respiratory_rate": "t"}

    def __init__(self, kinds: dict[str, Callable[[], DataFrame]], capabilities: DataFrame, generation: str):
        self._kinds, self._capabilities, self._generation = kinds, capabilities, generation

    def generation(self) -> str:
        return self._generation

    def capabilities(self) -> DataFrame:
        return self._capabilities

    def read(self, kind: str, start: int | None = None, end: int | None = None) -> DataFrame:
        """Signals of a kind; an unknown kind is an error, one that the source lacks gives no rows."""
        if kind not in self.AT:
            raise KeyError(f"no kind of signal: {kind}")
        for bound in (start, end):
            if bound is not None and not isinstance(bound, int):
                raise TypeError("bounds are epoch seconds")
        df = self._kinds[kind]()
        at = F.col(self.AT[kind])
        if start is not None:
            df = df.filter(at >= start)
        return df.filter(at < end) if end is not None else df
