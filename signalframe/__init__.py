"""signalframe: a PySpark-native analytics engine for biosignal time series."""

__version__ = "0.1.0"
