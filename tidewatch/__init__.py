"""Forecasting and anomaly detection over panels of time series, as Spark jobs."""

from tidewatch.schemas import Panel

__all__ = ["Panel"]
__version__ = "0.1.0"
