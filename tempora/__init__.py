"""tempora: interval time-series preparation, checking and forecasting on Spark."""

__version__ = "0.1.0"
