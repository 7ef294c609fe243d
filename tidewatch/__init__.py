"""tidewatch: DataFrame operators for early-warning analytics on event time series."""

__version__ = "0.1.0"
