"""Flow-risk analytics on Spark: cleaning, features, scoring, forecasting and reports."""

__version__ = "0.1.0"
