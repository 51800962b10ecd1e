"""DataFrame operators and jobs for industrial telemetry and text corpora on Spark."""

__version__ = "0.1.0"
