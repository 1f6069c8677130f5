"""Bronze-to-silver data engine for municipal registers, written for Spark."""

__version__ = "0.1.0"
