"""scorewright: Spark operators for intake, scoring and auditing of submissions."""

__version__ = "0.1.0"
