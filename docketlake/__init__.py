"""docketlake: case-record and document analytics expressed on Spark."""

__version__ = "0.1.0"
