"""voxmeter: a PySpark engine for scoring and cleaning speech-synthesis evaluation data."""

__version__ = "0.1.0"
