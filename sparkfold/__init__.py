"""sparkfold: DataFrame-in / DataFrame-out operators for logs, streams,
co-occurrence graphs, intervals, keyed placement and record-oriented text
formats, all expressed with Spark SQL / DataFrame primitives."""

from sparkfold.session import build_session, scratch_path

__all__ = ["build_session", "scratch_path"]
