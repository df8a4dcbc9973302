"""eventloom: keyed event-stream analytics as plain Spark DataFrame functions.

Every operator takes and returns a DataFrame and works on batch input and,
where Structured Streaming allows it, on streaming input as well.
"""

from eventloom.session import build_session, configure, scratch_path

__all__ = ["build_session", "configure", "scratch_path"]
