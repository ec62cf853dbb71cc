"""Structured Streaming entry points.

The reference is batch only (no stream, watermark or state). Its check-in
and review files grow over time, so the row-local ETL steps are also offered
as incremental jobs: the same operators applied to a file stream, written
append-only with a checkpoint in the shared folder. Nothing here keeps
state across micro-batches, so no watermark is needed.
"""

from revlens.streaming.incremental import checkin_stream, review_stream

__all__ = ["checkin_stream", "review_stream"]
