"""revlens: review, check-in, business and user analytics as Spark jobs.

Every operator is a function from DataFrames to a DataFrame. Nothing is
registered globally, nothing is collected unless its size is bounded by a
parameter, and Python runs per row only where no built-in expresses the
step (the sparse-vector builder for topic models).
"""

__all__ = ["schemas", "session"]
