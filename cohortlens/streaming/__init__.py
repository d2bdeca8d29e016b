"""Streaming entry points.

The original model is batch only: every model is a full-refresh table and the event log is a static
table. The only part that is meaningful on an unbounded input is staging (M01-M03), which is a
stateless row-wise projection; :func:`stage_stream` applies it to a file stream and appends the
staged rows to a table, so the batch models can run over a continuously growing staged table.
No stateful streaming operator exists in the original and none is added here.
"""

from .staging import stage_stream

__all__ = ["stage_stream"]
