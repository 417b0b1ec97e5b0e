"""Micro-batch drivers.

The analytics have no event-time or late-data semantics; the one stateful
process is the address snapshot, which is re-expressed as a Structured
Streaming job in ``snapshot_stream``.
"""

from marketlens.streaming.snapshot_stream import apply_snapshot_batch, start_snapshot_stream  # noqa: F401
