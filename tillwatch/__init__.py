"""Card-transaction risk analytics as PySpark DataFrame transforms.

Every transform takes and returns a DataFrame, so the same code serves batch
tables and the micro-batches of Structured Streaming.
"""

from tillwatch.session import build_session

__all__ = ["build_session"]
