"""Payment-risk analytics as PySpark DataFrame transformations.

Every operator is a function ``DataFrame -> DataFrame``; nothing runs until a
sink or the caller triggers an action, and the same row-level functions serve
batch and Structured Streaming.
"""

from ledgerlens.session import get_session, pin_session

__all__ = ["get_session", "pin_session"]
