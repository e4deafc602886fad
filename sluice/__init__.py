"""sluice — keyed change delivery on Spark.

Reads a source table, view or change log as DataFrames, decides which rows
to send (everything, a high-water-mark window, or the net change per key from
an outbox), and lands them as truncate, append, upsert or delete in one
publish together with the recorded progress.
"""

from .session import build_session, checkpoint_dir, configure  # noqa: F401
from .spec import SyncSpec  # noqa: F401

__all__ = ["build_session", "checkpoint_dir", "configure", "SyncSpec"]
