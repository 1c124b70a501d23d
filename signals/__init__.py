"""signals: retail and marketing analytics as PySpark DataFrame jobs."""

from signals.params import Params

__all__ = ["Params"]
