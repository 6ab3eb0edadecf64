"""Commercial analytics as composable PySpark DataFrame functions."""

from salesloom.context import Ctx, Store, session

__all__ = ["Ctx", "Store", "session"]
