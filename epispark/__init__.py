"""epispark — Spark-native analytics for notified-case line lists.

Lazy DataFrame -> DataFrame operators: profile and validate a line list,
clean it, describe it, build the area-level priority index, publish
suppressed aggregates, merge incremental files and fit area-level models.
"""
from .config import Config  # noqa: F401
from .session import get_session, materialize  # noqa: F401

__version__ = "0.1.0"
