"""Scalar column functions: null/rounding helpers and derived variables."""
from .core import (accent_key, count_if, flag01, is_true, label_map,  # noqa: F401
                   round_half_even, share, strip_text, zfill)
from . import derive  # noqa: F401
