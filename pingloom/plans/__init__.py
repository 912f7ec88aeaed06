"""All queries of the movement side."""

from . import behaviour, reached, rides, travel, views  # noqa: F401
from .queries import SQL, Q

__all__ = ["Q", "SQL"]
