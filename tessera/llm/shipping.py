"""Give the executors this package: the functions run there import it."""

from ..shipping import ship

__all__ = ["ship"]
