"""Opening files of any store from a task, by the path as Spark names it."""

from scanlake.sources.stores import filesystem

__all__ = ["filesystem"]
