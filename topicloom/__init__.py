"""Topic discovery over large document tables, written as Spark DataFrame jobs."""

from topicloom.config import TopicConfig

__all__ = ["TopicConfig"]
