"""The text expressions keep no state, so they apply to a stream of documents as they are."""

from __future__ import annotations

from pyspark.sql import DataFrame

from topicloom.config import TopicConfig
from topicloom.operators.normalise import preprocess_abstracts


def preprocess_stream(stream: DataFrame, text_column: str = "abstract", config: TopicConfig = TopicConfig()) -> DataFrame:
    """Tokens and processed text of each arriving document; empty ones are dropped."""
    if not stream.isStreaming:
        raise ValueError("expected a streaming DataFrame")
    return preprocess_abstracts(stream, text_column, config)
