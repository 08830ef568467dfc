"""Text normalisation for streaming DataFrames."""
