"""Operators of a training-data pipeline, each over DataFrames of texts, pages or messages."""
