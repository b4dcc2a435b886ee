"""Structured Streaming forms of the operators: file/Kafka stream inputs,
watermarked windows, keyed state (transformWithStateInPandas), sinks."""
