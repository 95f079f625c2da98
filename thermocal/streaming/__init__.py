"""Structured Streaming entry points for the stateless operators."""

from thermocal.streaming.adjust import adjust_stream, read_readings_stream, score_stream  # noqa: F401
