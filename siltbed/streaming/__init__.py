"""Structured Streaming: land an envelope stream with foreachBatch, progress metrics."""
