"""Stateful arbitration on streams, feed sources and sinks."""
