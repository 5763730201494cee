"""Structured Streaming paths over the same operators."""
