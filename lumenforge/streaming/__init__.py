"""Stages on streams."""
