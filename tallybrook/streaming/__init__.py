"""Operators on streams that keep their own state per key (``transformWithState``)."""
