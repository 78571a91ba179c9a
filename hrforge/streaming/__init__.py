"""Structured Streaming delivery of existing operators (the reference has no
streaming of its own): see ``checkins``."""
