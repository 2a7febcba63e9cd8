"""Streaming form of the return-trip match (the batch library is the core;
the trip table itself has no streaming operators)."""

from .return_trips import stream_return_trips

__all__ = ["stream_return_trips"]
