"""Structured Streaming forms: watermarks and sinks (core), windowed / joined stream
jobs (jobs) and keyed state machines with event-time timers (state)."""

from .core import console, run_available_now, with_event_time, write_side_outputs

__all__ = ["console", "run_available_now", "with_event_time", "write_side_outputs"]
