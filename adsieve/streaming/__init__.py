"""Structured Streaming: stateful anchored windows and the event stream job."""
