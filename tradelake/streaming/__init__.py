"""Structured Streaming jobs over the log, the raw zone and topics."""
