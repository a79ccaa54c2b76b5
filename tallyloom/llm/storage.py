"""Intermediates that are written to shared storage and read back."""

from tallyloom.sources.sinks import written

__all__ = ["written"]
