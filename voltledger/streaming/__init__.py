"""The landing of raw files as they arrive."""

from voltledger.streaming.landing import land_new_files

__all__ = ["land_new_files"]
