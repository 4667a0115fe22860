"""Streams: ids for new entries as they come, and counts over event time."""
