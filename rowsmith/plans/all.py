"""Importing this module registers every query."""

from rowsmith.plans import dates, files, finance, lookups, pages, samples, streams, texts  # noqa: F401
