"""Structured Streaming forms: windowed validation with watermarks and
per-micro-batch suites (``hourly``), and JSON checks of newly arrived files
(``documents``)."""
