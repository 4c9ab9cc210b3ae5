"""Contrarian trade signals from short text posts, expressed as Spark jobs."""
