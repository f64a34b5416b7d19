"""The same stages over a stream of notifications."""
