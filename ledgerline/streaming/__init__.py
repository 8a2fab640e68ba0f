"""The same checks and writes over a stream."""
