"""Shop events as a stream."""
