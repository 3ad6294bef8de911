"""DataFrame → DataFrame operators of the event pipeline."""
