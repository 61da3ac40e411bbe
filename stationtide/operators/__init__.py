"""DataFrame-to-DataFrame operators of the observation model."""
