"""DataFrame operators and fitted models."""
