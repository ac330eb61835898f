"""DataFrame -> DataFrame operators of the attribution models."""
