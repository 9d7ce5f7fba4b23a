"""DataFrame operators (SURVEY B, D, E, F, G, H, J): lazy ``DataFrame -> DataFrame`` functions."""
