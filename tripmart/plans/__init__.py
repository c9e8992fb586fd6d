"""Compositions: the query catalog, its SQL oracle and the layer jobs."""
