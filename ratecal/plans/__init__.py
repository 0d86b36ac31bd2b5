"""Whole jobs made of the operators, and the queries registered with the driver."""
