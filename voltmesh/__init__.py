"""Voltmesh: raw power-infrastructure features to a connected high-voltage network, on Spark DataFrames."""
