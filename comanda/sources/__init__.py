"""Readers, sheet normalisers, sinks and the binding of the driver tables to the domain tables."""
