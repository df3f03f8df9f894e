"""Operators of a training-data pipeline. Nothing else in pluvia imports this subpackage."""
