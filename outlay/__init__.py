"""outlay: spend and campaign analytics as plain Spark DataFrame operators."""

from outlay.params import Thresholds

__all__ = ["Thresholds"]
