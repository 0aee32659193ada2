"""Spark-native toolkit for tables of timed measurements.

Sub-packages
------------
``functions``  column expressions and plan-time naming helpers
``sources``    readers, writers and sinks
``operators``  ``DataFrame -> DataFrame`` operators and Spark ML stages
``plans``      compositions of operators for a whole job
``streaming``  Structured Streaming forms of the roll-up and the drift check
"""

from tidegauge.roles import ENERGY_ROLES, Roles

__all__ = ["ENERGY_ROLES", "Roles"]
