"""Spark-native analytics for occupancy series, member activity and text catalogues.

Every operator is a plain ``DataFrame -> DataFrame`` function (or a
``Column -> Column`` expression in :mod:`occuspark.functions`).  Query plans
that bind operators to the driver tables live in :mod:`occuspark.plans`.
"""

__version__ = "0.1.0"
