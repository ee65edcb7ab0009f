"""wardpulse: ward-level city analytics as Spark DataFrame operators.

Every operator is a function ``DataFrame(s) -> DataFrame`` that stays lazy;
composition happens in :mod:`wardpulse.plans`.
"""

__version__ = "0.1.0"
