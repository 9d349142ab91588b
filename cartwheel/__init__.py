"""cartwheel: commerce analytics as plain Spark DataFrame operators.

Every operator is a function from DataFrames to DataFrames.  Nothing is
collected to the driver except the per-round undecided count of order
admission (see ``operators.admission``).
"""

__version__ = "0.1.0"
