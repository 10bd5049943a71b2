"""tripkit: trip-record analytics as Spark DataFrame operators.

Every public operator is a function from DataFrame(s) to DataFrame, or a
builder returning a ``Column``. Nothing collects to the driver.
"""

__version__ = "0.1.0"
