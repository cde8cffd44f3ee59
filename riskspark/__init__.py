"""riskspark: customer-risk analytics as Spark DataFrame operators.

Every operator takes DataFrames, column names and parameters and returns a
DataFrame. Nothing is collected to the driver except the few constants a model
fit or a whole-batch gate needs.
"""

__version__ = "0.1.0"
