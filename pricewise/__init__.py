"""pricewise: property-price analytics as Spark DataFrame operators.

Every operator is a plain function ``op(df, *, column names...) -> DataFrame``
built from the public DataFrame / SQL API, so Catalyst plans the whole chain
and nothing leaves the executors until the caller runs an action.
"""

__version__ = "0.1.0"
