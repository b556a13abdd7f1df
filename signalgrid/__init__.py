"""signalgrid: mobile signal quality by place and hour, on Spark DataFrames."""

__version__ = "0.1.0"
