"""Spark-native loading of a dimensional warehouse kept on plain parquet."""

from starloom.spec import DimSpec, FactSpec, LoadStamp, Lookup

__all__ = ["DimSpec", "FactSpec", "LoadStamp", "Lookup"]
