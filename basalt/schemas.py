"""Schemas of the catalogue's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T


def _schema(text: str) -> T.StructType:
    out = T.StructType()
    for column in text.split(","):
        name, kind = column.split()
        out = out.add(name, T.ArrayType(T.StringType()) if kind == "strings" else kind)
    return out


GENERA_LIST = _schema("genus string,status string")
TIME_SCALE = _schema("eon string,era string,period string,epoch string,stage string,start_ma double,uncertainty double")
FAUNA = _schema("genus string,species string,status string,is_type boolean,clade string,stage string,age string,author string,year string,source_genus string")
TREE = _schema("lowest_unit string,source_genus string,path strings")
SPECIES = _schema("id long,genus string,species string,is_type boolean,status string,clade string,stage string,age_ma string,author string,year integer")
TAXONOMY = _schema("clade string,path string")
GEOLOGICAL_TIME = _schema("id long,eon string,era string,period string,epoch string,stage string,start_ma double,uncertainty double")
PRODUCTION = _schema("genus string,species string,status string")


def require(df: DataFrame, schema: T.StructType) -> DataFrame:
    """df with exactly the schema's columns in its order; a missing or unknown column is an error."""
    if set(df.columns) != set(schema.names) or len(df.columns) != len(schema.names):
        raise ValueError(f"columns are {df.columns}, not {schema.names}")
    return df.select(*schema.names)
