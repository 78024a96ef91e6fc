"""Readers and writers of the catalogue's files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basalt.schemas import require


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Semicolons, a header, doubled quotes; a byte-order mark is skipped. Every column is read as text and then cast, so bad
    numbers become null and don't shift a row."""
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema])
    raw = spark.read.schema(text).option("sep", ";").option("header", True).option("escape", '"').option("enforceSchema", True).csv(path)
    return raw.select(*(F.col(f.name).try_cast(f.dataType).alias(f.name) if f.dataType != T.StringType() else F.col(f.name) for f in schema))


def write_csv(df: DataFrame, path: str, schema: T.StructType | None = None, lenient: bool = False) -> None:
    """Overwrite; with a schema its columns in its order, where unknown columns are an error unless lenient. Null is '-'."""
    if schema is not None:
        df = df.select(*schema.names) if lenient else require(df, schema)
    out = df.select(*(F.coalesce(F.col(c).cast("string"), F.lit("-")).alias(c) for c in df.columns))
    out.write.mode("overwrite").option("sep", ";").option("header", True).option("escape", '"').option("emptyValue", "").csv(path)


def read_ragged(spark: SparkSession, path: str, keys: tuple[str, ...] = ("lowest_unit", "source_genus")) -> DataFrame:
    """keys, and path: all further cells of a row, however many; the header line is left out."""
    rows = spark.read.option("sep", ";").option("header", True).option("escape", '"').csv(path)
    cells = rows.columns
    named = [F.col(f"`{c}`").alias(k) for c, k in zip(cells, keys)]
    rest = F.array_compact(F.array(*(F.col(f"`{c}`") for c in cells[len(keys) :]))) if len(cells) > len(keys) else F.array().cast("array<string>")
    return rows.select(*named, rest.alias("path"))


def write_ragged(df: DataFrame, path: str, keys: tuple[str, ...] = ("lowest_unit", "source_genus"), heads: tuple[str, ...] = ("Lowest Unit", "Source Genus")) -> None:
    """Rows as wide as the longest path, sorted by the first key; an empty table gives no header."""
    width = df.agg(F.max(F.size("path"))).first()[0] or 0
    out = df.orderBy(keys[0]).select(*(F.col(k).alias(h) for k, h in zip(keys, heads)), *(F.get("path", i).alias(f"Level {i + 1}") for i in range(width)))
    out.write.mode("overwrite").option("sep", ";").option("header", True).option("escape", '"').csv(path)


def read_lines(spark: SparkSession, path: str, case: str | None = None) -> DataFrame:
    """(name): a line each, stripped, without blank ones; case is None, lower or capitalize."""
    from basalt.functions.text import capitalize

    line = F.regexp_replace("value", r"(?U)^\s+|\s+$", "")
    line = F.lower(line) if case == "lower" else capitalize(line) if case == "capitalize" else line
    return spark.read.text(path).select(line.alias("name")).where("name <> ''")


def read_json_map(spark: SparkSession, path: str) -> DataFrame:
    """(pos, key, value) of a JSON object, in the file's order; a file that can't be parsed has no rows."""
    whole = spark.read.option("wholetext", True).text(path).select(F.from_json("value", "map<string,string>").alias("m"))
    return whole.select(F.posexplode(F.map_entries("m")).alias("pos", "e")).select("pos", "e.key", "e.value")


def read_names_json(spark: SparkSession, path: str) -> DataFrame:
    """(name) of a JSON array, or the keys of an object."""
    whole = spark.read.option("wholetext", True).text(path)
    array = F.when(F.ltrim("value").startswith("["), F.from_json("value", "array<string>"))
    return whole.select(F.explode(F.coalesce(array, F.map_keys(F.from_json("value", "map<string,string>")))).alias("name"))


def read_json_array(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).option("multiLine", True).json(path)


def read_settings(spark: SparkSession, path: str) -> DataFrame:
    """(key, value) of 'KEY = VALUE' lines."""
    pattern = r"^([A-Z_]+)\s*=\s*(.*)"
    lines = spark.read.text(path).where(F.col("value").rlike(pattern))
    return lines.select(F.regexp_extract("value", pattern, 1).alias("key"), F.regexp_extract("value", pattern, 2).alias("value"))


def read_info(spark: SparkSession, path: str) -> DataFrame:
    """(path, key, value) of 'key: value' lines before the notes, and the notes as a key of their own."""
    files = spark.read.option("wholetext", True).text(path).select(F.col("_metadata.file_path").alias("path"), F.split("value", "notes:", 2).alias("parts"))
    line = files.select("path", F.explode(F.split(F.get("parts", 0), "\n")).alias("line")).where(F.col("line").contains(":"))
    pairs = line.select("path", F.trim(F.substring_index("line", ":", 1)).alias("key"), F.trim(F.regexp_replace("line", r"^[^:]*:", "")).alias("value"))
    return pairs.union(files.where(F.size("parts") > 1).select("path", F.lit("notes"), F.rtrim(F.get("parts", 1), F.lit("\n"))))


def render_info(df: DataFrame, template: str, notes: str = "notes") -> DataFrame:
    """df with ``text``: the template with its marks filled; missing, 'None' and '-' become empty, unknown keys stay."""
    import re

    out = F.lit(template)
    for mark in dict.fromkeys(re.findall(r"\{.*?\}", template)):
        key = mark[1:-1].partition("|")[0].strip()
        if key in df.columns:
            c = F.col(key).cast("string")
            out = F.replace(out, F.lit(mark), F.when(c.isNull() | c.isin("None", "-"), "").otherwise(c))
    return df.withColumn("text", out)


def append_history(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def tables_like(spark: SparkSession, prefix: str) -> list[str]:
    """Names of the catalogue's tables that begin with a prefix, ignoring case."""
    return sorted(t.name for t in spark.catalog.listTables() if t.name.lower().startswith(prefix.lower()))


def load_tables(spark: SparkSession, mode: str, tables: dict[str, DataFrame]) -> None:
    """Replace this mode's tables; those of other modes stay."""
    for name, df in tables.items():
        df.write.mode("overwrite").saveAsTable(f"{mode}_{name}")


def drop_mode(spark: SparkSession, mode: str) -> None:
    for name in tables_like(spark, f"{mode}_"):
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def read_folders(spark: SparkSession, path: str) -> DataFrame:
    """(genus, species) of folders two levels down that hold a file; hidden and deleted ones are left out."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select(F.split("path", "/").alias("p"))
    depth = len(path.rstrip("/").removeprefix("file://").split("/"))
    skip = F.size(F.split(F.lit("file:"), "/"))
    rest = files.select(F.slice("p", depth + skip, 3).alias("d")).where(F.size("d") == 3)
    genus, species = F.get("d", 0), F.get("d", 1)
    shown = ~genus.startswith(".") & ~species.startswith(".") & ~genus.startswith("_deleted_")
    return rest.where(shown).select(genus.alias("genus"), species.alias("species")).distinct()


def read_genera(spark: SparkSession, main: str, custom: str | None = None) -> DataFrame:
    """(genus, status): a custom list's names (capitalised, status '-') if one is given, else the main list with statuses in lower
    case and without blank names."""
    from basalt.schemas import GENERA_LIST

    if custom is not None:
        return read_lines(spark, custom, "capitalize").select(F.col("name").alias("genus"), F.lit("-").alias("status"))
    rows = read_csv(spark, main, GENERA_LIST).select(F.trim("genus").alias("genus"), F.lower(F.trim("status")).alias("status"))
    return rows.where("genus <> ''")


def write_names_json(df: DataFrame, path: str, name: str = "name") -> bool:
    """The sorted distinct names as JSON Lines; an empty table removes the dataset instead. True if there is one."""
    spark = df.sparkSession
    if df.isEmpty():
        jvm = spark.sparkContext._jvm
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
        return False
    df.select(name).distinct().orderBy(name).write.mode("overwrite").json(path)
    return True


def write_json_map(df: DataFrame, path: str) -> None:
    """(pos, key, value) as one JSON object in order of pos; a snapshot's size, as its consumers read it whole."""
    pairs = F.array_sort(F.collect_list(F.struct("pos", "key", "value")))
    entries = F.transform(pairs, lambda x: F.struct(x["key"], x["value"]))
    df.agg(F.to_json(F.map_from_entries(entries)).alias("value")).write.mode("overwrite").text(path)


def write_catalog_json(df: DataFrame, path: str) -> None:
    """The work catalogue: one JSON object a line, nulls left out; each part is a file of its own."""
    df.write.mode("overwrite").json(path)


def read_catalog_json(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).json(path)


def merge_settings(own: DataFrame, defaults: DataFrame) -> DataFrame:
    """(key, value) of defaults, with the value that own gives where it has the key; its last one, and other keys are dropped."""
    held = own.groupBy("key").agg(F.last("value").alias("__own"))
    return defaults.join(held, "key", "left").select("key", F.coalesce("__own", "value").alias("value"))


def read_mode_table(spark: SparkSession, mode: str, name: str) -> DataFrame:
    return spark.table(f"{mode}_{name}")
