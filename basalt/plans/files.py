"""Queries that write a table in one of the catalogue's file formats and read it back, with SQL over the table itself."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basalt import schemas
from basalt.operators import audit, catalog, pages
from basalt.plans.registry import _STATUS_SQL, _lineages, _rows, _status_of, _t, query
from basalt.sources import io
from basalt.storage import new_dir

# --- files


def _fauna(spark: SparkSession, d: str) -> DataFrame:
    p = F.col("p_partkey")
    return _t(spark, d, "part").select(
        F.col("p_brand").alias("genus"), F.concat(F.lit('a "b";'), F.col("p_name")).alias("species"), _status_of(p).alias("status"), (F.col("p_size") % 2 == 0).alias("is_type"),
        F.when(p % 3 > 0, F.col("p_type")).alias("clade"), F.lit("").alias("stage"), F.col("p_size").cast("string").alias("age"), F.lit("-").alias("author"), F.when(p % 2 == 0, "1900").alias("year"), p.cast("string").alias("source_genus"),
    )


_FAUNA_SQL = f"""SELECT p_partkey::VARCHAR AS source_genus, p_brand AS genus, 'a "b";' || p_name AS species, {_STATUS_SQL.format("p_partkey")} AS status, p_size % 2 = 0 AS is_type,
    CASE WHEN p_partkey % 3 > 0 THEN p_type ELSE '-' END AS clade, '' AS stage, p_size::VARCHAR AS age, '-' AS author, CASE WHEN p_partkey % 2 = 0 THEN '1900' ELSE '-' END AS year FROM part"""


@query("csv_round_trip", _FAUNA_SQL)
def _(spark, d):
    path = new_dir(spark, "csv")
    io.write_csv(_fauna(spark, d), path, schemas.FAUNA)
    return io.read_csv(spark, path, schemas.FAUNA).withColumn("stage", F.coalesce("stage", F.lit("")))


@query("csv_lenient_write", f"SELECT genus, species, status FROM ({_FAUNA_SQL})")
def _(spark, d):
    path = new_dir(spark, "csv")
    io.write_csv(_fauna(spark, d), path, schemas.PRODUCTION, lenient=True)
    return io.read_csv(spark, path, schemas.PRODUCTION)


@query("ragged_round_trip", "SELECT s_name AS lowest_unit, s_suppkey::VARCHAR AS source_genus, CASE s_suppkey % 3 WHEN 0 THEN '' WHEN 1 THEN r_name ELSE r_name || '|' || n_name END AS path, CASE s_suppkey % 3 WHEN 0 THEN 0 WHEN 1 THEN 1 ELSE 2 END AS depth FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey")
def _(spark, d):
    path = new_dir(spark, "ragged")
    rows = _lineages(spark, d).select(F.col("source").alias("lowest_unit"), F.col("pos").cast("string").alias("source_genus"), F.slice("lineage", 1, (F.col("pos") % 3).cast("int")).alias("path"))
    io.write_ragged(rows, path)
    return io.read_ragged(spark, path).withColumn("depth", F.size("path")).withColumn("path", F.array_join("path", "|"))


@query("ragged_depth", "SELECT 2 AS columns_before, max(s_suppkey % 3) AS deepest FROM supplier")
def _(spark, d):
    path = new_dir(spark, "ragged")
    rows = _lineages(spark, d).select(F.col("source").alias("lowest_unit"), F.lit("x").alias("source_genus"), F.slice("lineage", 1, (F.col("pos") % 3).cast("int")).alias("path"))
    io.write_ragged(rows, path)
    cells = len(spark.read.option("sep", ";").option("header", True).csv(path).columns)
    return spark.range(1).select(F.lit(2).alias("columns_before"), F.lit(cells - 2).cast("long").alias("deepest"))


@query("lines_round_trip", "SELECT upper(n[1]) || lower(n[2:]) AS name FROM (SELECT trim(c_name) AS n FROM customer)")
def _(spark, d):
    path = new_dir(spark, "lines")
    c = _t(spark, d, "customer")
    lines = c.select(F.concat(F.lit("  "), "c_name", F.lit(" ")).alias("value")).union(c.where("c_custkey % 5 = 0").select(F.lit("   ")))
    lines.write.text(path)
    return io.read_lines(spark, path, "capitalize")


@query("json_map_round_trip", "SELECT row_number() OVER (ORDER BY n_nationkey DESC) - 1 AS pos, n_name AS key, n_regionkey::VARCHAR AS value FROM nation")
def _(spark, d):
    path = new_dir(spark, "map")
    io.write_json_map(_t(spark, d, "nation").select((-F.col("n_nationkey")).alias("pos"), F.col("n_name").alias("key"), F.col("n_regionkey").cast("string").alias("value")), path)
    return io.read_json_map(spark, path)


@query("names_json_union", "SELECT n_name AS name FROM nation UNION ALL SELECT r_name FROM region")
def _(spark, d):
    one, two = new_dir(spark, "names"), new_dir(spark, "names")
    _t(spark, d, "nation").agg(F.to_json(F.collect_list("n_name")).alias("value")).write.text(one)
    io.write_json_map(_t(spark, d, "region").select(F.col("r_regionkey").alias("pos"), F.col("r_name").alias("key"), F.lit("x").alias("value")), two)
    return io.read_names_json(spark, one).union(io.read_names_json(spark, two))


@query("sorted_names", "SELECT DISTINCT p_name AS name FROM part")
def _(spark, d):
    path = new_dir(spark, "names")
    rows = _t(spark, d, "part").select(F.col("p_name").alias("name"))
    io.write_names_json(rows, path)
    empty = new_dir(spark, "names")
    io.write_names_json(rows, empty)
    assert not io.write_names_json(rows.limit(0), empty)  # an empty registry is no file
    return spark.read.schema("name string").json(path)


@query("catalog_json", "SELECT c_name AS genus, c_mktsegment AS species, 'free' AS status FROM customer")
def _(spark, d):
    path = new_dir(spark, "catalog")
    rows = _t(spark, d, "customer").select(F.col("c_name").alias("genus"), F.col("c_mktsegment").alias("species"), F.lit("free").alias("status"))
    io.write_catalog_json(rows, path)
    return io.read_catalog_json(spark, path, schemas.PRODUCTION)


@query("settings_merge", "SELECT 'KEY_' || chr(65 + n_nationkey::INT) AS key, CASE WHEN n_nationkey % 2 = 0 THEN 'own ' || n_nationkey ELSE 'default' END AS value FROM nation WHERE n_nationkey % 3 > 0")
def _(spark, d):
    path = new_dir(spark, "settings")
    n = _t(spark, d, "nation").withColumn("key", F.concat(F.lit("KEY_"), F.char(F.col("n_nationkey") + 65)))
    lines = n.where("n_nationkey % 2 = 0").select(F.concat("key", F.lit(" =  own "), F.col("n_nationkey").cast("string")).alias("value"))
    lines.union(n.select(F.lit("# no setting"))).write.text(path)
    return io.merge_settings(io.read_settings(spark, path), n.where("n_nationkey % 3 > 0").select("key", F.lit("default").alias("value")))


@query("info_round_trip", "SELECT c_custkey::VARCHAR AS id, c_name AS species, CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment ELSE '' END AS \"user\", ' mine: all of it' AS notes FROM customer WHERE c_custkey <= 60")
def _(spark, d):
    path = new_dir(spark, "info")
    rows = _t(spark, d, "customer").where("c_custkey <= 60").select("c_custkey", F.col("c_name").alias("species"), F.when(F.col("c_custkey") % 2 == 0, F.col("c_mktsegment")).alias("user"), F.lit(" mine: all of it").alias("kept"))
    text = io.render_info(rows, "species: {species|}\nuser: {user|me}\nnotes:{kept}")
    text.select(F.col("c_custkey").alias("id"), "text").write.partitionBy("id").option("lineSep", "\n").text(path)
    pairs = io.read_info(spark, path + "/*").withColumn("id", F.regexp_extract("path", r"id=(\d+)", 1))
    return pairs.groupBy("id").agg(*(F.max(F.when(F.col("key") == k, F.col("value"))).alias(k) for k in ("species", "user", "notes")))


@query("folder_listing", "SELECT DISTINCT 'g=' || r_name AS genus, 's=' || translate(n_name, ' ', '_') AS species FROM nation JOIN region ON n_regionkey = r_regionkey")
def _(spark, d):
    path = new_dir(spark, "folders")
    rows = _t(spark, d, "nation").join(_t(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("r_name").alias("g"), F.translate("n_name", " ", "_").alias("s"), F.lit("x").alias("value"))
    rows.write.partitionBy("g", "s").text(path)
    rows.limit(1).select("value").write.text(f"{path}/_deleted_old/x")
    return io.read_folders(spark, path)


@query("genera_source", "SELECT c_mktsegment AS genus, 'valid' AS status FROM customer WHERE c_custkey % 4 > 0 UNION ALL SELECT upper(c_name[1]) || lower(c_name[2:]), '-' FROM customer WHERE c_custkey % 4 = 0")
def _(spark, d):
    main, own = new_dir(spark, "main"), new_dir(spark, "own")
    c = _t(spark, d, "customer")
    listed = c.where("c_custkey % 4 > 0").select(F.concat(F.lit(" "), "c_mktsegment").alias("genus"), F.lit(" VALID").alias("status"))
    io.write_csv(listed.union(c.limit(3).select(F.lit(" "), F.lit("x"))), main)
    c.where("c_custkey % 4 = 0").select(F.lower("c_name").alias("value")).write.text(own)
    return io.read_genera(spark, main).union(io.read_genera(spark, "", own))


@query("mode_tables", "SELECT n_nationkey, n_name, 1 AS tables FROM nation")
def _(spark, d):
    mode = f"q{new_dir(spark, 'mode')[-12:]}"
    nation = _t(spark, d, "nation").select("n_nationkey", "n_name")
    io.load_tables(spark, mode, {"a": nation.limit(1)})
    io.load_tables(spark, mode, {"a": nation, "b": nation})
    spark.sql(f"DROP TABLE {mode}_b")
    out = io.read_mode_table(spark, mode, "a").withColumn("tables", F.lit(len(io.tables_like(spark, f"{mode}_"))))
    held = spark.createDataFrame(out.collect(), out.schema)  # 25 rows
    io.drop_mode(spark, mode)
    assert not io.tables_like(spark, mode)
    return held


@query("history_log", "SELECT 1 AS run, 'BASELINE' AS tag, count(*) AS n FROM orders WHERE o_orderkey % 5 > 0 UNION ALL SELECT 3, o_orderstatus, count(*) FROM orders WHERE o_orderkey % 5 = 0 GROUP BY ALL")
def _(spark, d):
    path = new_dir(spark, "history")
    o = _t(spark, d, "orders")
    change = lambda c, tag: o.where(c).select(F.lit("p").alias("page"), F.col("o_orderkey").cast("string").alias("species"), tag.alias("change"))
    runs = ((1, change("o_orderkey % 5 > 0", F.lit("INIT")), True), (2, change("o_orderkey % 5 > 0", F.lit("OK")), False), (3, change("o_orderkey % 5 = 0", F.col("o_orderstatus")), False))
    for run, diff, first in runs:
        io.append_history(audit.history_entries(diff, first).withColumn("run", F.lit(run)), path)
    return spark.read.parquet(path).select("run", "tag", "n")


# --- catalogue


@query(
    "catalog_sync",
    """SELECT 'G' || c_custkey % 50 AS genus, 's' || c_custkey AS species, 'valid' AS status, CASE WHEN c_custkey % 3 = 0 THEN c_mktsegment ELSE 'free' END AS m_status, '' AS "user",
    CASE WHEN c_custkey % 3 = 0 THEN 'mesh' ELSE 'skeletal' END AS stage, 'False' AS is_approved, '' AS s_author FROM customer""",
)
def _(spark, d):
    c = _t(spark, d, "customer").select("c_custkey", "c_mktsegment", F.concat(F.lit("G"), F.col("c_custkey") % 50).alias("genus"), F.concat(F.lit("s"), "c_custkey").alias("species"))
    listed = c.select("genus", "species", F.lit("valid").alias("status"))
    entries = c.where("c_custkey % 3 = 0").select(F.upper("genus").alias("genus"), "species", F.lit("old").alias("status"), F.col("c_mktsegment").alias("m_status"), F.lit("mesh").alias("stage"), F.lit(1).alias("gone"))
    entries = entries.union(c.where("c_custkey = 1").select(F.lit("Lost"), F.lit("entry"), F.lit("x"), F.lit("x"), F.lit("rig"), F.lit(1)))
    moves = _rows(spark, "pos long, old_name string, new_genus string", (0, "Nobody here", "G7"))
    return catalog.sync(listed, entries, moves, catalog.parse_template("{genus|} {species|} {status|}\n{m_status|free} {user|}"))


@query(
    "catalog_moved_entry",
    "SELECT 'G' || c_custkey % 50 AS genus, 's' || c_custkey AS species, CASE WHEN c_custkey % 50 = 7 THEN 'kept' ELSE 'free' END AS m_status FROM customer",
)
def _(spark, d):
    c = _t(spark, d, "customer").select(F.concat(F.lit("G"), F.col("c_custkey") % 50).alias("genus"), F.concat(F.lit("s"), "c_custkey").alias("species"), F.lit("valid").alias("status"))
    entries = _rows(spark, "genus string, species string, status string, m_status string", ("Old", "name", "x", "kept"), ("Later", "name", "x", "no"))
    moves = _rows(spark, "pos long, old_name string, new_genus string", (0, "Gone name", "G7"), (2, "Later name", "g7"), (1, "old Name", "g7"))
    return catalog.sync(c, entries, moves, catalog.parse_template("{genus|} {species|}\n{m_status|free}")).select("genus", "species", "m_status")


@query(
    "submit_specimens",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 AND o_orderkey % 3 = 0 THEN 'b' || o_orderkey ELSE 'old' END AS base_specimen,
    CASE WHEN o_orderkey % 2 = 0 AND o_orderkey % 3 = 0 AND o_orderkey % 5 > 0 THEN 's' || o_orderkey ELSE 'old' END AS scale_specimen FROM orders""",
)
def _(spark, d):
    o = F.col("o_orderkey")
    rows = _t(spark, d, "orders").select(o, F.when(o % 2 == 0, "busy").otherwise("free").alias("m_status"), F.lit("ann").alias("user"), F.when(o % 3 == 0, "skeletal").otherwise("mesh").alias("stage"), F.lit("old").alias("base_specimen"), F.lit("old").alias("scale_specimen"))
    note = F.struct(F.concat(F.lit("b"), o).alias("base_specimen"), F.when(o % 5 > 0, F.concat(F.lit("s"), o)).otherwise("").alias("scale_specimen"))
    return rows.withColumns(catalog.specimens(F.lit("submit"), F.lit("ann"), note)).select("o_orderkey", "base_specimen", "scale_specimen")


@query("own_work", "SELECT o_orderkey FROM orders WHERE o_orderkey % 4 = 1 AND o_custkey % 2 = 0")
def _(spark, d):
    rows = _t(spark, d, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 4 == 1, "busy").otherwise("review").alias("m_status"), F.when(F.col("o_custkey") % 2 == 0, "ann").otherwise("bob").alias("user"))
    return catalog.mine(rows, F.lit("ann")).select("o_orderkey")


# --- reports


@query("report_lists", f"SELECT s AS section, count(*) AS n, string_agg(p_name || p_partkey, ',' ORDER BY p_name || p_partkey) AS entries FROM (SELECT *, {_STATUS_SQL.format('p_partkey')} AS s FROM part) GROUP BY s")
def _(spark, d):
    rows = _t(spark, d, "part").select(_status_of(F.col("p_partkey")).alias("section"), F.concat("p_name", "p_partkey").alias("entry"))
    return pages.report(rows).withColumn("entries", F.array_join("entries", ","))


@query("report_totals", "SELECT count(*) FILTER (p_size % 7 < 3) AS suspicious, count(*) AS total FROM part")
def _(spark, d):
    tags = F.array(*map(F.lit, ("ZERO", "NO_INFOBOX", "OUT_OF_SCOPE", "OK", "ALIAS", "OK", "OK")))
    return pages.totals(_t(spark, d, "part").select(F.get(tags, F.col("p_size") % 7).alias("outcome")))


@query("outcomes_table", f"SELECT 'status' AS stage, {_STATUS_SQL.format('p_partkey')} AS outcome, count(*) AS n FROM part GROUP BY ALL UNION ALL SELECT 'age', CASE WHEN p_size % 2 = 0 THEN 'OK' ELSE 'SKIP' END, count(*) FROM part GROUP BY ALL")
def _(spark, d):
    part = _t(spark, d, "part")
    age = F.when(F.col("p_size") % 2 == 0, "OK").otherwise("SKIP")
    return pages.outcomes({"status": part.select(_status_of(F.col("p_partkey")).alias("outcome")), "age": part.select(age.alias("outcome"))})


# --- order and scalars


@query("type_last_order", "SELECT p_partkey, row_number() OVER (ORDER BY p_brand, p_size % 2 = 0, CASE WHEN p_partkey % 3 > 0 THEN 1800 + p_size END NULLS FIRST, p_partkey) AS place FROM part")
def _(spark, d):
    from basalt.operators.ordering import numbered, type_last_order

    p = F.col("p_partkey")
    rows = _t(spark, d, "part").select(p, F.col("p_brand").alias("genus"), (F.col("p_size") % 2 == 0).alias("is_type"), F.when(p % 3 > 0, F.col("p_size") + 1800).alias("year"))
    return numbered(rows, [*type_last_order(), "p_partkey"], "place").select("p_partkey", "place")


@query("log_prefix", "SELECT doc_id, text[:70] AS head FROM documents")
def _(spark, d):
    from basalt.functions.text import log_prefix

    return _t(spark, d, "documents").select("doc_id", log_prefix(F.col("text")).alias("head"))


@query("fact_values", "SELECT p_partkey, p_name || ' | ' || CASE WHEN p_size % 3 = 0 THEN '-' ELSE p_type END || ' | ' || p_size AS value, CASE WHEN p_size % 3 = 0 THEN '-' ELSE p_type END AS middle, p_size::VARCHAR AS last FROM part")
def _(spark, d):
    from basalt.functions.text import fact_value, split_fact

    value = fact_value("p_name", F.when(F.col("p_size") % 3 > 0, F.col("p_type")), "p_size")
    parts = split_fact(value)
    return _t(spark, d, "part").select("p_partkey", value.alias("value"), F.get(parts, 1).alias("middle"), F.element_at(parts, -1).alias("last"))


@query("fact_keys", "SELECT o_orderkey, 'SPECIES' AS kind, 'C' || o_custkey AS page, o_orderpriority AS species FROM orders WHERE o_orderkey % 2 = 0 UNION ALL SELECT o_orderkey, 'DATA', 'C' || o_custkey, NULL FROM orders WHERE o_orderkey % 2 > 0")
def _(spark, d):
    from basalt.functions.text import split_key

    page = F.concat(F.lit("C"), "o_custkey")
    key = F.when(F.col("o_orderkey") % 2 == 0, F.concat_ws(":", F.lit("SPECIES"), page, "o_orderpriority")).otherwise(F.concat_ws(":", F.lit("DATA"), page))
    return _t(spark, d, "orders").select("o_orderkey", split_key(key).alias("k")).select("o_orderkey", "k.*")


@query("timestamp_text", "SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS stamp FROM events")
def _(spark, d):
    from basalt.functions.text import stamp

    return _t(spark, d, "events").select("event_id", stamp(F.col("ts")).alias("stamp"))


@query("page_candidates", "SELECT p_partkey, k, 'https://host/wiki/' || translate(p_name, ' ', '_') || s AS url FROM part, (VALUES (0, ''), (1, '_(dinosaur)'), (2, '_(reptile)'), (3, '_(archosaur)')) c(k, s)")
def _(spark, d):
    from basalt.plans.research import candidates

    rows = _t(spark, d, "part").select("p_partkey", F.col("p_name").alias("genus"))
    return candidates(rows, "https://host/wiki/").select("p_partkey", "k", "url")


@query("certain_part", "SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN p_type ELSE p_type || ', ' || p_size || ' Ma' END AS certain FROM part")
def _(spark, d):
    from basalt.functions.text import certain_part

    whole = F.when(F.col("p_size") % 2 == 0, F.concat("p_type", F.lit(", ( Possible "), "p_name")).otherwise(F.concat("p_type", F.lit(", "), F.col("p_size").cast("string"), F.lit(" Ma")))
    return _t(spark, d, "part").select("p_partkey", certain_part(whole).alias("certain"))


@query("skip_ages", "SELECT p_partkey AS id, CASE p_partkey % 4 WHEN 3 THEN 'OUT_OF_BOUNDS' ELSE 'SKIP' END AS outcome FROM part")
def _(spark, d):
    from basalt.operators.interval import assign_stages
    from basalt.plans.registry import _scale

    ages = F.array(F.lit("-"), F.lit("Unknown"), F.lit("late, no number"), F.lit("900"))
    rows = _t(spark, d, "part").select(F.col("p_partkey").alias("id"), F.get(ages, (F.col("p_partkey") % 4).cast("int")).alias("age"), F.lit("-").alias("stage"))
    return assign_stages(rows, _scale(spark)).select("id", "outcome")


@query("whitelist_guard", "SELECT 0 AS listed, c_custkey FROM customer UNION ALL SELECT 1, c_custkey FROM customer WHERE c_mktsegment = 'BUILDING'")
def _(spark, d):
    from basalt.plans.research import only_listed

    c = _t(spark, d, "customer").select("c_custkey", F.col("c_mktsegment").alias("genus"))
    empty, own = _rows(spark, "name string"), _rows(spark, "name string", ("building",))
    return only_listed(c, empty).select(F.lit(0).alias("listed"), "c_custkey").union(only_listed(c, own).select(F.lit(1), "c_custkey"))
