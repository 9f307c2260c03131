"""Governance as data: reports over catalog, tag, grant and lineage tables.

Enforcement is the catalog server's job and is not rebuilt; these are the
questions the reference asks of its catalog, answered with joins and
aggregates so they scale to estates with millions of columns and grants.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

INVENTORY_SCHEMA = T.StructType([
    T.StructField("table_catalog", T.StringType()),
    T.StructField("table_schema", T.StringType()),
    T.StructField("table_name", T.StringType()),
    T.StructField("column_name", T.StringType()),
    T.StructField("ordinal_position", T.LongType()),
    T.StructField("data_type", T.StringType()),
    T.StructField("comment", T.StringType()),
])


def column_inventory(spark: SparkSession, tables: Mapping[str, DataFrame], catalog: str = "spark_catalog",
                     schema: str = "default") -> DataFrame:
    """``information_schema.columns`` for the given relations (schemas only:
    one row per column, read from each relation's metadata)."""
    rows = []
    for name, df in tables.items():
        for pos, f in enumerate(df.schema.fields, start=1):
            rows.append((catalog, schema, name, f.name, pos, f.dataType.simpleString(),
                         f.metadata.get("comment")))
    return spark.createDataFrame(rows, INVENTORY_SCHEMA)


def column_coverage(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Non-null rows of every column: one aggregate pass per table (all columns
    at once), unpivoted to one row per (table_name, column_name)."""
    parts = []
    for name, df in tables.items():
        counts = df.agg(*[F.count(F.col(f"`{c}`")).alias(f"c{i}") for i, c in enumerate(df.columns)])
        parts.append(counts.select(F.explode(F.array(*[
            F.struct(F.lit(name).alias("table_name"), F.lit(c).alias("column_name"),
                     F.col(f"c{i}").alias("non_null_rows")) for i, c in enumerate(df.columns)])).alias("x"))
                     .select("x.*"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def catalog_inventory(spark: SparkSession, database: str) -> DataFrame:
    """The same from the session catalog (``spark.catalog.listColumns``)."""
    rows = []
    for t in spark.catalog.listTables(database):
        cols = spark.catalog.listColumns(t.name) if t.isTemporary else spark.catalog.listColumns(t.name, database)
        for pos, c in enumerate(cols, start=1):
            rows.append((spark.catalog.currentCatalog(), database, t.name, c.name, pos, c.dataType, c.description))
    return spark.createDataFrame(rows, INVENTORY_SCHEMA)


# The personal-data search of the reference (name patterns and comment phrase).
PII_NAME_PATTERNS = ("%email%", "%phone%")
PII_COMMENT_PATTERN = "%personal data%"


def pii_columns(inventory: DataFrame, name_patterns: Sequence[str] = PII_NAME_PATTERNS,
                comment_pattern: str | None = PII_COMMENT_PATTERN) -> DataFrame:
    """Columns whose name or comment suggests personal data."""
    cond: Column = F.lit(False)
    for p in name_patterns:
        cond = cond | F.lower(F.col("column_name")).like(p)
    if comment_pattern:
        cond = cond | F.coalesce(F.lower(F.col("comment")).like(comment_pattern), F.lit(False))
    return inventory.where(cond)


def tagged_columns(inventory: DataFrame, tags: DataFrame) -> DataFrame:
    """``information_schema.column_tags`` joined to the inventory.

    ``tags``: table_name, column_name, tag_name, tag_value.
    """
    return inventory.join(tags, ["table_name", "column_name"], "inner")


def current_grants(ledger: DataFrame) -> DataFrame:
    """Standing grants after a GRANT/REVOKE sequence.

    ``ledger``: ts, seq, action, privilege, object_type, object_name, principal.
    The newest action per (privilege, object, principal) wins; keep GRANTs.
    ``seq`` breaks ties between actions at the same instant. The window is
    partitioned by the grant key and cut to one row per key on both sides of
    the exchange, so a principal with millions of actions stays cheap.
    """
    newest = Window.partitionBy("privilege", "object_type", "object_name", "principal") \
        .orderBy(F.col("ts").desc(), F.col("seq").desc())
    return (ledger.withColumn("_rn", F.row_number().over(newest))
            .where((F.col("_rn") == 1) & (F.col("action") == "GRANT"))
            .select("principal", "privilege", "object_type", "object_name"))


def effective_access(grants: DataFrame, catalog: str, schema: str, obj: str) -> DataFrame:
    """Principals that can read ``catalog.schema.obj``: USE CATALOG on the
    catalog, USE SCHEMA on the schema and SELECT on the object, all three.

    One aggregate by principal (partial aggregation on the map side), not
    three joins."""
    full = f"{catalog}.{schema}.{obj}"

    def holds(priv: str, otype: str, name: str) -> Column:
        return F.max(((F.col("privilege") == priv) & (F.col("object_type") == otype)
                      & (F.col("object_name") == name)).cast("int"))

    return (grants.groupBy("principal")
            .agg(holds("SELECT", "TABLE", full).alias("_sel"),
                 holds("USE SCHEMA", "SCHEMA", f"{catalog}.{schema}").alias("_sch"),
                 holds("USE CATALOG", "CATALOG", catalog).alias("_cat"))
            .where((F.col("_sel") == 1) & (F.col("_sch") == 1) & (F.col("_cat") == 1))
            .select("principal", F.lit(full).alias("object_name")))


def access(grants: DataFrame, objects: DataFrame) -> DataFrame:
    """Who can read what: every principal and object (``catalog``, ``schema``, ``object``) such that the principal holds
    SELECT on the object, its schema or its catalog, USE SCHEMA on the schema or the catalog, and USE CATALOG.

    Privileges are inherited downwards. The work starts from SELECT grants, each joined to the objects under what it names,
    and is as large as the answer; what the principal may use is then looked up by schema and by catalog, all with
    equijoins. ``object_name`` of a grant is ``catalog``, ``catalog.schema`` or ``catalog.schema.object``."""
    named = objects.select("catalog", F.concat_ws(".", "catalog", "schema").alias("in_schema"),
                           F.concat_ws(".", "catalog", "schema", "object").alias("object_name")).distinct()
    under = named.select("*", F.explode(F.array("catalog", "in_schema", "object_name")).alias("granted_on"))

    def held(privilege: str, *types: str) -> DataFrame:
        return (grants.where((F.col("privilege") == privilege) & F.col("object_type").isin(*types))
                .select("principal", F.col("object_name").alias("granted_on")).distinct())

    select = under.join(held("SELECT", "CATALOG", "SCHEMA", "TABLE"), "granted_on") \
        .select("principal", "object_name", "in_schema", "catalog").distinct()
    schemas = held("USE SCHEMA", "CATALOG", "SCHEMA")
    containers = named.select("catalog", "in_schema").distinct()
    usable = (containers.select("in_schema", F.explode(F.array("catalog", "in_schema")).alias("granted_on"))
              .join(schemas, "granted_on").select("principal", "in_schema"))
    return (select.join(usable, ["principal", "in_schema"], "left_semi")
            .join(held("USE CATALOG", "CATALOG").withColumnRenamed("granted_on", "catalog"), ["principal", "catalog"], "left_semi")
            .select("principal", "object_name"))


def data_dictionary(spark: SparkSession, tables: Mapping[str, DataFrame]) -> DataFrame:
    """Every column with its place, type, comment and number of values."""
    inventory = column_inventory(spark, tables)
    return inventory.join(column_coverage(tables), ["table_name", "column_name"]).select(
        "table_name", "column_name", "ordinal_position", "data_type", "comment", "non_null_rows")


def recent_lineage(edges: DataFrame, target_prefix: str, since, top: int = 20) -> DataFrame:
    """Newest lineage edges into a schema (prefix match, not ``LIKE``: ``_`` is
    literal) since a date; top-k by time with a unique tiebreak."""
    return (edges.where(F.col("target_table_full_name").startswith(target_prefix)
                        & (F.col("event_date") >= F.lit(since).cast("date")))
            .orderBy(F.col("event_time").desc(), F.col("edge_id").desc())
            .limit(int(top))
            .select("source_table_full_name", "target_table_full_name", "event_time", "edge_id"))
