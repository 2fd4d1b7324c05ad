"""Schema versions of a log: reading across versions, and what changed between them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

SCHEMA_COLUMNS = (
    "subject STRING, version INT, field STRING, type STRING, required BOOLEAN, "
    "symbols STRING, alias_of STRING"
)

MODES = ["backward", "forward", "full", "none"]

# Change, then whether it is allowed as BACKWARD, FORWARD, FULL, NONE.
COMPATIBILITY_RULES = [
    ("add optional field", True, True, True, True),
    ("add required field", False, True, False, True),
    ("remove optional field", True, True, True, True),
    ("remove required field", True, False, False, True),
    ("rename field", False, False, False, True),
    ("change field type", False, False, False, True),
    ("add enum symbol", False, True, False, True),
    ("remove enum symbol", True, False, False, True),
]

#: The last two rules as binary resolution really treats them (a reader that knows more symbols can
#: read older data); pass ``rules=RESOLUTION_RULES`` to use them.
RESOLUTION_RULES = COMPATIBILITY_RULES[:6] + [
    ("add enum symbol", True, False, False, True),
    ("remove enum symbol", False, True, False, True),
]


def evolve_read(values: DataFrame, reader: T.StructType, value: str = "value") -> DataFrame:
    """Read JSON records of any version with the reader's schema; absent fields are null."""
    decoded = F.from_json(F.col(value), reader)
    return values.withColumn("_record", decoded).select(
        *[c for c in values.columns if c != value], "_record.*"
    )


def union_versions(*versions: DataFrame) -> DataFrame:
    """Typed tables of several versions as one; absent columns are null."""
    first, *rest = versions
    for other in rest:
        first = first.unionByName(other, allowMissingColumns=True)
    return first


def observed_schemas(
    records: DataFrame, subject: str, version: str, value: str, enum_fields: list[str] | None = None
) -> DataFrame:
    """The schema table of JSON records that carry a version number, found from the records in one pass.

    A field is required when every record of the version has a non-null value.  Integers next to other numbers are
    numbers; a field with values of several other types has all their names, in order and joined by ``|``.  Nested
    values count as ``object`` or ``array``.  Enum fields list their symbols (an enum's domain is small by
    definition).  Records that are no JSON object have no fields, so a version that has any requires none.
    """
    spark = records.sparkSession
    fields = records.select(
        F.col(subject).alias("subject"),
        F.col(version).cast("int").alias("version"),
        F.try_parse_json(F.col(value)).alias("_json"),
    ).lateralJoin(spark.tvf.variant_explode_outer(F.col("_json").outer()).toDF("_pos", "field", "_v"))
    kind = F.schema_of_variant("_v")
    type_name = (
        F.when(kind == "VOID", F.lit(None))
        .when(kind == "BIGINT", "integer")
        .when((kind == "DOUBLE") | kind.startswith("DECIMAL"), "number")
        .when(kind.startswith("OBJECT"), "object")
        .when(kind.startswith("ARRAY"), "array")
        .otherwise(F.lower(kind))
    )
    symbol = F.when(F.col("field").isin(enum_fields or []), F.try_variant_get("_v", "$", "string"))
    per_field = fields.select(
        "subject",
        "version",
        "field",
        type_name.alias("type"),
        (kind != "VOID").alias("present"),
        symbol.alias("symbol"),
        # Each record has exactly one row that is its first.
        (F.coalesce("_pos", F.lit(0)) == 0).alias("first"),
    )
    types = F.collect_set("type")
    wide = F.when(F.array_contains("_types", "number"), F.array_remove("_types", "integer")).otherwise(F.col("_types"))
    counted = per_field.groupBy("subject", "version", "field").agg(
        types.alias("_types"),
        F.count_if("present").alias("_present"),
        F.count_if("first").alias("_firsts"),
        F.array_join(F.array_sort(F.collect_set("symbol")), ",").alias("symbols"),
    )
    whole = Window.partitionBy("subject", "version")  # one row per field
    sized = counted.withColumn("_records", F.sum("_firsts").over(whole)).where(F.col("field").isNotNull())
    return sized.select(
        "subject",
        "version",
        "field",
        F.when(F.size("_types") > 0, F.array_join(F.array_sort(wide), "|")).alias("type"),
        (F.col("_present") == F.col("_records")).alias("required"),
        "symbols",
        F.lit(None).cast("string").alias("alias_of"),
    )


def subject_versions(schemas: DataFrame) -> DataFrame:
    """Versions per subject and the latest one."""
    return schemas.groupBy("subject").agg(
        F.max("version").alias("latest_version"),
        F.array_join(F.array_sort(F.collect_set("version")), ",").alias("versions"),
    )


def _split(c: str) -> Column:
    return F.filter(F.split(F.coalesce(F.col(c), F.lit("")), ","), lambda s: s != "")


def schema_changes(schemas: DataFrame) -> DataFrame:
    """What changed on each field from one version of a subject to the next.

    A rename is reported only when the new field names the old one in ``alias_of``.
    """
    versions = schemas.select("subject", "version").distinct()
    following = Window.partitionBy("subject").orderBy("version")
    pairs = versions.withColumn("_from", F.lag("version").over(following)).where(
        F.col("_from").isNotNull()
    )
    new = pairs.join(schemas, ["subject", "version"]).select(
        "subject",
        F.col("version"),
        F.coalesce("alias_of", "field").alias("_match"),
        F.col("field").alias("new_field"),
        F.col("type").alias("new_type"),
        F.col("required").alias("new_required"),
        _split("symbols").alias("new_symbols"),
    )
    old = pairs.join(
        schemas.withColumnRenamed("version", "_from"), ["subject", "_from"]
    ).select(
        "subject",
        "version",
        F.col("field").alias("_match"),
        F.col("field").alias("old_field"),
        F.col("type").alias("old_type"),
        F.col("required").alias("old_required"),
        _split("symbols").alias("old_symbols"),
    )
    both = new.join(old, ["subject", "version", "_match"], "full")
    added, removed = F.col("old_field").isNull(), F.col("new_field").isNull()
    kept = ~added & ~removed
    enum = (F.size("new_symbols") > 0) & (F.size("old_symbols") > 0)
    found = F.array(
        F.when(added & ~F.col("new_required"), "add optional field"),
        F.when(added & F.col("new_required"), "add required field"),
        F.when(removed & ~F.col("old_required"), "remove optional field"),
        F.when(removed & F.col("old_required"), "remove required field"),
        F.when(kept & (F.col("new_field") != F.col("old_field")), "rename field"),
        F.when(kept & (F.col("new_type") != F.col("old_type")), "change field type"),
        F.when(kept & enum & (F.size(F.array_except("new_symbols", "old_symbols")) > 0), "add enum symbol"),
        F.when(kept & enum & (F.size(F.array_except("old_symbols", "new_symbols")) > 0), "remove enum symbol"),
    )
    return both.select(
        "subject",
        "version",
        F.coalesce("new_field", "old_field").alias("field"),
        F.explode(F.array_compact(found)).alias("change"),
    )


def compatibility_report(
    schemas: DataFrame, rules: list[tuple[str, bool, bool, bool, bool]] | None = None
) -> DataFrame:
    """Every change with its verdict in each compatibility mode."""
    spark = schemas.sparkSession
    table = spark.createDataFrame(
        rules or COMPATIBILITY_RULES,
        "change STRING, " + ", ".join(f"{m} BOOLEAN" for m in MODES),
    )
    return schema_changes(schemas).join(table, "change")
