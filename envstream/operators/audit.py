"""Audits: message contract, value domains, natural keys, presence of data."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from envstream import contracts, rules


# Names that parsed values have, by JSON kind. Decimals without places are integers as well.
_KIND_NAMES = {
    "string": ("STRING",), "integer": ("BIGINT", "DECIMAL0"), "null": ("VOID",),
    "number": ("BIGINT", "DECIMAL0", "DECIMAL", "DOUBLE"),
}


def _kind_name(name: Column) -> Column:
    """Type name of a parsed JSON value with one name each for decimals with and without places."""
    return F.when(name.isNull(), "VOID").when(~name.startswith("DECIMAL"), name).when(
        name.endswith(",0)"), "DECIMAL0").otherwise("DECIMAL")


def contract_violations(raw: DataFrame, kinds: Mapping[str, Sequence[str]],
                        non_empty: Sequence[str] = contracts.NON_EMPTY_FIELDS) -> DataFrame:
    """Adds ``violations``, the sorted broken rules of every raw text; empty when it conforms.

    Rules read ``not_an_object``, ``missing:<field>``, ``unknown:<field>``, ``type:<field>`` and
    ``empty:<field>``. Every text is parsed once, into its fields; each field meets a table of what its
    name allows.
    """
    known = F.array(*[F.lit(name) for name in kinds])
    allowed = [f"{name}:{n}" for name, some in kinds.items() for kind in some for n in _KIND_NAMES[kind]]

    def typed(field: Column) -> Column:
        # Kept with the field, so that the rules find the type once.
        return F.struct(field["key"].alias("key"), field["value"].alias("value"),
                        F.schema_of_variant(field["value"]).alias("type"))

    def rules_of(field: Column) -> Column:
        name = field["key"]
        empty = name.isin(list(non_empty)) & (F.try_variant_get(field["value"], "$", "string") == "")
        broken = F.when(~name.isin(list(kinds)), "unknown:").when(
            ~F.concat(name, F.lit(":"), _kind_name(field["type"])).isin(allowed), "type:").when(
            empty & (field["type"] == "STRING"), "empty:")
        return F.concat(broken, name)

    rows = raw.withColumn("_fields", F.transform(
        F.map_entries(F.from_json("raw_value", "map<string,variant>")), typed))
    missing = F.transform(F.array_except(known, F.transform("_fields", lambda field: field["key"])),
                          lambda name: F.concat(F.lit("missing:"), name))
    broken = F.concat(missing, F.array_compact(F.transform("_fields", rules_of)))
    violations = F.when(F.col("_fields").isNull(), F.array(F.lit("not_an_object"))).otherwise(
        F.sort_array(broken))
    return rows.withColumn("violations", violations).drop("_fields")


def domain_rules(table: str) -> dict[str, Column]:
    """Value rules of a metric table, name to test; a null outcome passes, as in a CHECK."""
    durations = F.col("window_duration").isin(*rules.WINDOW_DURATIONS)
    if table == "air":
        required = contracts.AIR_METRIC_COLUMNS
        tests = {
            "parameter_domain": F.col("parameter").isin(*rules.POLLUTANTS),
            "status_domain": F.col("status").isin(*rules.STATUSES),
            "duration_domain": durations,
        }
    else:
        required = contracts.WEATHER_METRIC_COLUMNS
        low, high = rules.WEATHER_RANGES["humidity_pct"]
        tests = {
            "humidity_range": F.col("avg_humidity").between(low, high),
            "duration_domain": durations,
        }
    return {**{f"{c}_not_null": F.col(c).isNotNull() for c in required}, **tests}


def audit_constraints(rows: DataFrame, tests: Mapping[str, Column]) -> DataFrame:
    """Violations per rule, all counted in one pass."""
    counts = rows.agg(*[
        F.count(F.when(~test, 1)).alias(name) for name, test in tests.items()])
    pairs = ", ".join(f"'{name}', `{name}`" for name in tests)
    return counts.selectExpr(f"stack({len(tests)}, {pairs}) AS (rule, violations)")


def duplicate_keys(rows: DataFrame, key: Sequence[str]) -> DataFrame:
    """Number of natural keys that occur more than once."""
    repeated = rows.groupBy(*key).agg(F.count("*").alias("n")).filter("n > 1")
    return repeated.agg(F.count("*").alias("duplicate_keys"))


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Name, rows and whether there are any, for several tables in one job."""
    parts = [
        rows.agg(F.count("*").alias("rows")).select(F.lit(name).alias("table_name"), "rows")
        for name, rows in tables.items()]
    return reduce(DataFrame.unionByName, parts).withColumn("ok", F.col("rows") > 0)


def layer_presence(spark: SparkSession, root: str,
                   tables: Sequence[contracts.TableContract] = contracts.TABLES) -> DataFrame:
    """Rows per layer; a layer fails when it must hold data and has none, or is not there at all."""
    from envstream.sources import files
    from envstream.sources import tables as scans

    counted = row_counts({
        t.location: scans.read_or_empty(spark, f"{root}/{t.location}", t.schema) for t in tables})
    optional = [t.location for t in tables if t.may_be_empty]
    required = ~F.col("table_name").isin(*optional) if optional else F.lit(True)
    return counted.select(
        F.col("table_name").alias("layer"), "rows", required.alias("required"),
        (F.col("rows") > 0).alias("has_rows"),
        F.col("table_name").isin(*[t.location for t in tables if files.exists(
            spark, f"{root}/{t.location}")]).alias("there"),
    ).withColumn("ok", F.col("there") & (F.col("has_rows") | ~F.col("required"))).drop(
        "has_rows", "there")
