"""Structured data of pages (JSON-LD) in native plans, over the VARIANT type.

A block is an object or a list of objects, and an object's type a name or a list of names; a variant is asked for
the list first and stands alone where it is none. What is no JSON, an entry that is no object and one without a type tell nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from riskloom.operators.html_parse import SCHEMA

BLOCK = r"(?is)<script\b[^>]*\btype\s*=\s*(?:\"application/ld\+json\"|'application/ld\+json'|application/ld\+json(?=[\s>]))[^>]*>(.*?)</script\s*>"
#: Tenths of a category's properties that a complete entry has.
COMPLETE = 8


def blocks(html: Column) -> Column:
    """The texts of a page's blocks."""
    return F.regexp_extract_all(F.coalesce(html, F.lit("")), F.lit(BLOCK), F.lit(1))


def entries(block: Column) -> Column:
    """The entries of a block's text as variants: those of a list, or the one that it is; null for what is no JSON."""
    v = F.try_parse_json(block)
    return F.coalesce(F.try_variant_get(v, "$", "array<variant>"), F.when(v.isNotNull(), F.array(v)))


def types(entry: Column) -> Column:
    """The type names of an entry: a list's, or the one that it has."""
    path = '$["@type"]'
    return F.coalesce(F.try_variant_get(entry, path, "array<string>"), F.array(F.try_variant_get(entry, path, "string")))


def structured(df: DataFrame, key: str, html: str) -> DataFrame:
    """(key, type, single, properties) for each type of each entry of each page's blocks; single says whether the entry has one type that isn't a list."""
    x = df.select(key, F.explode(blocks(F.col(html))).alias("__block")).select(key, F.explode(entries(F.col("__block"))).alias("__entry"))
    x = x.withColumn("properties", F.map_keys(F.try_variant_get("__entry", "$", "map<string,variant>"))).filter("properties IS NOT NULL")
    single = F.try_variant_get("__entry", '$["@type"]', "array<string>").isNull()
    x = x.select(key, "properties", single.alias("single"), F.explode(types(F.col("__entry"))).alias("type"))
    return x.filter("type <> '' AND NOT (single AND type IN ('false', '0'))").select(key, "type", "single", "properties")


def schema_metrics(df: DataFrame, key: str, html: str) -> DataFrame:
    """A row for each page: schema_blocks, schema_types, has_schema, entries by category, complete ones, and whether a film entry of that one type is complete.

    One row for each value of key, which has to be a key of df. Pages never leave their row but as the names of their entries' properties.
    """
    known = structured(df, key, html)

    def share(wanted: set[str]) -> Column:
        names = sorted(wanted)
        return 10 * F.size(F.array_intersect("properties", F.array(*map(F.lit, names)))) >= COMPLETE * len(names)

    of = {c: F.col("type").isin(sorted(members)) for c, (members, _) in SCHEMA.items()}
    full = {c: of[c] & share(wanted) for c, (_, wanted) in SCHEMA.items()}
    counts = known.groupBy(key).agg(
        F.count_distinct("type").alias("schema_types"),
        *[F.count_if(of[c]).alias(f"schema_{c}") for c in SCHEMA],
        *[F.bool_or(full[c]).alias(f"complete_{c}") for c in SCHEMA],
        F.bool_or(full["movie"] & F.col("single")).alias("schema_movie_only"),
    )
    x = df.select(key, F.size(blocks(F.col(html))).cast("long").alias("schema_blocks")).join(counts, key, "left")
    filled = x.na.fill(0).na.fill(False)
    return filled.withColumn("has_schema", F.col("schema_types") > 0)
