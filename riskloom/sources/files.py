"""Delimited files, landed JSON payloads and exports."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from riskloom.functions import text

SERP_SCHEMA = "struct<results:array<struct<content:struct<results:struct<organic:array<struct<url:string>>>>>>>"
_CERT = """struct<chainHierarchy:string,validationType:string,validFrom:string,validTo:string,serialNumber:string,signatureAlgorithm:string,
 subject:struct<commonName:string>,issuer:struct<country:string,organization:string,commonName:string>,publicKey:struct<type:string,bits:int>,
 extensions:struct<authorityKeyIdentifier:string,subjectKeyIdentifier:string,keyUsage:array<string>,extendedKeyUsage:array<string>,crlDistributionPoints:array<string>,
 authorityInfoAccess:struct<issuers:array<string>,ocsp:array<string>>,subjectAlternativeNames:struct<dnsNames:array<string>>,certificatePolicies:array<string>>>"""
CERT_SCHEMA = f"struct<ip:string,port:int,auditCreated:string,certificates:array<{_CERT}>>"


def read_delimited(spark: SparkSession, path: str, schema: str, sep: str = ";") -> DataFrame:
    return spark.read.schema(schema).csv(path, sep=sep, header=True, encoding="UTF-8")


def read_jdbc(spark: SparkSession, url: str, table: str, column: str, low: int, high: int, parts: int, **options) -> DataFrame:
    """A partitioned scan of a relational table; predicates and columns are pushed down. Names have to be plain identifiers, the table's with a schema or without."""
    table, column = ".".join(map(text.safe_identifier, table.split("."))), text.safe_identifier(column)
    return spark.read.jdbc(url, table, column=column, lowerBound=low, upperBound=high, numPartitions=parts, properties=options)


def export_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).csv(path, header=True)


def export_dated(frames: dict[str, DataFrame], folder: str, day: datetime.date) -> dict[str, str]:
    """A folder of CSV for each query, named after it and the day; their paths."""
    paths = {name: f"{folder}/{name}_{day:%Y%m%d}" for name in frames}
    for name, df in frames.items():
        export_csv(df, paths[name])
    return paths


def export_open(df: DataFrame, folder: str, day: datetime.date) -> str:
    """Cleaned domains by the feature that is still open (columns feature, clean_domain), in one job: a folder of CSV for each feature below one of the day; its path."""
    path = f"{folder}/clean_{day:%Y-%m-%d}"
    df.select("feature", "clean_domain").repartition("feature", "clean_domain").write.mode("overwrite").partitionBy("feature").csv(path, header=True)
    return path


def append_csv(df: DataFrame, path: str, sep: str = ";") -> None:
    """Adds rows to a folder of CSV whose every part has the header, so that readers skip it in each and an empty folder gets one."""
    df.write.mode("append").csv(path, header=True, sep=sep)


def append_new(df: DataFrame, known: DataFrame, key: str, path: str) -> None:
    """Appends a row for each key that isn't known yet."""
    df.dropDuplicates([key]).join(known.select(key), key, "left_anti").write.mode("append").parquet(path)


def serp_first_page(payload: Column) -> Column:
    """How many organic results the first page has; null where the payload is no such JSON."""
    n = F.size(F.get(F.from_json(payload, SERP_SCHEMA)["results"], F.lit(0))["content"]["results"]["organic"])
    return F.when(n >= 0, n)


def serp_job(status: Column, payload: Column) -> Column:
    """How many organic results an asynchronous search returned with its first page; null while it runs or where its answer is broken."""
    n = F.size(F.get(F.from_json(payload, "array<struct<organic:array<struct<url:string>>>>"), F.lit(0))["organic"])
    return F.when((status == "ready") & (n >= 0), n)


def serp_hosts(df: DataFrame) -> DataFrame:
    """(domain, n_urls, n_hosts): result URLs whose host contains the domain; 0 where the payload is no JSON."""
    p = df.select("domain", F.from_json("payload", SERP_SCHEMA).alias("p"))
    urls = p.select("domain", F.explode_outer("p.results").alias("r")).select("domain", F.explode_outer("r.content.results.organic").alias("o")).select("domain", F.regexp_extract("o.url", "https?://([^/]+)", 1).alias("host"))
    hit = F.contains("host", F.lower("domain"))
    return urls.groupBy("domain").agg(F.count_if(hit).alias("n_urls"), F.count_distinct(F.when(hit, F.col("host"))).alias("n_hosts"))


def certificates(df: DataFrame) -> DataFrame:
    """A row per certificate of a landed payload, or one row of nulls where it has none; lists leave as JSON text."""
    p = df.select(F.col("domain").alias("requested_domain"), F.from_json("payload", CERT_SCHEMA).alias("p"))
    some = F.size("p.certificates") > 0
    c = p.select("requested_domain", F.when(some, F.col("p.ip")).alias("ip"), F.when(some, F.col("p.port")).alias("port"), F.when(some, text.parse_timestamp(F.col("p.auditCreated"))).alias("audit_created"), F.explode_outer("p.certificates").alias("c"))
    at: Column = F.col("c")
    ext = at["extensions"]
    listed = lambda x: F.when(ext.isNotNull(), F.coalesce(F.to_json(x), F.lit("")))
    return c.select(
        "requested_domain", "ip", "port", "audit_created",
        at["chainHierarchy"].alias("chain_hierarchy"), at["validationType"].alias("validation_type"), text.parse_timestamp(at["validFrom"]).alias("valid_from"), text.parse_timestamp(at["validTo"]).alias("valid_to"),
        at["serialNumber"].alias("serial_number"), at["signatureAlgorithm"].alias("signature_algorithm"), at["subject"]["commonName"].alias("subject_common_name"),
        at["issuer"]["country"].alias("issuer_country"), at["issuer"]["organization"].alias("issuer_organization"), at["issuer"]["commonName"].alias("issuer_common_name"),
        ext["authorityKeyIdentifier"].alias("authority_key_identifier"), ext["subjectKeyIdentifier"].alias("subject_key_identifier"),
        listed(ext["keyUsage"]).alias("key_usage"), listed(ext["extendedKeyUsage"]).alias("extended_key_usage"), listed(ext["crlDistributionPoints"]).alias("crl_distribution_points"),
        listed(ext["authorityInfoAccess"]["issuers"]).alias("aia_issuers"), listed(ext["authorityInfoAccess"]["ocsp"]).alias("aia_ocsp"),
        listed(ext["subjectAlternativeNames"]["dnsNames"]).alias("dns_names"), listed(ext["certificatePolicies"]).alias("certificate_policies"),
        at["publicKey"]["type"].alias("public_key_type"), at["publicKey"]["bits"].alias("public_key_bits"),
    )
