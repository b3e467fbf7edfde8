import datetime
import itertools

from riskloom.sources import files
from riskloom.sources.adapters import load


def test_delimited(spark, tmp_path):
    (tmp_path / "c.csv").write_text("name;code\nEspaña;ES\n;FR\n", encoding="utf-8")
    got = files.read_delimited(spark, str(tmp_path / "c.csv"), "name string, code string").collect()
    assert [tuple(r) for r in got] == [("España", "ES"), (None, "FR")]


def test_export_and_append(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string")
    files.export_csv(df, str(tmp_path / "out"))
    assert spark.read.csv(str(tmp_path / "out"), header=True).count() == 2
    path = str(tmp_path / "rows")
    df.write.parquet(path)
    files.append_new(spark.createDataFrame([(2, "b"), (3, "c")], "k long, v string"), spark.read.parquet(path), "k", path)
    assert sorted(r["k"] for r in spark.read.parquet(path).collect()) == [1, 2, 3]


def test_certificates(spark):
    two = """{"ip": "1.1.1.1", "port": 443, "auditCreated": "2025-01-01T00:00:00Z", "certificates": [{"validationType": "domain", "validFrom": "2024-01-01T00:00:00Z", "publicKey": {"type": "RSA", "bits": 2048},
      "extensions": {"keyUsage": ["a", "b"], "subjectAlternativeNames": {"dnsNames": ["*.x"]}}}, {"issuer": {"organization": "X"}}]}"""
    df = spark.createDataFrame([("a", two), ("b", "{}"), ("c", "no json"), ("d", None), ("e", '{"ip": "9.9.9.9", "certificates": []}')], "domain string, payload string")
    got = files.certificates(df).collect()
    assert sorted(r["requested_domain"] for r in got) == ["a", "a", "b", "c", "d", "e"]
    assert {r["valid_from"].year for r in got if r["valid_from"]} == {2024}
    full, bare = sorted((r for r in got if r["requested_domain"] == "a"), key=lambda r: r["validation_type"] is None)
    assert (full["key_usage"], full["dns_names"], full["aia_ocsp"], full["public_key_bits"], full["port"]) == ('["a","b"]', '["*.x"]', "", 2048, 443)
    assert (bare["key_usage"], bare["issuer_organization"], bare["audit_created"].year) == (None, "X", 2025)
    assert all(v is None for r in got if r["requested_domain"] in "bcde" for v in tuple(r)[1:])


def test_exports(spark, tmp_path):
    df = spark.createDataFrame([("a.com", 2), ("b.org", 1), ("c.ru", 4), ("d.de", 5)], "domain string, first_seen int")
    paths = files.export_dated({"clean": df}, str(tmp_path), datetime.date(2025, 3, 4))
    assert paths == {"clean": f"{tmp_path}/clean_20250304"} and spark.read.csv(paths["clean"], header=True).count() == 4
    for _ in range(2):
        files.append_csv(df, str(tmp_path / "log"))
    back = spark.read.csv(str(tmp_path / "log"), header=True, sep=";")
    assert back.columns == ["domain", "first_seen"] and back.count() == 8
    parts = spark.createDataFrame([("ssl_poor", "a.com"), ("ssl_poor", "b.org"), ("high_traffic", "a.com")], "feature string, clean_domain string")
    path = files.export_open(parts, str(tmp_path), datetime.date(2025, 3, 4))
    assert path.endswith("/clean_2025-03-04")
    assert sorted(map(tuple, spark.read.csv(path, header=True).select("feature", "clean_domain").collect())) == sorted(map(tuple, parts.collect()))
    assert [r[0] for r in spark.read.csv(f"{path}/feature=high_traffic", header=True).collect()] == ["a.com"]


def test_serp(spark):
    page = '{"results": [{"content": {"results": {"organic": [{"url": "https://www.a.com/x"}, {"url": "https://b.com"}]}}}, {"content": null}]}'
    df = spark.createDataFrame([("a.com", page), ("b.org", page), ("c.com", "x")], "domain string, payload string")
    assert {r["domain"]: (r["n_urls"], r["n_hosts"]) for r in files.serp_hosts(df).collect()} == {"a.com": (1, 1), "b.org": (0, 0), "c.com": (0, 0)}


def test_traffic_of_any_order_of_rows(spark, tmp_path):
    """Three prices whose sum of doubles misses a quarter in one order and not in another."""
    prices = (291338.44, 361704.98, 106962.83)
    for k, p in enumerate(itertools.permutations(prices)):
        rows = [(2 * n, 5, x, datetime.datetime(1996, 3, 1 + n)) for n, x in enumerate(p)]
        path = str(tmp_path / f"{k}" / "orders.parquet")
        spark.createDataFrame(rows, "o_orderkey long, o_custkey long, o_totalprice double, o_orderdate timestamp").coalesce(1).write.parquet(path)
        assert [r["traffic"] for r in load(spark, str(tmp_path / f"{k}"), "dim_traffic").collect()] == [round(sum(round(100 * x) for x in prices)) * 4 // 100]
