"""Structured data in native plans against the parse of whole pages."""

from riskloom.operators import html_parse, json_ld
from riskloom.sources.adapters import load

SF = "/root/testdata/sf0.001"
PAGES = [
    '<script type="application/ld+json">[{"@type": ["Book", "Movie"], "name": 1}, {"@type": "Book"}, 5, null, [1]]</script>',
    '<script id="x" TYPE="application/ld+json" data-a>{"@type": "Movie", "name": 1, "description": 1, "image": null, "datePublished": 1, "director": 1, "actor": 1, "genre": 1}</script>',
    '<script type="application/ld+json">{"@type": ["Movie"], "name": 1, "description": 1, "image": null, "datePublished": 1, "director": 1, "actor": 1, "genre": 1}</script>',
    '<script type="application/ld+json">{"@type": "Book"</script><script type=\'application/ld+json\'>{"@type": "Book"}</script>',
    '<script type="application/ld+json">{"name": 1}</script><script type="application/ld+json">{"@type": ""}</script>',
    '<script type="application/ld+json">{"@type": 5}</script><script type="application/ld+json">{"@type": []}</script>',
    '<script type="application/ld+json"></script><script>{"@type": "Movie"}</script><script src="x"></script>',
    '<script type="application/ld+json">{"@type": "AdultEntertainment", "name": "é", "description": {"a": [1]}, "provider": 1}</script>',
    "<p>none</p>",
    "",
    None,
]
FIELDS = ["schema_blocks", "schema_types", "has_schema", "schema_movie_only", *(f"{k}_{c}" for c in html_parse.SCHEMA for k in ("schema", "complete"))]


def both(df, key, html):
    return [sorted(map(tuple, x.select(key, *FIELDS).collect())) for x in (json_ld.schema_metrics(df, key, html), html_parse.parse_pages(df, key, html))]


def test_shapes_by_hand(spark):
    native, parsed = both(spark.createDataFrame(list(enumerate(PAGES)), "k long, html string"), "k", "html")
    assert native == parsed
    assert [r[1] for r in native] == [1, 1, 1, 2, 2, 2, 1, 1, 0, 0, 0] and [r[4] for r in native] == [False, True] + [False] * 9


def test_landed_pages(spark):
    native, parsed = both(load(spark, SF, "structured_pages"), "html_id", "html")
    assert native == parsed and len({r[1:] for r in native}) > 5


def test_plan_has_no_python(spark):
    plan = json_ld.schema_metrics(load(spark, SF, "structured_pages"), "html_id", "html")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
