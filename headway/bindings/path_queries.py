"""Queries on JSON documents of unlike shape."""

from __future__ import annotations

from headway.bindings.registry import query
from headway.sources import paths as P

# A document per customer, read by Spark and by DuckDB; some are no JSON.
_DOCUMENTS = """
    SELECT c_custkey AS id, CASE c_mktsegment
        WHEN 'BUILDING' THEN '{"name": "' || c_name || '", "fares": [{"zone": 1, "price": 2.5}, {"zone": '
            || CAST(c_custkey AS STRING) || '}]}'
        WHEN 'AUTOMOBILE' THEN '{"name": "' || c_name || '", "fares": "none", "tags": [], "more": {}}'
        WHEN 'MACHINERY' THEN '{"name": {"first": "M", "number": ' || CAST(c_custkey AS STRING) || '}, "fares": null}'
        WHEN 'HOUSEHOLD' THEN '[' || CAST(c_custkey AS STRING) || ', [true, {"deep": {"er": "x y"}}]]'
        ELSE CASE WHEN c_custkey % 2 = 0 THEN '{"name":' ELSE '"text"' END END AS text
    FROM customer"""
_PATHS = {
    "name": ("$.name", "string"),
    "number": ("$.name.number", "bigint"),
    "price": ("$.fares[0].price", "double"),
    "zone": ("$.fares[1].zone", "int"),
    "first": ("$[0]", "bigint"),
    "deep": ("$[1][1].deep.er", "string"),
    "fares": ("$.fares", "int"),
}


def _documents(b):
    sql = _DOCUMENTS.replace("{", "{{").replace("}", "}}").replace("FROM customer", "FROM {customer}")
    rows = b.spark.sql(sql, customer=b.raw("customer"))
    return P.parse_documents(rows, "text")


# What stands at the paths of each shape.
_LEAVES = {
    "BUILDING": [("$.name", "string", 1), ("$.fares[*].zone", "number", 2), ("$.fares[*].price", "number", 1)],
    "AUTOMOBILE": [("$.name", "string", 1), ("$.fares", "string", 1), ("$.tags", "array", 1), ("$.more", "object", 1)],
    "MACHINERY": [("$.name.first", "string", 1), ("$.name.number", "number", 1), ("$.fares", "null", 1)],
    "HOUSEHOLD": [("$[*]", "number", 1), ("$[*][*]", "boolean", 1), ("$[*][*].deep.er", "string", 1)],
}
_OTHERS = "c_mktsegment NOT IN (" + ", ".join(f"'{s}'" for s in _LEAVES) + ") AND c_custkey % 2 <> 0"


@query(
    "document_paths",
    "SELECT path, kind, count(DISTINCT c_custkey) AS documents, CAST(sum(n) AS BIGINT) AS n FROM ("
    + " UNION ALL ".join(
        f"SELECT '{path}' AS path, '{kind}' AS kind, c_custkey, {n} AS n FROM customer WHERE c_mktsegment = '{segment}'"
        for segment, found in _LEAVES.items() for path, kind, n in found
    )
    + f" UNION ALL SELECT '$', 'string', c_custkey, 1 FROM customer WHERE {_OTHERS}) GROUP BY 1, 2",
)
def _(b):
    return P.path_report(P.leaves(_documents(b), "id"), "id")


@query(
    "document_values",
    """
    SELECT c_custkey AS id,
           CASE WHEN c_mktsegment IN ('BUILDING', 'AUTOMOBILE') THEN c_name
                WHEN c_mktsegment = 'MACHINERY' THEN '{"first":"M","number":' || c_custkey || '}' END AS name,
           CASE WHEN c_mktsegment = 'MACHINERY' THEN c_custkey END AS number,
           CASE WHEN c_mktsegment = 'BUILDING' THEN 2.5 END AS price,
           CASE WHEN c_mktsegment = 'BUILDING' THEN c_custkey END AS zone,
           CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN c_custkey END AS first,
           CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN 'x y' END AS deep,
           CAST(NULL AS INT) AS fares
    FROM customer""",
)
def _(b):
    scalars = P.values_at(_documents(b), _PATHS)
    return scalars.select("id", *_PATHS)
