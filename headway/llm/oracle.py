"""DuckDB SQL giving the rows of corpus queries."""

from __future__ import annotations


def _crc32(text: str) -> str:
    """Unsigned CRC-32 of an ASCII text."""
    step = "CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END"
    byte = f"list_reduce(list_prepend(xor(a, b), [0::BIGINT for i in range(8)]), lambda c, z: {step})"
    codes = f"[ascii(x)::BIGINT for x in string_split({text}, '')]"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {codes}), lambda a, b: {byte}), 4294967295)"


def _levels(name: str, leaves: str, levels: int) -> str:
    """Trees of 16 children over ``leaves`` (tree, place, digest): one table per level."""
    parts = [f"{name}0 AS MATERIALIZED ({leaves})"]
    for level in range(levels):
        parts.append(
            f"{name}{level + 1} AS MATERIALIZED (SELECT tree, place // 16 AS place, "
            f"sha256(string_agg(digest, '' ORDER BY place)) AS digest FROM {name}{level} "
            f"WHERE tree IN (SELECT tree FROM {name}{level} GROUP BY tree HAVING count(*) > 1) "
            "GROUP BY tree, place // 16)"
        )
    return ",\n".join(parts)


def _top(name: str, levels: int) -> str:
    """The one node on the highest level of each tree."""
    rows = [
        f"SELECT tree, {level} AS level, min(digest) AS digest FROM {name}{level} GROUP BY tree HAVING count(*) = 1"
        for level in range(levels + 1)
    ]
    return "SELECT tree, arg_max(digest, -level) AS digest FROM (" + " UNION ALL ".join(rows) + ") GROUP BY tree"


def _beside(name: str, level: int) -> str:
    """Siblings of each node joined, those before and those after it; none beside a root."""
    run = f"(PARTITION BY tree, place // 16 ORDER BY place ROWS BETWEEN"
    return (
        f"{name}b{level} AS MATERIALIZED (SELECT tree, place, "
        f"coalesce(string_agg(digest, '') OVER {run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS before, "
        f"coalesce(string_agg(digest, '') OVER {run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS after "
        f"FROM {name}{level} WHERE tree IN (SELECT tree FROM {name}{level} GROUP BY tree HAVING count(*) > 1))"
    )


def merkle(tree_levels: int = 5, last_levels: int = 3) -> str:
    """Proofs of all documents, for up to 16 ** 5 rows per source and 16 ** 3 sources."""
    fields = ["doc_id::VARCHAR", "source", "lang", "n_chars::VARCHAR", "text"]

    def leaf(values: list[str]) -> str:
        texts = [f"coalesce(strlen({v}) || ':' || {v}, '-')" for v in values]
        return "sha256(" + " || ".join(texts) + ")"

    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    altered = leaf([*fields[:-1], lower])
    steps, folds, joins = [], "coalesce(d.altered, d.digest)", []
    proof = []
    for name, levels, tree, place in (("s", tree_levels, "d.tree", "d.place"), ("r", last_levels, "0", "d.tree")):
        for level in range(levels):
            steps.append(_beside(name, level))
            b = f"{name}j{level}"
            joins.append(f"LEFT JOIN {name}b{level} {b} ON {b}.tree = {tree} AND {b}.place = {place} // {16 ** level}")
            proof.append(f"coalesce({b}.before || {b}.after, '')")
            folds = f"CASE WHEN {b}.before IS NULL THEN {folds} ELSE sha256({b}.before || {folds} || {b}.after) END"
    return f"""
WITH docs AS MATERIALIZED (
  SELECT doc_id, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree, {leaf(fields)} AS digest,
    CASE WHEN {_crc32("doc_id::VARCHAR")} % 5 = 0 THEN {altered} END AS altered
  FROM documents),
d AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, digest) - 1 AS place FROM docs),
{_levels("s", "SELECT tree, place, digest FROM d", tree_levels)},
subroots AS MATERIALIZED ({_top("s", tree_levels)}),
{_levels("r", "SELECT 0 AS tree, tree AS place, digest FROM subroots", last_levels)},
root AS MATERIALIZED ({_top("r", last_levels)}),
{", ".join(steps)},
proven AS (
  SELECT d.doc_id, d.digest AS leaf, subroots.digest AS subroot, root.digest AS root,
    sha256({" || ".join(proof)}) AS proof_sha256, {folds} AS folded_root
  FROM d JOIN subroots ON subroots.tree = d.tree CROSS JOIN root
  {" ".join(joins)})
SELECT *, folded_root = root AS verified FROM proven"""


MERKLE = merkle()

# All anchors with all rows: for small tables only.
HARD_NEGATIVES = """
WITH rows AS MATERIALIZED (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    [floor(256 * x::DOUBLE) for x in embedding] AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS MATERIALIZED (
  SELECT a.vec_id AS anchor_id, r.vec_id, r.label = a.label AS same,
    list_dot_product(a.v, r.v)::BIGINT AS score
  FROM rows a JOIN rows r ON a.vec_id % 50 = 0 AND r.vec_id <> a.vec_id),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, vec_id AS negative_id, positive_score, score AS negative_score,
  (row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id))::INTEGER AS rank
FROM positives JOIN scored USING (anchor_id)
WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3"""

# All windows of all texts: for small tables only.
REPEATS = """
WITH texts AS MATERIALIZED (
  SELECT row_number() OVER () AS id, doc_id, encode(coalesce(text, '')) AS bytes FROM documents),
windows AS MATERIALIZED (
  SELECT id, pos, md5(bytes[pos + 1:pos + 200]) AS content
  FROM texts, unnest(range(octet_length(bytes) - 199)) AS u(pos)),
repeated AS MATERIALIZED (
  SELECT id, pos FROM windows SEMI JOIN (SELECT content FROM windows GROUP BY content HAVING count(*) > 1) USING (content)),
marked AS (
  SELECT id, pos, coalesce(pos > lag(pos) OVER w + 200, true)::INT AS new FROM repeated WINDOW w AS (PARTITION BY id ORDER BY pos)),
counted AS (SELECT id, pos, sum(new) OVER (PARTITION BY id ORDER BY pos) AS span FROM marked),
spans AS MATERIALIZED (SELECT id, min(pos) AS start, max(pos) + 200 AS past FROM counted GROUP BY id, span),
kept AS (
  SELECT id, coalesce(lag(past) OVER (PARTITION BY id ORDER BY start), 0) AS a, start AS b FROM spans
  UNION ALL SELECT id, coalesce((SELECT max(past) FROM spans WHERE spans.id = texts.id), 0), octet_length(bytes) FROM texts),
joined AS (
  SELECT id, string_agg(hex(bytes[a + 1:b]), '' ORDER BY a) AS rest FROM kept JOIN texts USING (id) GROUP BY id)
SELECT doc_id, octet_length(bytes) AS n_bytes, octet_length(bytes) - length(rest) // 2 AS n_removed,
  (SELECT count(*) FROM spans WHERE spans.id = texts.id) AS n_spans, sha256(unhex(rest)) AS kept_sha256
FROM texts JOIN joined USING (id)"""
