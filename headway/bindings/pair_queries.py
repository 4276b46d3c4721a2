"""Queries on functions, question/answer pairs, benchmark items and scores."""

from __future__ import annotations

import uuid
from dataclasses import replace

from pyspark.sql import functions as F

from headway.bindings import oracle as O
from headway.bindings.oracle import with_stats, with_views
from headway.bindings.registry import query
from headway.bindings.table_queries import _ONE, _PAIRED, _PICKED, text
from headway.functions import scalars as A
from headway.functions import texts as X
from headway.operators import pairs as P
from headway.operators import ranking as R
from headway.operators import scoring as S
from headway.plans import benchmark_items as B
from headway.plans import question_pairs as Q
from headway.plans import templates as T
from headway.plans.score_runs import compare_runs, score_benchmark
from headway.plans.validate_pairs import distribution_check, validate_pairs
from headway.schema import PAIR_FIELDS
from headway.session import kept, shared_folder
from headway.sources import documents as J

# --- functions ----------------------------------------------------------------------


@query(
    "route_type_names",
    with_views(f"""
        SELECT route_id, {O.mode('route_type')} AS long,
               {O.coded('route_type', O.ROUTE_TYPES_SHORT, "'type ' || route_type")} AS short
        FROM routes"""),
)
def _(b):
    c = F.col("route_type")
    return b.routes.select(
        "route_id",
        A.route_type_name(c).alias("long"),
        A.route_type_name(c, A.ROUTE_TYPES_SHORT, "type {code}").alias("short"),
    )


@query(
    "transfer_type_names",
    with_views(f"""
        SELECT feed_id, from_stop_id, to_stop_id,
               CASE WHEN transfer_type IS NULL THEN 'a transfer'
                    ELSE {O.coded('transfer_type', O.TRANSFER_TYPES, "'a standard transfer'")}
               END AS kind
        FROM transfers"""),
)
def _(b):
    return b.transfers.select(
        "feed_id", "from_stop_id", "to_stop_id",
        A.transfer_type_name(F.col("transfer_type")).alias("kind"),
    )


@query(
    "times_of_day",
    with_views(f"""
        SELECT departure_time, stop_id, {O.clock('departure_time')} AS shown,
               {O.clock('departure_time', ' (+1)')} AS short,
               {O.minutes('departure_time')} AS minutes,
               {O.minutes('departure_time')} * 60
                   + TRY_CAST(split_part(departure_time, ':', 3) AS INT) AS seconds
        FROM stop_times"""),
)
def _(b):
    c = F.col("departure_time")
    return b.stop_times.select(
        c, "stop_id",
        A.format_gtfs_time(c).alias("shown"),
        A.format_gtfs_time(c, A.NEXT_DAY_SHORT).alias("short"),
        A.gtfs_minutes(c).alias("minutes"),
        A.gtfs_seconds(c).alias("seconds"),
    )


_SPAN = f"({O.minutes('last_departure')} - {O.minutes('first_departure')})"
_HEADWAY = f"CASE WHEN {_SPAN} > 0 AND trip_count > 1 THEN {_SPAN} / trip_count END"


@query(
    "avg_headway",
    with_stats(f"SELECT route_id, round({_HEADWAY}, 6) AS headway FROM route_stats"),
)
def _(b):
    headway = A.avg_headway(F.col("first_departure"), F.col("last_departure"), F.col("trip_count"))
    return b.summary.route_stats.select("route_id", F.round(headway, 6).alias("headway"))


@query(
    "safe_int",
    with_views("""
        SELECT route_id, route_sort_order,
               CAST(trunc(TRY_CAST(trim(route_sort_order) AS DOUBLE)) AS BIGINT) AS whole
        FROM raw_routes"""),
)
def _(b):
    return b.raw_routes.select(
        "route_id", "route_sort_order", A.safe_int(F.col("route_sort_order")).alias("whole")
    )


@query("modes_text", with_stats("SELECT feed_id, modes_text AS text FROM feed_stats"))
def _(b):
    return b.summary.feed_stats.select("feed_id", A.modes_text(F.col("by_type")).alias("text"))


@query(
    "formatted_numbers",
    with_views(f"""
        SELECT doc_id, {O.thousands('n_chars * 12345')} AS thousands,
               format('{{:.4f}}', n_chars / 8) AS fixed FROM documents"""),
)
def _(b):
    return b.raw("documents").select(
        "doc_id",
        A.thousands(F.col("n_chars") * 12345).alias("thousands"),
        A.fixed(F.col("n_chars") / 8, 4).alias("fixed"),
    )


@query(
    "route_names",
    with_views("""
        SELECT route_id, coalesce(nullif(route_short_name, ''), nullif(route_long_name, ''))
                   AS name,
               CASE WHEN route_short_name <> '' AND route_long_name <> ''
                    THEN route_short_name || ' (' || route_long_name || ')'
                    ELSE coalesce(route_short_name, route_long_name) END AS full_name
        FROM routes"""),
)
def _(b):
    names = F.col("route_short_name"), F.col("route_long_name")
    return b.routes.select(
        "route_id", A.display_name(*names).alias("name"), A.full_name(*names).alias("full_name")
    )


@query(
    "content_sha256", "SELECT doc_id, sha256(text) AS sha256 FROM documents"
)
def _(b):
    return b.raw("documents").select(
        "doc_id", A.content_sha256(F.col("text").cast("binary")).alias("sha256")
    )


@query(
    "clipped_texts",
    "SELECT doc_id, substr(text, 1, 100) AS sample FROM documents",
)
def _(b):
    return b.raw("documents").select("doc_id", A.clip(F.col("text"), 100).alias("sample"))


@query(
    "token_count",
    """SELECT doc_id, len(list_filter(string_split_regex(text, '\\s+'), lambda w: w <> ''))
           AS words FROM documents""",
)
def _(b):
    return b.raw("documents").select("doc_id", X.token_count(F.col("text")).alias("words"))


_ASCII_NUMBER = "\\d[\\d,]*\\.?\\d*\\b"


@query(
    "render_chat",
    with_views("""
        SELECT record, '<|im_start|>system' || chr(10) || 'You answer.<|im_end|>' || chr(10)
               || '<|im_start|>user' || chr(10) || instruction || '<|im_end|>' || chr(10)
               || '<|im_start|>assistant' || chr(10) || response || '<|im_end|>' || chr(10)
               AS text
        FROM pairs"""),
)
def _(b):
    return b.pairs.select(
        "record",
        X.render_chat(F.lit("You answer."), F.col("instruction"), F.col("response")).alias("text"),
    )


# answers as views: expected text, criteria and a predicted answer per route
_ANSWERS = {
    "told": f"""
        SELECT s.*, provider, CASE WHEN route_type IS NULL THEN 'transit'
            ELSE {O.mode('route_type')} END AS mode
        FROM route_stats s JOIN feeds USING (feed_id)""",
    "answers": """
        SELECT feed_id || '-' || route_id AS id,
               'Describe route ' || route_id || ' operated by ' || provider || '.' AS question,
               'Route ' || route_id || ' is a ' || mode || ' service by ' || provider
                   || ' with approximately ' || trip_count || ' trips serving ' || stop_count
                   || ' stops.' AS expected_answer,
               CASE trip_count % 3
                   WHEN 0 THEN 'Must mention at least 2 of: ' || mode || ' service, trip count ('
                       || trip_count || '), ' || provider || ' and stops'
                   WHEN 1 THEN 'Must state: ' || trip_count || ' trips, ' || mode
                       || ' or (transit) and ' || stop_count || ' stops'
                   ELSE '' END AS scoring_criteria,
               CASE WHEN trip_count < 8 THEN 'easy' WHEN trip_count < 12 THEN 'medium' END
                   AS difficulty,
               mode AS category,
               CASE WHEN trip_count = 0 THEN '' ELSE 'Route ' || route_id || ' by ' || provider
                   || ' runs ' || trip_count || ' trips. Service starts at '
                   || coalesce(first_departure, '') || ' and ends at '
                   || coalesce(last_departure, '') || '.' END AS generated
        FROM told""",
}


def _numbers(c: str) -> str:
    return (
        f"list_distinct(regexp_extract_all(replace({c}, ',', ''),"
        " '(\\b\\d[\\d,]*\\.?\\d*\\b)', 1))"
    )


@query(
    "numbers_in",
    with_stats(
        f"""SELECT id, array_to_string(list_sort({_numbers('expected_answer')}), '|') AS expected,
                   array_to_string(list_sort({_numbers('generated')}), '|') AS generated
            FROM answers""",
        **_ANSWERS,
    ),
)
def _(b):
    def shown(c):
        return F.array_join(F.array_sort(X.numbers_in(F.col(c))), "|")

    return b.answers.select(
        "id", shown("expected_answer").alias("expected"), shown("generated").alias("generated")
    )


@query(
    "numbers_in_documents",
    f"""SELECT doc_id, array_to_string(list_sort({_numbers('text')}), '|') AS numbers
        FROM documents""",
)
def _(b):
    return b.raw("documents").select(
        "doc_id",
        F.array_join(F.array_sort(X.numbers_in(F.col("text"))), "|").alias("numbers"),
    )


_KEYWORD = f"""CASE WHEN len({_numbers('expected_answer')}) = 0 THEN 1.0 ELSE
    len(list_intersect({_numbers('expected_answer')}, {_numbers('generated')}))
    / len({_numbers('expected_answer')}) END"""


@query(
    "keyword_match",
    with_stats(f"SELECT id, round({_KEYWORD}, 9) AS score FROM answers", **_ANSWERS),
)
def _(b):
    score = X.keyword_match(F.col("expected_answer"), F.col("generated"))
    return b.answers.select("id", F.round(score, 9).alias("score"))


_DEMANDS = f"regexp_replace(scoring_criteria, '^Must\\s+({O.DEMAND_VERBS})\\s*:?\\s*', '', 'i')"
_MINIMUM = f"TRY_CAST(regexp_extract({_DEMANDS}, 'at least (\\d+) of:?\\s*', 1, 'i') AS INT)"
_PHRASES = f"regexp_replace({_DEMANDS}, '^.*?at least (\\d+) of:?\\s*', '', 'is')"
_TERMS = f"""list_transform(list_filter(list_transform(
    string_split_regex({_PHRASES}, ',\\s*|\\s+and\\s+|\\s+or\\s+'), lambda p: trim(p)),
    lambda p: len(p) > 1), lambda p: trim(p, '()'))"""


@query(
    "criteria_terms",
    with_stats(
        f"""SELECT id, {_MINIMUM} AS minimum, array_to_string({_TERMS}, '|') AS terms
            FROM answers""",
        **_ANSWERS,
    ),
)
def _(b):
    c = F.col("scoring_criteria")
    return b.answers.select(
        "id", X.criteria_minimum(c).alias("minimum"), X.criteria_terms(c).alias("terms")
    ).withColumn("terms", F.array_join("terms", "|"))


_HITS = f"len(list_filter({_TERMS}, lambda t: contains(lower(generated), lower(t))))"
_CRITERIA = f"""CASE WHEN scoring_criteria = '' OR generated = '' OR len({_TERMS}) = 0 THEN 0.0
    WHEN {_HITS} >= {_MINIMUM} THEN 1.0 WHEN {_MINIMUM} IS NOT NULL THEN {_HITS} / {_MINIMUM}
    ELSE {_HITS} / len({_TERMS}) END"""


@query(
    "criteria_match",
    with_stats(f"SELECT id, round({_CRITERIA}, 9) AS score FROM answers", **_ANSWERS),
)
def _(b):
    score = X.criteria_match(F.col("scoring_criteria"), F.col("generated"))
    return b.answers.select("id", F.round(score, 9).alias("score"))


@query(
    "claimed_counts",
    with_stats(
        """SELECT id,
               TRY_CAST(replace(regexp_extract(expected_answer, '(\\d[\\d,]*)\\s+trips', 1),
                   ',', '') AS BIGINT) AS trips,
               TRY_CAST(replace(regexp_extract(generated, 'runs\\s+(\\d[\\d,]*)\\s+trips', 1),
                   ',', '') AS BIGINT) AS runs
        FROM answers""",
        **_ANSWERS,
    ),
)
def _(b):
    return b.answers.select(
        "id",
        X.claimed_count(F.col("expected_answer"), "trips").alias("trips"),
        X.claimed_count(F.col("generated"), "trips", before="runs").alias("runs"),
    )


# --- pairs ----------------------------------------------------------------------------


@query(
    "union_pairs",
    with_views("""
        SELECT record, category, length(instruction) AS chars FROM pairs
        UNION ALL SELECT record, category, length(instruction) FROM pairs
            WHERE category = 'schedule'"""),
)
def _(b):
    again = b.pairs.where("category = 'schedule'")
    return P.union_pairs(b.pairs, again).select(
        "record", "category", F.length("instruction").alias("chars")
    )


@query(
    "dedupe_instructions",
    with_views("""
        SELECT min(record) AS record, md5(instruction) AS text FROM pairs GROUP BY instruction"""),
)
def _(b):
    return P.dedupe_instructions(b.pairs, ["record"]).select(
        "record", F.md5("instruction").alias("text")
    )


@query(
    "pair_distribution",
    with_views("""
        SELECT 'category' AS dimension, coalesce(category, 'unknown') AS value, count(*) AS n,
               round(count(*) / (SELECT count(*) FROM pairs) * 100, 1) AS percent
        FROM pairs GROUP BY 2
        UNION ALL SELECT 'feed', feed_id, count(*), NULL FROM pairs WHERE feed_id <> ''
            GROUP BY 2
        UNION ALL SELECT 'template', coalesce(template_id, 'unknown'), count(*), NULL FROM pairs
            GROUP BY 2
        UNION ALL SELECT 'all', '', count(*), NULL FROM pairs"""),
)
def _(b):
    return P.pair_distribution(b.pairs)


@query(
    "text_length_stats",
    with_views("""
        SELECT min(length(instruction)) AS instruction_min,
               max(length(instruction)) AS instruction_max,
               round(avg(length(instruction)), 1) AS instruction_avg,
               min(length(response)) AS response_min, max(length(response)) AS response_max,
               round(avg(length(response)), 1) AS response_avg
        FROM pairs"""),
)
def _(b):
    return P.text_length_stats(b.pairs)


@query(
    "category_counts",
    with_views("SELECT category, count(*) AS n FROM pairs GROUP BY 1"),
)
def _(b):
    return P.category_counts(b.pairs)


@query(
    "pairs_with_stats",
    with_stats("""
        SELECT record, feed_id, total_routes, total_stops FROM pairs
        JOIN (SELECT feed_id, total_routes, total_stops FROM feed_stats) USING (feed_id)"""),
)
def _(b):
    stats = b.summary.feed_stats.select("feed_id", "total_routes", "total_stops")
    return P.pairs_with_stats(b.pairs, stats).select(
        "record", "feed_id", "total_routes", "total_stops"
    )


_LINES = """
    SELECT record, CASE record % 4 WHEN 0 THEN 'category' WHEN 1 THEN 'feed_id|provider'
                       WHEN -1 THEN 'instruction' ELSE '' END AS missing FROM pairs"""


def _json_lines(b):
    """The pairs as JSON lines, some of them without all fields."""

    def without(*names):
        kept = F.struct(*[c for c in PAIR_FIELDS if c not in names])
        return F.to_json(kept, {"ignoreNullFields": "false"})

    place = F.col("record") % 4
    return b.pairs.select(
        "record",
        F.when(place == 0, without("category"))
        .when(place == 1, without("feed_id", "provider"))
        .when(place == -1, without("instruction"))
        .otherwise(without())
        .alias("value"),
    )


@query("missing_fields", with_views(_LINES))
def _(b):
    return P.missing_fields(_json_lines(b)).select("record", text("missing"))


@query(
    "check_format",
    with_views(
        """SELECT 'format' AS "check", false AS passed,
                  (SELECT count(*) FROM pairs) AS total_records,
                  (SELECT count(*) FROM lines WHERE missing <> '') AS issues_count,
                  string_agg('Record ' || record || ': missing fields '
                      || replace(missing, '|', ', '), '|' ORDER BY record) AS issues
           FROM (SELECT * FROM lines WHERE missing <> '' ORDER BY record LIMIT 20)""",
        lines=_LINES,
    ),
)
def _(b):
    return P.check_format(_json_lines(b), "record").withColumn("issues", F.array_join("issues", "|"))


_ISSUES = """
    SELECT record, 1 AS place, 'Record ' || record || ': empty response' AS issue
    FROM pairs WHERE trim(response) = ''
    UNION ALL
    SELECT record, 1, 'Record ' || record || ': response too short (' || length(response)
        || ' chars)' FROM pairs WHERE trim(response) <> '' AND length(response) < 20"""


@query("content_issues", with_views(f"SELECT record, issue FROM ({_ISSUES})"))
def _(b):
    return P.content_issues(b.pairs, "record").select("record", "issue")


@query(
    "check_content",
    with_views(
        """SELECT false AS passed, (SELECT count(*) FROM issues) AS issues_count,
                  string_agg(issue, '|' ORDER BY record) AS issues
           FROM (SELECT * FROM issues ORDER BY record LIMIT 20)""",
        issues=_ISSUES,
    ),
)
def _(b):
    return P.check_content(b.pairs, "record").select(
        "passed", "issues_count", F.array_join("issues", "|").alias("issues")
    )


@query(
    "duplicate_samples",
    with_views("""
        SELECT record, substr(instruction, 1, 100) AS sample FROM (
            SELECT *, row_number() OVER (PARTITION BY instruction ORDER BY record) AS rn
            FROM pairs) WHERE rn > 1 ORDER BY record LIMIT 10"""),
)
def _(b):
    return P.duplicate_samples(b.pairs, ["record"])


@query(
    "check_duplicates",
    with_views("""
        SELECT count(*) - count(DISTINCT instruction) AS duplicate_count,
               count(*) = count(DISTINCT instruction) AS passed FROM pairs"""),
)
def _(b):
    return P.check_duplicates(b.pairs, ["record"]).select("duplicate_count", "passed")


_SPLIT = f"""
    SELECT record, coalesce(category, 'unknown') AS stratum,
           row_number() OVER (PARTITION BY coalesce(category, 'unknown')
               ORDER BY {O.seeded("record")}) AS rank,
           count(*) OVER (PARTITION BY coalesce(category, 'unknown')) AS n
    FROM pairs"""
_TRAIN_SIZE = """CASE WHEN floor(n * CAST(0.9 AS DOUBLE)) = n AND n >= 2 THEN n - 1
    ELSE floor(n * CAST(0.9 AS DOUBLE)) END"""


@query(
    "stratified_split",
    with_views(
        f"""SELECT record, CASE WHEN rank <= {_TRAIN_SIZE} THEN 'train' ELSE 'test' END AS split
            FROM ranked""",
        ranked=_SPLIT,
    ),
)
def _(b):
    return R.stratified_split(b.pairs, key=["record"]).select("record", "split")


@query(
    "stratified_split_of_copies",
    with_views(
        f"""SELECT coalesce(stratum, 'unknown') AS category,
                   CAST(sum(train) AS BIGINT) AS train, CAST(sum(n - train) AS BIGINT) AS test
            FROM (SELECT category AS stratum, n, {_TRAIN_SIZE} AS train FROM (
                SELECT coalesce(category, 'unknown') AS category, count(*) AS n FROM pairs
                GROUP BY 1)) GROUP BY 1"""
    ),
)
def _(b):
    # without the record number, copies of a document are equal rows
    split = R.stratified_split(b.pairs.select("instruction", "response", "category"))
    return split.groupBy(F.coalesce("category", F.lit("unknown")).alias("category")).agg(
        F.count_if(F.col("split") == "train").alias("train"),
        F.count_if(F.col("split") == "test").alias("test"),
    )


@query(
    "shuffle_rows",
    with_views(f"""
        SELECT record, row_number() OVER (ORDER BY {O.seeded("record")}) AS place FROM pairs"""),
)
def _(b):
    shuffled = R.shuffle_rows(b.pairs.select("record"), ["record"])
    # the place in the random order makes the order visible in the result
    return R.number_rows(shuffled, [R.seeded(["record"], 42), "record"], "place")


@query(
    "pairs_round_trip",
    with_views(
        "SELECT md5(instruction) AS instruction, response, category, template_id, feed_id"
        " FROM pairs"
    ),
)
def _(b):
    folder = f"{shared_folder(b.spark)}/pairs-{uuid.uuid4().hex}"
    J.write_pairs(b.pairs, folder)
    return J.read_pairs(b.spark, folder).select(
        F.md5("instruction").alias("instruction"), "response", "category", "template_id", "feed_id"
    )


@query(
    "splits_round_trip",
    with_views(
        f"""SELECT CASE WHEN rank <= {_TRAIN_SIZE} THEN 'train' ELSE 'test' END AS split,
                   count(*) AS n FROM ranked GROUP BY 1""",
        ranked=_SPLIT,
    ),
)
def _(b):
    folder = f"{shared_folder(b.spark)}/splits-{uuid.uuid4().hex}"
    J.write_splits(R.stratified_split(b.pairs, key=["record"]), folder)
    return J.read_splits(b.spark, folder).groupBy("split").agg(F.count(F.lit(1)).alias("n"))


# --- generated pairs --------------------------------------------------------------------

# each part: SELECT instruction, response, category, template_id, feed_id, provider


def _part(category: str, label: str, table: str, guard: str, question: str, answer: str) -> str:
    return f"""
        SELECT {question} AS instruction, {answer} AS response, '{category}' AS category,
               '{label}' AS template_id, feed_id, provider FROM {table} WHERE {guard}"""


def _text(pattern: str) -> str:
    """A pattern with {SQL} places as a concatenation."""
    pieces = []
    for i, piece in enumerate(pattern.replace("{", "}").split("}")):
        if i % 2:
            pieces.append(f"coalesce(CAST({piece} AS VARCHAR), '')")
        elif piece:
            pieces.append("'" + piece.replace("'", "''") + "'")
    return " || ".join(pieces)


def _if(condition: str, pattern: str) -> str:
    return f" || CASE WHEN {condition} THEN {_text(pattern)} ELSE '' END"


def _n(c: str) -> str:
    # marks a thousands place inside a pattern
    return "{" + O.thousands(c).replace("{", "\0").replace("}", "\1") + "}"


def _sql(pattern: str) -> str:
    return _text(pattern).replace("\0", "{").replace("\1", "}")


_FACTS = {
    "agencies": """
        SELECT a.feed_id, f.provider, coalesce(agency_name, '') AS agency_name,
               coalesce(agency_timezone, '') AS agency_timezone, f.* EXCLUDE (feed_id, provider)
        FROM agency a JOIN feed_stats f USING (feed_id)""",
    "described": f"""
        SELECT r.feed_id, provider, {O.NAME} AS name, trip_count, stop_count, route_long_name,
               first_departure, last_departure,
               CASE WHEN route_short_name <> '' AND route_long_name <> ''
                    THEN route_short_name || ' (' || route_long_name || ')' ELSE {O.NAME} END
                   AS full_name,
               CASE WHEN route_type IS NULL THEN 'transit' ELSE {O.mode('route_type')} END
                   AS mode,
               array_to_string(list_slice(headsigns, 1, 3), ', ') AS destinations
        FROM picked r JOIN feeds USING (feed_id)""",
    "type_lists": f"""
        SELECT feed_id, any_value(provider) AS provider, {O.mode('route_type')} AS mode,
               count(*) AS n,
               coalesce(string_agg(name, ', ' ORDER BY _pos) FILTER (name <> '' AND k <= 15), '')
                   AS names
        FROM (SELECT l.feed_id, provider, route_type, {O.NAME} AS name, _pos,
                     row_number() OVER (PARTITION BY l.feed_id, route_type ORDER BY _pos) AS k
              FROM listed l JOIN feeds USING (feed_id) WHERE route_type IS NOT NULL)
        GROUP BY feed_id, route_type""",
    "stop_facts": """
        SELECT s.*, provider FROM stop_draw s JOIN feeds USING (feed_id) WHERE draw <= 30""",
    "transfer_facts": f"""
        SELECT t.*, provider, CASE WHEN transfer_type IS NULL THEN 'a transfer'
            ELSE {O.coded('transfer_type', O.TRANSFER_TYPES, "'a standard transfer'")} END AS kind
        FROM transfer_draw t JOIN feeds USING (feed_id) WHERE draw <= 15""",
}

_AVG_STOPS = "\0:.1f\1"
_FEED_NUMBERS = (
    "{format('\0:.1f\1', avg_stops_per_route)}",
    "{format('\0:.0f\1', avg_trips_per_route)}",
)

PARTS = {
    "agency_pairs": [
        _part(
            "agency_overview", "agency_modes_v1", "agencies", "agency_name <> '' AND modes > 0",
            _sql("What transit modes does {agency_name} operate?"),
            _sql(
                "{agency_name} operates the following transit services: {modes_text}. In total,"
                " the agency has {total_routes} routes."
            ),
        ),
        _part(
            "agency_overview", "agency_modes_v2", "agencies", "agency_name <> '' AND modes > 0",
            _sql("Describe the types of transit services provided by {agency_name}."),
            _sql("{agency_name} provides the following transit services: {modes_text}."),
        ),
        _part(
            "agency_overview", "agency_route_count_v1", "agencies",
            "agency_name <> '' AND total_routes > 0",
            _sql("How many routes does {agency_name} have?"),
            _sql("{agency_name} operates {total_routes} routes. {breakdown}."),
        ),
        _part(
            "agency_overview", "agency_route_count_v2", "agencies",
            "agency_name <> '' AND total_routes > 0",
            _sql("Tell me about the size of {agency_name}'s transit network."),
            _sql(
                "{agency_name} operates a transit network with {total_routes} routes,"
                " {total_stops} stops, and approximately " + _n("total_trips")
                + " scheduled trips."
            ),
        ),
        _part(
            "agency_overview", "agency_timezone", "agencies",
            "agency_name <> '' AND agency_timezone <> ''",
            _sql("What timezone does {agency_name} operate in?"),
            _sql("{agency_name} operates in the {agency_timezone} timezone."),
        ),
    ],
    "route_pairs": [
        _part(
            "route_info", "route_describe_v1", "described", "name <> ''",
            _sql("Describe route {name} operated by {provider}."),
            _sql("Route {full_name} is a {mode} service operated by {provider}.")
            + _if("trip_count > 0", " It runs approximately " + _n("trip_count") + " trips.")
            .replace("\0", "{").replace("\1", "}")
            + _if("stop_count > 0", " The route serves {stop_count} stops.")
            + _if("destinations <> ''", " Destinations include: {destinations}."),
        ),
        _part(
            "route_info", "route_describe_v2", "described", "name <> ''",
            _sql("What type of service is route {name} by {provider}?"),
            _sql("Route {name} by {provider} is a {mode} service.")
            + _if("route_long_name <> ''", " Its full name is '{route_long_name}'."),
        ),
        _part(
            "schedule", "route_trip_count", "described", "name <> '' AND trip_count > 0",
            _sql("How many trips run on route {name} by {provider}?"),
            _sql(
                "Route {name} operated by {provider} has approximately " + _n("trip_count")
                + " scheduled trips."
            ),
        ),
        _part(
            "schedule", "route_schedule_v1", "described",
            "name <> '' AND first_departure <> '' AND last_departure <> ''",
            _sql("What are the first and last departure times for route {name} by {provider}?"),
            _sql(
                "Route {name} by {provider} has its first departure at {"
                + O.clock("first_departure") + "} and its last departure at {"
                + O.clock("last_departure") + "}."
            ),
        ),
        _part(
            "schedule", "route_schedule_v2", "described", "name <> '' AND trip_count > 0",
            _sql("Give me a schedule overview of route {name} by {provider}."),
            _sql(
                "Route {name} by {provider} runs " + _n("trip_count")
                + " trips serving {stop_count} stops."
            )
            + _if(
                "first_departure <> '' AND last_departure <> ''",
                " Service starts at {" + O.clock("first_departure") + "} and ends at {"
                + O.clock("last_departure") + "}.",
            ),
        ),
    ],
    "route_list_pairs": [
        _part(
            "route_info", "route_list_by_type", "type_lists", "n > 0",
            _sql("List all {lower(mode)} routes operated by {provider}."),
            _sql("{provider} operates {n} {lower(mode)} routes: {names}")
            + _if("n <= 15", ".")
            + _if("n > 15", ", and {n - 15} more."),
        ),
    ],
    "stop_pairs": [
        _part(
            "stop_info", "stop_location_v1", "stop_facts",
            "stop_name <> '' AND stop_lat <> 0 AND stop_lon <> 0",
            _sql("Where is the {stop_name} stop located in the {provider} network?"),
            _sql(
                "The {stop_name} stop is located at latitude {format('\0:.4f\1', stop_lat)},"
                " longitude {format('\0:.4f\1', stop_lon)} in the {provider} transit network."
            ),
        ),
        _part(
            "stop_info", "stop_location_v2", "stop_facts",
            "stop_name <> '' AND stop_lat <> 0 AND stop_lon <> 0",
            _sql("What are the coordinates of {stop_name}?"),
            _sql(
                "{stop_name} is located at coordinates ({format('\0:.4f\1', stop_lat)},"
                " {format('\0:.4f\1', stop_lon)})."
            ),
        ),
        _part(
            "stop_info", "stop_count", "feed_stats", "provider <> '' AND total_stops > 0",
            _sql("How many stops are in the {provider} network?"),
            _sql("The {provider} network has " + _n("total_stops") + " stops.")
            + _if(
                "station_count > 0",
                " Of these, {station_count} are classified as stations (parent stops).",
            ),
        ),
    ],
    "transfer_pairs": [
        _part(
            "transfer", "transfer_info", "transfer_facts",
            "from_stop_name <> '' AND to_stop_name <> ''",
            _sql(
                "What is the transfer between {from_stop_name} and {to_stop_name} in the"
                " {provider} system?"
            ),
            _sql(
                "There is {kind} between {from_stop_name} and {to_stop_name} in the {provider}"
                " network."
            )
            + _if(
                "min_transfer_time > 0",
                " The minimum transfer time is {min_transfer_time} seconds"
                " ({min_transfer_time // 60} minutes).",
            ),
        ),
        _part(
            "transfer", "transfer_count", "feed_stats", "provider <> '' AND total_transfers > 0",
            _sql("How many transfer points does {provider} have?"),
            _sql(
                "{provider} has " + _n("total_transfers")
                + " defined transfer connections in its network."
            ),
        ),
    ],
    "network_pairs": [
        _part(
            "network_stats", "network_overview_v1", "feed_stats", "provider <> ''",
            _sql("Give me an overview of the {provider} transit network."),
            _sql(
                "The {provider} transit network consists of {total_routes} routes serving "
                + _n("total_stops") + " stops. There are approximately " + _n("total_trips")
                + " scheduled trips. On average, each route serves about " + _FEED_NUMBERS[0]
                + " stops and runs " + _FEED_NUMBERS[1] + " trips."
            ),
        ),
        _part(
            "network_stats", "network_overview_v2", "feed_stats", "provider <> ''",
            _sql("How large is the {provider} transit system?"),
            _sql(
                "{provider} ({country_code}) operates {total_routes} routes with "
                + _n("total_stops") + " stops across its network."
            ),
        ),
    ],
    "key_statistics_pairs": [
        _part(
            "network_stats", "key_network_stats", "feed_stats", "provider <> ''",
            _sql("What are the key network statistics for {provider}?"),
            _sql(
                "{provider} operates {total_routes} routes serving " + _n("total_stops")
                + " stops with " + _n("total_trips") + " scheduled trips. On average, each route"
                " serves " + _FEED_NUMBERS[0] + " stops and runs " + _FEED_NUMBERS[1] + " trips."
            ),
        ),
    ],
}

_MADE = {**_PICKED, **_FACTS}

for _name, _parts in PARTS.items():

    @query(_name, with_stats(" UNION ALL ".join(_parts), **_MADE))
    def _(b, name=_name):
        summary = b.listed if name.startswith("route") else b.summary
        return getattr(Q, name)(summary).select(*PAIR_FIELDS)


_JOURNEY = {
    "running": f"""
        SELECT *, {O.NAME} AS name FROM listed WHERE first_departure <> '' AND trip_count > 0""",
    "journey": """
        SELECT f.feed_id, provider, mode_names, modes, weekend_services, weekday_services,
               n AS scheduled, b.name AS busiest_name, b.trip_count AS busiest_trips,
               e.name AS early_name, e.first_departure AS early_departure,
               l.name AS late_name, l.last_departure AS late_departure,
               t.from_stop_name, t.to_stop_name, t.min_transfer_time,
               t.draw IS NOT NULL AS has_transfer
        FROM feed_stats f
        JOIN (SELECT feed_id, count(*) AS n FROM running GROUP BY 1) c USING (feed_id)
        JOIN (SELECT *, row_number() OVER (PARTITION BY feed_id ORDER BY trip_count DESC, _pos)
                  AS k FROM running) b ON b.feed_id = f.feed_id AND b.k = 1
        LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY feed_id ORDER BY _pos) AS k
                   FROM running WHERE first_departure < '06:00') e
             ON e.feed_id = f.feed_id AND e.k = 1
        LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY feed_id ORDER BY _pos) AS k
                   FROM running WHERE last_departure > '23:00') l
             ON l.feed_id = f.feed_id AND l.k = 1
        LEFT JOIN transfer_draw t ON t.feed_id = f.feed_id AND t.draw = 1
        WHERE provider <> ''""",
}
JOURNEY_PARTS = [
    _part(
        "journey_planning", "transfer_availability", "journey", "has_transfer",
        _sql(
            "Can I transfer between {from_stop_name} and {to_stop_name} in the {provider} network?"
        ),
        _sql(
            "Yes, there is a transfer connection between {from_stop_name} and {to_stop_name} in"
            " the {provider} network."
        )
        + _if(
            "min_transfer_time <> 0",
            " The minimum transfer time is {min_transfer_time} seconds"
            " ({min_transfer_time // 60} minutes).",
        )
        + _if("coalesce(min_transfer_time, 0) = 0", " This is a recommended transfer point."),
    ),
    _part(
        "journey_planning", "earliest_service", "journey", "early_departure IS NOT NULL",
        _sql("What is the earliest service available on {provider}?"),
        _sql(
            "Route {early_name} has one of the earliest departures at {early_departure}, making it"
            " available for early morning commuters."
        ),
    ),
    _part(
        "journey_planning", "late_night_service", "journey", "late_departure IS NOT NULL",
        _sql("Does {provider} offer late-night service?"),
        _sql("Yes, route {late_name} runs until {late_departure}, providing late-night service."),
    ),
    _part(
        "journey_planning", "multimodal_journey", "journey", "modes > 1",
        _sql("Can I combine different transit modes on {provider}?"),
        _sql(
            "Yes, {provider} operates multiple transit modes: {mode_names}. You can combine these"
            " modes in a single journey by transferring between them at connection points."
        ),
    ),
    _part(
        "journey_planning", "weekend_availability", "journey", "weekend_services > 0",
        _sql("Is weekend service available on {provider}?"),
        _sql(
            "Yes, {provider} defines {weekend_services} weekend service patterns (compared to"
            " {weekday_services} weekday patterns). Weekend service is typically reduced compared"
            " to weekdays."
        ),
    ),
    _part(
        "journey_planning", "most_frequent_route", "journey", "scheduled > 1",
        _sql("What is the most frequent route on {provider}?"),
        _sql(
            "Route {busiest_name} is the most frequent with " + _n("busiest_trips")
            + " scheduled trips, making it one of the best options for minimizing wait times."
        ),
    ),
]


@query("journey_pairs", with_stats(" UNION ALL ".join(JOURNEY_PARTS), **_MADE, **_JOURNEY))
def _(b):
    return Q.journey_pairs(b.kept).select(*PAIR_FIELDS)


def _whole(category: str, label: str, table: str, question: str, answer: str) -> str:
    """A pair over all feeds."""
    return f"""
        SELECT {question} AS instruction, {answer} AS response, '{category}' AS category,
               '{label}' AS template_id, '' AS feed_id, '' AS provider FROM {table}"""


def _ranking(metric: str, entry: str) -> str:
    return f"""
        SELECT arg_min(provider, rank) AS provider, arg_min(country_code, rank) AS country_code,
               arg_min({metric}, rank) AS total,
               string_agg({entry}, ', ' ORDER BY rank) AS top
        FROM (SELECT *, row_number() OVER (ORDER BY {metric} DESC, feed_id) AS rank
              FROM feed_stats) WHERE rank <= 5"""


_COMPARED = {
    "by_routes": _ranking("total_routes", "provider || ' (' || total_routes || ')'"),
    "by_stops": _ranking(
        "total_stops", f"provider || ' (' || {O.thousands('total_stops')} || ')'"
    ),
    "neighbours": """
        SELECT a.provider AS ap, a.country_code AS ac, a.total_routes AS ar, a.total_stops AS ast,
               b.provider AS bp, b.country_code AS bc, b.total_routes AS br, b.total_stops AS bst
        FROM (SELECT *, row_number() OVER (ORDER BY feed_id) AS k FROM feed_stats) a
        JOIN (SELECT *, row_number() OVER (ORDER BY feed_id) AS k FROM feed_stats) b
             ON b.k = a.k + 1 WHERE a.k <= 10""",
    "several": """
        SELECT string_agg(provider || ' (' || modes || ' modes)', ', ' ORDER BY feed_id) AS names
        FROM (SELECT * FROM feed_stats WHERE modes > 1 ORDER BY feed_id LIMIT 8)""",
    "lands": """
        SELECT count(*) AS n, string_agg(country_code || ': ' || providers, '. '
                   ORDER BY country_code) AS listed
        FROM (SELECT country_code, string_agg(provider, ', ' ORDER BY feed_id) AS providers
              FROM feeds WHERE country_code <> '' GROUP BY 1)""",
    "paired": _PAIRED,
    "random_pairs": """
        SELECT a.provider AS ap, a.country_code AS ac, a.total_routes AS ar, a.total_stops AS ast,
               a.total_trips AS atr, b.provider AS bp, b.country_code AS bc,
               b.total_routes AS br, b.total_stops AS bst, b.total_trips AS btr
        FROM paired p JOIN paired q ON p.pair = q.pair AND p.side = 1 AND q.side = 0
        JOIN feed_stats a ON a.feed_id = p.feed_id JOIN feed_stats b ON b.feed_id = q.feed_id""",
    "ends": """
        SELECT a.provider, a.country_code, a.total_trips AS total, b.provider AS last_provider,
               b.total_trips AS last_total
        FROM (SELECT * FROM feed_stats ORDER BY total_trips DESC, feed_id LIMIT 1) a,
             (SELECT * FROM feed_stats ORDER BY total_trips, feed_id DESC LIMIT 1) b""",
    "diverse": "SELECT * FROM feed_stats ORDER BY modes DESC, feed_id LIMIT 1",
}
COMPARATIVE_PARTS = [
    _whole(
        "comparative", "most_routes", "by_routes",
        _sql("Which transit agency in the dataset has the most routes?"),
        _sql(
            "{provider} ({country_code}) has the most routes with {total} routes. The top 5 by"
            " route count are: {top}."
        ),
    ),
    _whole(
        "comparative", "most_stops", "by_stops",
        _sql("Which transit network has the most stops?"),
        _sql(
            "{provider} ({country_code}) has the most stops with " + _n("total")
            + ". The top 5 by stop count are: {top}."
        ),
    ),
    _whole(
        "comparative", "compare_pair", "neighbours",
        _sql("Compare the transit networks of {ap} and {bp}."),
        _sql(
            "{ap} ({ac}) has {ar} routes and " + _n("ast") + " stops. {bp} ({bc}) has {br} routes"
            " and " + _n("bst") + " stops. "
            "{CASE WHEN ar > br THEN 'The former' ELSE 'The latter' END} has more routes, while"
            " {CASE WHEN ast > bst THEN 'the former' ELSE 'the latter' END} has more stops."
        ),
    ),
    _whole(
        "comparative", "multimodal_agencies", "several",
        _sql("Which transit agencies operate multiple transit modes?"),
        _sql(
            "The following agencies operate multiple transit modes: {names}. Multi-modal agencies"
            " provide a combination of services such as bus, subway, tram, rail, and ferry."
        ),
    ),
    _whole(
        "comparative", "countries", "lands",
        _sql("What countries are represented in the transit dataset?"),
        _sql("The dataset covers transit agencies from {n} countries: {listed}."),
    ),
]
SIZE_PARTS = [
    _whole(
        "comparative", "size_comparison_expanded", "random_pairs",
        _sql("Compare the size of {ap} and {bp} transit networks."),
        _sql(
            "{ap} ({ac}) has {ar} routes, " + _n("ast") + " stops, and " + _n("atr") + " trips. "
            "{bp} ({bc}) has {br} routes, " + _n("bst") + " stops, and " + _n("btr") + " trips. "
            "{CASE WHEN ar > br THEN 'The former' ELSE 'The latter' END} has more routes."
        ),
    ),
    _whole(
        "comparative", "most_trips", "ends",
        _sql("Which transit agency has the most scheduled trips?"),
        _sql(
            "{provider} ({country_code}) has the most scheduled trips with " + _n("total")
            + ". The fewest is {last_provider} with " + _n("last_total") + " trips."
        ),
    ),
    _whole(
        "comparative", "most_diverse_modes", "diverse",
        _sql("Which transit agency offers the most diverse range of transit modes?"),
        _sql(
            "{provider} ({country_code}) offers the most diverse transit with {modes} different"
            " modes: {mode_names}."
        ),
    ),
]


@query("comparative_pairs", with_stats(" UNION ALL ".join(COMPARATIVE_PARTS), **_COMPARED))
def _(b):
    return Q.comparative_pairs(b.kept).select(*PAIR_FIELDS)


@query("size_pairs", with_stats(" UNION ALL ".join(SIZE_PARTS), **_COMPARED))
def _(b):
    return Q.size_pairs(b.kept).select(*PAIR_FIELDS)


_STATIC = """
    SELECT text AS instruction, text AS response, 'gtfs_knowledge' AS category,
           'known' AS template_id, '' AS feed_id, '' AS provider FROM benchmark"""


def _knowledge(b):
    return Q.static_pairs(
        b.raw("benchmark").selectExpr("text as instruction", "text as response"),
        category="gtfs_knowledge", template_id="known",
    )


@query("static_pairs", _STATIC)
def _(b):
    return _knowledge(b).select(*PAIR_FIELDS)


_ALL_PARTS = [
    *[part for parts in PARTS.values() for part in parts],
    *JOURNEY_PARTS, *COMPARATIVE_PARTS, *SIZE_PARTS, _STATIC,
]


@query(
    "generate_dataset",
    with_stats(
        "SELECT DISTINCT ON (instruction) instruction, category, template_id FROM ("
        + " UNION ALL ".join(_ALL_PARTS) + ")",
        **_MADE, **_JOURNEY, **_COMPARED,
    ),
)
def generate_dataset(b):
    fixed = _knowledge(b).select(*PAIR_FIELDS)
    return Q.generate_dataset(b.summary, fixed, expanded=True).select(
        "instruction", "category", "template_id"
    )


# network pairs, those of one feed with wrong numbers
_CLAIMS = " UNION ALL ".join(PARTS["network_pairs"] + PARTS["agency_pairs"])
_CHANGED = """
    SELECT * REPLACE (CASE WHEN feed_id = '2' THEN replace(response, '1', '7') ELSE response END
        AS response) FROM claims"""


def _stated(noun: str, lead: str = "") -> str:
    return (
        f"TRY_CAST(replace(regexp_extract(response, '{lead}(\\d[\\d,]*)\\s+{noun}', 1), ',', '')"
        " AS BIGINT)"
    )


_STATED = f"""
    SELECT c.feed_id, instruction, 'route count' AS subject, {_stated('routes')} AS found,
           total_routes AS expected
    FROM changed c JOIN feed_stats f ON f.feed_id = c.feed_id
    WHERE category = 'network_stats' AND {_stated('routes')} IS NOT NULL AND total_routes > 0
    UNION ALL
    SELECT c.feed_id, instruction, 'stop count', {_stated('stops')}, total_stops
    FROM changed c JOIN feed_stats f ON f.feed_id = c.feed_id
    WHERE category = 'network_stats' AND {_stated('stops')} IS NOT NULL AND total_stops > 0
    UNION ALL
    SELECT c.feed_id, instruction, 'agency route count', {_stated('routes', 'operates\\s+')},
           total_routes
    FROM changed c JOIN feed_stats f ON f.feed_id = c.feed_id
    WHERE template_id = 'agency_route_count_v1'
      AND {_stated('routes', 'operates\\s+')} IS NOT NULL AND total_routes > 0"""
_CHECKED = {**_MADE, "claims": _CLAIMS, "changed": _CHANGED, "stated": _STATED}


def _claims(b):
    made = P.union_pairs(Q.network_pairs(b.kept), Q.agency_pairs(b.kept))
    wrong = F.when(F.col("feed_id") == "2", F.replace("response", F.lit("1"), F.lit("7")))
    return made.select(*PAIR_FIELDS).withColumn(
        "response", F.coalesce(wrong, F.col("response"))
    )


@query("stated_facts", with_stats("SELECT * FROM stated", **_CHECKED))
def _(b):
    return P.stated_facts(_claims(b), b.kept.feed_stats)


@query(
    "check_facts",
    with_stats(
        """SELECT count(*) AS checks_performed,
                  count(*) FILTER (found = expected) AS checks_passed,
                  round(count(*) FILTER (found = expected) / count(*) * 100, 1) AS accuracy
           FROM stated""",
        **_CHECKED,
    ),
)
def _(b):
    return P.check_facts(_claims(b), b.kept.feed_stats).select(
        "checks_performed", "checks_passed", "accuracy"
    )


@query(
    "distribution_check",
    with_views("""
        SELECT count(*) AS total_pairs,
               count(DISTINCT feed_id) FILTER (feed_id <> '') AS feeds_covered,
               count(DISTINCT coalesce(template_id, 'unknown')) AS unique_templates
        FROM pairs"""),
)
def _(b):
    return distribution_check(b.pairs).select(
        "total_pairs", "feeds_covered", "unique_templates"
    )


@query(
    "validate_pairs",
    with_views(
        f"""SELECT count(*) AS total_pairs,
                   count(*) FILTER (rank <= {_TRAIN_SIZE}) AS train_size,
                   count(*) FILTER (rank > {_TRAIN_SIZE}) AS test_size,
                   false AS all_checks_passed
            FROM ranked""",
        ranked=_SPLIT,
    ),
)
def _(b):
    stats = b.kept.feed_stats
    return validate_pairs(b.pairs, stats).report.select(
        "total_pairs", "train_size", "test_size", "all_checks_passed"
    )


# --- benchmark items ----------------------------------------------------------------------


def _item(category, difficulty, table, guard, question, answer, criteria) -> str:
    return f"""
        SELECT {question} AS question, {answer} AS expected_answer,
               {criteria} AS scoring_criteria, '{difficulty}' AS difficulty,
               '{category}' AS category, feed_id FROM {table} WHERE {guard}"""


_ITEM_VIEWS = {
    "named": f"SELECT * EXCLUDE (rn), {O.NAME} AS name FROM listed",
    "sampled": f"""
        SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY feed_id
            ORDER BY {O.seeded("route_id")}) AS draw
        FROM named WHERE route_short_name <> '') WHERE draw = 1""",
    "networks": f"""
        SELECT f.*, s.route_short_name AS described_name,
               {O.mode('coalesce(s.route_type, 3)')} AS described_mode,
               s.trip_count AS described_trips, s.stop_count AS described_stops,
               b.name AS busiest_name, b.trip_count AS busiest_trips,
               w.name AS widest_name, w.stop_count AS widest_stops
        FROM feed_stats f
        LEFT JOIN sampled s ON s.feed_id = f.feed_id
        LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY feed_id
            ORDER BY trip_count DESC, _pos) AS k FROM named) b ON b.feed_id = f.feed_id AND b.k = 1
        LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY feed_id
            ORDER BY stop_count DESC, _pos) AS k FROM named) w ON w.feed_id = f.feed_id AND w.k = 1
        WHERE provider <> ''""",
    "timed": f"""
        SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY feed_id
            ORDER BY {O.seeded("route_id")}) AS draw
        FROM named WHERE route_short_name <> '' AND first_departure <> ''
            AND last_departure <> '') WHERE draw = 1""",
    "timetables": f"""
        SELECT t.*, provider, weekday_services, weekend_services, range_start, range_end,
               {_SPAN} AS span, {_HEADWAY} AS headway
        FROM timed t JOIN feed_stats USING (feed_id) WHERE provider <> ''""",
}
_ROUTE_ITEMS = [
    _item(
        "route_analysis", "easy", "networks", "true",
        _sql("How many transit routes does {provider} operate?"),
        _sql("{provider} operates {total_routes} routes."),
        _sql("Must state {total_routes} routes"),
    ),
    _item(
        "route_analysis", "easy", "networks", "modes > 0",
        _sql("What types of transit services does {provider} offer?"),
        _sql("{provider} offers: {mode_counts}."),
        _sql("Must mention the transit modes and approximate counts"),
    ),
    _item(
        "route_analysis", "medium", "networks", "described_name <> ''",
        _sql("Describe route {described_name} operated by {provider}."),
        _sql(
            "Route {described_name} is a {described_mode} service by {provider} with approximately "
            + _n("described_trips") + " trips serving {described_stops} stops."
        ),
        _sql(
            "Must mention route type ({described_mode}), trip count (~{described_trips}), and"
            " stop count (~{described_stops})"
        ),
    ),
    _item(
        "route_analysis", "medium", "networks", "busiest_trips IS NOT NULL",
        _sql("Which route in the {provider} network has the most scheduled trips?"),
        _sql(
            "Route {busiest_name} has the most trips with approximately " + _n("busiest_trips")
            + " scheduled trips."
        ),
        _sql("Must identify route {busiest_name} with ~{busiest_trips} trips"),
    ),
    _item(
        "route_analysis", "medium", "networks", "widest_stops IS NOT NULL",
        _sql("Which route in the {provider} network serves the most stops?"),
        _sql("Route {widest_name} serves the most stops with {widest_stops} stops."),
        _sql("Must identify route {widest_name} with {widest_stops} stops"),
    ),
]
_SCHEDULE_ITEMS = [
    _item(
        "schedule_reasoning", "easy", "timetables", "true",
        _sql("What are the operating hours for route {name} by {provider}?"),
        _sql(
            "Route {name} by {provider} starts service at {" + O.clock("first_departure")
            + "} and ends at {" + O.clock("last_departure") + "}."
        ),
        _sql(
            "Must mention first departure ~{first_departure} and last departure ~{last_departure}"
        ),
    ),
    _item(
        "schedule_reasoning", "medium", "timetables", "headway IS NOT NULL",
        _sql(
            "Route {name} by {provider} runs " + _n("trip_count") + " trips over approximately"
            " {span // 60} hours. Estimate the average frequency."
        ),
        _sql(
            "With " + _n("trip_count") + " trips over ~{span // 60} hours ({span} minutes), the"
            " average headway is approximately {format('\0:.1f\1', round_even(headway, 1))}"
            " minutes between trips."
        ),
        _sql(
            "Must calculate approximately {format('\0:.0f\1', round_even(headway, 0))} minutes"
            " between trips"
        ),
    ),
    _item(
        "schedule_reasoning", "medium", "timetables",
        "weekday_services > 0 AND range_start IS NOT NULL",
        _sql("How many service patterns does {provider} define for weekdays vs weekends?"),
        _sql(
            "{provider} defines {weekday_services} weekday service patterns and"
            " {weekend_services} weekend service patterns. The schedule covers the date range"
            " {range_start} to {range_end}."
        ),
        _sql(
            "Must mention {weekday_services} weekday and {weekend_services} weekend patterns"
        ),
    ),
]
_SIZE_ITEMS = [
    _item(
        "transit_operations", "easy", "feed_stats", "provider <> '' AND total_stops > 0",
        _sql(
            "How large is the {provider} transit network in terms of stops and routes?"
        ),
        _sql("The {provider} network has " + _n("total_stops") + " stops and {total_routes} routes."),
        _sql(
            "Must state approximately " + _n("total_stops") + " stops and {total_routes} routes"
        ),
    )
]
_ITEM_COLUMNS = [
    "question", "expected_answer", "scoring_criteria", "difficulty", "category", "feed_id",
]

for _name, _items in (
    ("route_items", _ROUTE_ITEMS), ("schedule_items", _SCHEDULE_ITEMS), ("size_items", _SIZE_ITEMS)
):

    @query(_name, with_stats(" UNION ALL ".join(_items), **_ITEM_VIEWS))
    def _(b, name=_name):
        return getattr(B, name)(b.kept).select(*_ITEM_COLUMNS)


def _numbered(items: list[str], stage: int) -> str:
    return " UNION ALL ".join(
        f"SELECT *, {stage} AS stage, {i} AS place FROM ({sql})" for i, sql in enumerate(items)
    )


_BENCHMARK = f"""
    SELECT printf('BM-%04d', row_number() OVER (ORDER BY stage, feed_id, place)) AS id,
           question, difficulty, category
    FROM ({_numbered(_ROUTE_ITEMS, 2)} UNION ALL {_numbered(_SCHEDULE_ITEMS, 4)}
          UNION ALL {_numbered(_SIZE_ITEMS, 6)})"""


@query("build_benchmark", with_stats(_BENCHMARK, **_ITEM_VIEWS))
def _(b):
    return B.build_benchmark(b.summary).select("id", "question", "difficulty", "category")


@query(
    "benchmark_metadata",
    with_stats(
        """SELECT 'category' AS dimension, coalesce(category, 'unknown') AS value,
               count(*) AS n FROM answers GROUP BY 2
           UNION ALL SELECT 'difficulty', coalesce(difficulty, 'medium'), count(*)
               FROM answers GROUP BY 2
           UNION ALL SELECT 'all', '', count(*) FROM answers""",
        **_ANSWERS,
    ),
)
def _(b):
    return P.benchmark_metadata(b.answers)


_LINES_20 = f"""
    SELECT feed_id, string_agg('  Route ' || CASE WHEN route_short_name <> '' THEN route_short_name
               ELSE coalesce(route_long_name, '?') END || ': '
               || {O.coded('coalesce(route_type, -1)', O.ROUTE_TYPES, "'unknown'")} || ', '
               || trip_count || ' trips, ' || stop_count || ' stops, '
               || coalesce(first_departure, '') || '-' || coalesce(last_departure, ''),
               chr(10) ORDER BY _pos) AS lines
    FROM listed WHERE rn <= 20 GROUP BY 1"""
_LINES_ALL = _LINES_20.replace("WHERE rn <= 20", "")
_CONTEXT = """
    SELECT f.feed_id, 'Agency: ' || a.agency_name || ' (timezone: '
               || coalesce(a.agency_timezone, '') || ')' || chr(10)
           || 'Total routes: ' || total_routes || chr(10)
           || 'Route types: ' || shown_counts || chr(10)
           || 'Route details:' || chr(10) || lines || chr(10)
           || 'Total stops: ' || total_stops || chr(10)
           || 'Weekday services: ' || weekday_services || ', Weekend services: '
           || weekend_services || chr(10)
           || 'Service date range: ' || range_start || ' to ' || range_end || chr(10)
           || 'Transfer connections: ' || total_transfers || chr(10)
           || 'Network: ' || total_trips || ' total trips, avg '
           || format('{:.1f}', avg_stops_per_route) || ' stops/route, avg '
           || format('{:.1f}', avg_trips_per_route) || ' trips/route' AS context
    FROM feed_stats f JOIN lines20 USING (feed_id)
    JOIN (SELECT feed_id, arg_min(agency_name, _pos) AS agency_name,
                 arg_min(coalesce(agency_timezone, ''), _pos) AS agency_timezone
          FROM agency GROUP BY 1) a USING (feed_id)"""


@query("feed_context", with_stats(_CONTEXT, lines20=_LINES_20))
def _(b):
    return B.feed_context(b.kept)


@query("feed_context_of_all_routes", with_stats(_CONTEXT, lines20=_LINES_ALL))
def _(b):
    return B.feed_context(replace(b.summary, context_routes=None).stored("route_stats", "feed_stats"))


def _first_routes(n: str, condition: str) -> str:
    """The draw from the first routes only, as ``described_from`` and ``timetabled_from`` ask."""
    return f"""
        SELECT * FROM (SELECT * EXCLUDE (rn), row_number() OVER (PARTITION BY feed_id
            ORDER BY {O.seeded("route_id")}) AS draw
        FROM ({O.first_n(f"(SELECT * FROM named WHERE {condition})", n, "feed_id", "_pos")}))
        WHERE draw = 1"""


@query(
    "items_of_first_routes",
    with_stats(
        "\nUNION ALL ".join([*_ROUTE_ITEMS, *_SCHEDULE_ITEMS]),
        **{
            **_ITEM_VIEWS,
            "sampled": _first_routes(20, "route_short_name <> ''"),
            "timed": _first_routes(
                10, "route_short_name <> '' AND first_departure <> '' AND last_departure <> ''"
            ),
        },
    ),
)
def _(b):
    first = replace(b.summary, described_from=20, timetabled_from=10)
    first = first.stored("route_stats", "listed_routes")
    items = B.route_items(first).unionByName(B.schedule_items(first))
    return items.select(*_ITEM_COLUMNS)


@query(
    "feed_prompt",
    with_stats(
        f"""SELECT feed_id, 'I have uploaded a GTFS feed. Here is the feed data:' || chr(10)
                || chr(10) || context || chr(10) || chr(10) || 'Based on this feed data, answer'
                || ' the following question:' || chr(10) || 'How many stops?' AS prompt
            FROM ({_CONTEXT})""",
        lines20=_LINES_20,
    ),
)
def _(b):
    return B.feed_prompt(B.feed_context(b.kept), "How many stops?").select("feed_id", "prompt")


@query(
    "feed_documents",
    with_stats("""
        SELECT f.feed_id, provider, total_routes, total_stops, total_transfers,
               (SELECT count(*) FROM listed l WHERE l.feed_id = f.feed_id) AS routes,
               (SELECT count(*) FROM agency a WHERE a.feed_id = f.feed_id) AS agencies,
               (SELECT count(*) FROM stop_draw s WHERE s.feed_id = f.feed_id AND draw <= 100)
                   AS sample_stops,
               (SELECT count(*) FROM transfer_draw s WHERE s.feed_id = f.feed_id AND draw <= 50)
                   AS sample_transfers,
               (SELECT string_agg(CAST(trip_count AS VARCHAR), ',' ORDER BY _pos) FROM listed l
                WHERE l.feed_id = f.feed_id) AS trip_counts
        FROM feed_stats f"""),
)
def _(b):
    d = b.kept.nested()
    return d.select(
        "feed_id",
        "provider",
        "network_stats.total_routes",
        "network_stats.total_stops",
        "transfer_summary.total_transfers",
        F.size("route_summary.routes").alias("routes"),
        F.size("agency").alias("agencies"),
        F.size("stop_summary.sample_stops").alias("sample_stops"),
        F.size("transfer_summary.sample_transfers").alias("sample_transfers"),
        F.array_join(
            F.transform("route_summary.routes", lambda r: r["trip_count"].cast("string")), ","
        ).alias("trip_counts"),
    )


_OWN = T.Template(
    category="own", label="own_v1", view="own_routes", guard="route_type is not null",
    instruction="What runs as {route_id}?",
    response=["A line of type {route_type}", ("route_long_name is not null", ": {route_long_name}")],
)


@query(
    "register_template",
    with_views("""
        SELECT 'What runs as ' || route_id || '?' AS instruction,
               'A line of type ' || route_type || coalesce(': ' || route_long_name, '') AS response,
               'own' AS category, 'own_v1' AS template_id, feed_id
        FROM routes WHERE route_type IS NOT NULL"""),
)
def _(b):
    view = b.routes.withColumn("item", F.col("_pos"))
    T.register_template(_OWN)
    found = T.REGISTRY.pop(_OWN.view)  # a view of its own, which generated datasets do not have
    return T.pairs_from(view, found).select(
        "instruction", "response", "category", "template_id", "feed_id"
    )


# --- scores --------------------------------------------------------------------------------


@query(
    "predictions_with_expected",
    with_stats(
        "SELECT id, category, generated FROM answers WHERE trip_count % 4 <> 0",
        **{
            **_ANSWERS,
            "answers": _ANSWERS["answers"].replace("AS generated", "AS generated, trip_count"),
        },
    ),
)
def _(b):
    stats = b.summary.route_stats.where("trip_count % 4 <> 0").select(
        F.concat("feed_id", F.lit("-"), "route_id").alias("id")
    )
    predictions = b.answers.select("id", "generated").join(stats, "id")
    return S.predictions_with_expected(predictions, b.answers.drop("generated")).select(
        "id", "category", "generated"
    )


# The longest common subsequence as a recursion over the tokens ``b``: ``best`` holds per token
# of ``a`` the longest match that ends at it or before.
_STEPS = """
    WITH RECURSIVE steps(key, a, b, j, best) AS (
        SELECT key, a, b, 0, list_transform(a, lambda x: 0) FROM token_pairs
        UNION ALL
        SELECT key, a, b, j + 1,
               list_transform(met, lambda x, i: list_max(list_slice(met, 1, i)))
        FROM (SELECT *, list_transform(a, lambda x, i: CASE WHEN x = b[j + 1]
                  THEN coalesce(best[i - 1], 0) + 1 ELSE best[i] END) AS met
              FROM steps WHERE j < len(b)))
    SELECT key, CASE WHEN len(a) + len(b) = 0 THEN 0.0
                ELSE 2 * coalesce(best[len(a)], 0) / (len(a) + len(b)) END AS rouge_l
    FROM steps WHERE j = len(b)"""


def _tokens(c: str) -> str:
    return (
        f"list_filter(string_split_regex(lower(coalesce({c}, '')), '[^a-z0-9]+'),"
        " lambda t: t <> '')"
    )


_SCORED = {
    **_ANSWERS,
    "token_pairs": f"""
        SELECT id AS key, {_tokens('generated')} AS a, {_tokens('expected_answer')} AS b
        FROM answers""",
    "rouge": _STEPS,
    "rated": f"""
        SELECT id, category, difficulty, rouge_l, {_KEYWORD} AS keyword_match,
               {_CRITERIA} AS criteria_match
        FROM answers JOIN rouge ON key = id""",
}
_SCORE_COLUMNS = ", ".join(f"round({c}, 9) AS {c}" for c in S.SCORES[:3])


@query(
    "score_answers",
    with_stats(
        f"""SELECT id, {_SCORE_COLUMNS},
                   round(0.4 * rouge_l + 0.3 * keyword_match + 0.3 * criteria_match, 9) AS combined
            FROM rated""",
        **_SCORED,
    ),
)
def score_answers(b):
    return S.score_answers(b.answers).select("id", *[F.round(s, 9).alias(s) for s in S.SCORES])


@query(
    "rouge_l_of_turns",
    f"""WITH token_pairs AS (
            SELECT {{'conv_id': conv_id, 'turn': turn}} AS key, {_tokens('c.text')} AS a,
                   {_tokens('d.text')} AS b
            FROM conversations c JOIN documents d ON doc_id = conv_id)
        SELECT key.conv_id AS conv_id, key.turn AS turn, round(rouge_l, 9) AS rouge_l
        FROM ({_STEPS})""",
)
def _(b):
    # whole replies against the whole document of the same number
    texts = b.raw("documents").select(F.col("doc_id").alias("conv_id"), "text")
    replies = b.raw("conversations").select("conv_id", "turn", F.col("text").alias("reply"))
    both = replies.join(texts, "conv_id")
    score = X.rouge_l(X.tokens(F.col("text")), X.tokens(F.col("reply")))
    return both.select("conv_id", "turn", F.round(score, 9).alias("rouge_l"))


_COMBINED = "0.4 * rouge_l + 0.3 * keyword_match + 0.3 * criteria_match"


@query(
    "combined_score",
    with_views(f"SELECT id, round({_COMBINED}, 9) AS combined FROM scored"),
)
def _(b):
    return _with_combined(b.scored).select("id", F.round("combined", 9).alias("combined"))


def _with_combined(df, shift: float = 0.0):
    score = X.combined_score(*[F.col(c) for c in S.SCORES[:3]])
    return df.withColumn("combined", score + shift)


_AVERAGES = ", ".join(f"round(avg({s}), 4) AS {s}_avg" for s in S.SCORES)


def _report_sql(table: str) -> str:
    levels = (
        ("overall", "NULL", "NULL", ""),
        ("category", "category", "NULL", "GROUP BY category"),
        ("difficulty", "NULL", "difficulty", "GROUP BY difficulty"),
        ("category_difficulty", "category", "difficulty", "GROUP BY category, difficulty"),
    )
    return " UNION ALL ".join(
        f"SELECT '{level}' AS level, {c} AS category, {d} AS difficulty, count(*) AS count,"
        f" {_AVERAGES} FROM {table} {group}"
        for level, c, d, group in levels
    )


_GRADED = f"""
    SELECT id, category, coalesce(difficulty, 'medium') AS difficulty, rouge_l, keyword_match,
           criteria_match, {_COMBINED} AS combined FROM scored"""
_SECOND = "SELECT * REPLACE (rouge_l * 0.5 AS rouge_l, combined * 0.9 AS combined) FROM graded" \
    " WHERE category <> 'error'"


@query("score_report", with_views(_report_sql("graded"), graded=_GRADED))
def _(b):
    return S.score_report(_with_combined(b.scored))


@query(
    "score_benchmark",
    with_stats(
        _report_sql("weighed"),
        **_SCORED,
        weighed="""
            SELECT * REPLACE (coalesce(difficulty, 'medium') AS difficulty),
                   0.5 * rouge_l + 0.25 * keyword_match + 0.25 * criteria_match AS combined
            FROM rated""",
    ),
)
def _(b):
    answers = kept(b.answers, "answers")  # made once for both sides
    predictions, benchmark = answers.select("id", "generated"), answers.drop("generated")
    return score_benchmark(predictions, benchmark, weights=(0.5, 0.25, 0.25)).report


def _two_reports(b):
    first = _with_combined(b.scored)
    second = (
        first.where("category <> 'error'")
        .withColumn("rouge_l", F.col("rouge_l") * 0.5)
        .withColumn("combined", F.col("combined") * 0.9)
    )
    return compare_runs(S.score_report(first), S.score_report(second), "first", "second")


def _two(select: str) -> str:
    return with_views(
        select,
        graded=_GRADED,
        second=_SECOND,
        r1=_report_sql("graded"),
        r2=_report_sql("second"),
    )


@query(
    "compare_reports",
    _two("""
        SELECT coalesce(a.category, b.category) AS category, coalesce(a.combined_avg, 0) AS base,
               coalesce(b.combined_avg, 0) AS candidate,
               round(coalesce(b.combined_avg, 0) - coalesce(a.combined_avg, 0), 4) AS delta,
               CASE WHEN coalesce(b.combined_avg, 0) > coalesce(a.combined_avg, 0) THEN '+'
                    ELSE '' END AS sign
        FROM (SELECT * FROM r1 WHERE level = 'category') a
        FULL JOIN (SELECT * FROM r2 WHERE level = 'category') b ON a.category = b.category"""),
)
def _(b):
    return _two_reports(b).categories


@query(
    "compare_many",
    _two("""
        SELECT coalesce(a.category, b.category) AS category, coalesce(a.combined_avg, 0) AS one,
               coalesce(b.combined_avg, 0) AS two, coalesce(a.combined_avg, 0) AS three,
               round(coalesce(a.combined_avg, 0) - coalesce(b.combined_avg, 0), 4) AS delta,
               CASE WHEN coalesce(a.combined_avg, 0) > coalesce(b.combined_avg, 0) THEN '+'
                    ELSE '' END AS sign
        FROM (SELECT * FROM r1 WHERE level = 'category') a
        FULL JOIN (SELECT * FROM r2 WHERE level = 'category') b ON a.category = b.category"""),
)
def _(b):
    first = _with_combined(b.scored)
    second = first.where("category <> 'error'").withColumn("combined", F.col("combined") * 0.9)
    one, two = S.score_report(first), S.score_report(second)
    return S.compare_many({"one": one, "two": two, "three": one}, "two", "three")


@query(
    "compare_overall",
    _two(" UNION ALL ".join(
        f"""SELECT '{s}' AS metric, a.{s}_avg AS base, b.{s}_avg AS candidate,
                   round(b.{s}_avg - a.{s}_avg, 4) AS delta,
                   CASE WHEN b.{s}_avg > a.{s}_avg THEN '+' ELSE '' END AS sign
            FROM r1 a, r2 b WHERE a.level = 'overall' AND b.level = 'overall'"""
        for s in S.SCORES
    )),
)
def _(b):
    return _two_reports(b).overall


@query(
    "overall_verdict",
    _two("""
        SELECT delta, CASE WHEN delta > 0.05 THEN 'second significantly outperforms the first.'
            WHEN delta > 0 THEN 'second slightly outperforms the first.'
            WHEN delta > -0.05 THEN 'Performance is roughly equivalent.'
            ELSE 'The first outperforms second.' END AS verdict
        FROM (SELECT round(b.combined_avg - a.combined_avg, 4) AS delta FROM r1 a, r2 b
              WHERE a.level = 'overall' AND b.level = 'overall')"""),
)
def _(b):
    return _two_reports(b).verdict


@query(
    "best_and_worst",
    with_views(
        """SELECT category, which, id, round(combined, 9) AS combined FROM (
               SELECT *, 'best' AS which, row_number() OVER (PARTITION BY category
                   ORDER BY combined DESC, id) AS k FROM graded
               UNION ALL
               SELECT *, 'worst', row_number() OVER (PARTITION BY category
                   ORDER BY combined, id DESC) FROM graded) WHERE k = 1""",
        graded=_GRADED,
    ),
)
def _(b):
    ends = R.best_and_worst(_with_combined(b.scored))
    return ends.select("category", "which", "id", F.round("combined", 9).alias("combined"))


@query(
    "answer_lookup",
    with_views("""
        SELECT q.doc_id, coalesce(a.item_id, -1) AS item_id
        FROM documents q LEFT JOIN (SELECT lower(text) AS k, min(item_id) AS item_id
                                    FROM benchmark GROUP BY 1) a ON a.k = lower(trim(q.text))
        UNION ALL
        SELECT -1 - i.item_id, a.item_id FROM benchmark i
        JOIN (SELECT lower(text) AS k, min(item_id) AS item_id FROM benchmark GROUP BY 1) a
             ON a.k = lower(i.text)"""),
)
def _(b):
    documents = b.raw("documents").selectExpr("doc_id", "text as question")
    asked = b.raw("benchmark").selectExpr(
        "-1 - item_id as doc_id",
        "concat('  ', translate(text, 'abcdefghij', 'ABCDEFGHIJ'), ' ') as question",
    )
    known = b.raw("benchmark").selectExpr("text as question", "string(item_id) as answer", "item_id")
    found = S.answer_lookup(documents.unionByName(asked), known, "-1", ["item_id"])
    return found.select("doc_id", F.col("answer").cast("bigint").alias("item_id"))
