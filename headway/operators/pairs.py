"""Question/answer pairs: union, duplicates, checks and distributions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.functions.scalars import clip, stripped
from headway.functions.texts import claimed_count
from headway.operators.cleaning import keep_first
from headway.operators.ranking import first_n
from headway.operators.single import beside
from headway.schema import FEED, PAIR_FIELDS

MIN_RESPONSE_LENGTH = 20
SHOWN_ISSUES = 20
SHOWN_DUPLICATES = 10
CLIPPED = 100


def union_pairs(*parts: DataFrame) -> DataFrame:
    """Bag union by column name."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def dedupe_instructions(pairs: DataFrame, order: Sequence[str | Column]) -> DataFrame:
    """The first pair of every instruction, texts compared exactly."""
    return keep_first(pairs, ["instruction"], order)


def duplicate_count(pairs: DataFrame) -> DataFrame:
    """How many pairs repeat an earlier instruction."""
    copies = pairs.groupBy(F.coalesce("instruction", F.lit("")).alias("instruction")).agg(
        F.count(F.lit(1)).alias("n")
    )
    return copies.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicate_count"))


def duplicate_samples(
    pairs: DataFrame, order: Sequence[str], n: int = SHOWN_DUPLICATES
) -> DataFrame:
    """The first n repeats in file order, clipped.

    Among the first n repeats no instruction can have more than n, so its first n + 1
    pairs suffice, however many there are.
    """
    text = pairs.select(F.coalesce("instruction", F.lit("")).alias("instruction"), *order)
    repeats = first_n(text, n + 1, ["instruction"], order, "_copy").where("_copy > 1")
    return repeats.orderBy(*order).limit(n).select(
        *order, clip(F.col("instruction"), CLIPPED).alias("sample")
    )


def check_duplicates(pairs: DataFrame, order: Sequence[str]) -> DataFrame:
    """One row: number of repeats and the first samples."""
    samples = duplicate_samples(pairs, order).agg(
        F.array_sort(F.collect_list(F.struct(*order, "sample"))).alias("s")
    )
    return beside(duplicate_count(pairs), samples).select(
        F.lit("duplicates").alias("check"),
        (F.col("duplicate_count") == 0).alias("passed"),
        "duplicate_count",
        F.transform("s", lambda x: x["sample"]).alias("samples"),
    )


def content_issues(pairs: DataFrame, record: str) -> DataFrame:
    """Empty or too short texts, one row per issue, worded."""
    question, answer = (F.coalesce(c, F.lit("")) for c in ("instruction", "response"))
    number = F.col(record).cast("string")

    def issue(test: Column, text: Column) -> Column:
        return F.when(test, F.concat(F.lit("Record "), number, F.lit(": "), text))

    empty_answer = stripped(answer) == ""
    too_short = ~empty_answer & (F.length(answer) < MIN_RESPONSE_LENGTH)
    short_text = F.concat(
        F.lit("response too short ("), F.length(answer).cast("string"), F.lit(" chars)")
    )
    found = F.array_compact(
        F.array(
            issue(stripped(question) == "", F.lit("empty instruction")),
            issue(empty_answer, F.lit("empty response")),
            issue(too_short, short_text),
        )
    )
    return pairs.select(record, F.posexplode(found).alias("place", "issue"))


def text_length_stats(pairs: DataFrame) -> DataFrame:
    """Least, greatest and mean length of both texts."""
    result = []
    for column in ("instruction", "response"):
        length = F.length(F.coalesce(column, F.lit("")))
        result += [
            F.coalesce(F.min(length), F.lit(0)).alias(f"{column}_min"),
            F.coalesce(F.max(length), F.lit(0)).alias(f"{column}_max"),
            F.coalesce(F.round(F.avg(length), 1), F.lit(0.0)).alias(f"{column}_avg"),
        ]
    return pairs.agg(*result)


def issue_list(issues: DataFrame, record: str, n: int = SHOWN_ISSUES) -> DataFrame:
    """One row: the number of issues and the first n in record order."""
    first = issues.orderBy(record, "place").limit(n).agg(
        F.array_sort(F.collect_list(F.struct(record, "place", "issue"))).alias("i")
    )
    return beside(issues.agg(F.count(F.lit(1)).alias("issues_count")), first).select(
        "issues_count", F.transform("i", lambda x: x["issue"]).alias("issues")
    )


def check_content(pairs: DataFrame, record: str) -> DataFrame:
    found = issue_list(content_issues(pairs, record), record)
    return beside(found, text_length_stats(pairs)).select(
        F.lit("content_quality").alias("check"),
        (F.col("issues_count") == 0).alias("passed"),
        "*",
    )


def missing_fields(lines: DataFrame, line: str = "value") -> DataFrame:
    """Adds the required fields a JSON line lacks; a field that is null is present."""
    needed = F.array(*[F.lit(f) for f in PAIR_FIELDS])
    return lines.withColumn(
        "missing", F.array_sort(F.array_except(needed, F.json_object_keys(F.col(line))))
    )


def check_format(lines: DataFrame, record: str, line: str = "value") -> DataFrame:
    """Records without all six fields: how many, and the first of them."""
    checked = missing_fields(lines, line)
    issues = checked.where(F.size("missing") > 0).select(
        record,
        F.lit(0).alias("place"),
        F.concat(
            F.lit("Record "),
            F.col(record).cast("string"),
            F.lit(": missing fields "),
            F.array_join("missing", ", "),
        ).alias("issue"),
    )
    total = checked.agg(F.count(F.lit(1)).alias("total_records"))
    return beside(issue_list(issues, record), total).select(
        F.lit("format").alias("check"),
        (F.col("issues_count") == 0).alias("passed"),
        "total_records",
        "issues_count",
        "issues",
    )


def pair_distribution(pairs: DataFrame) -> DataFrame:
    """Pairs per category, feed and template in one pass (``dimension, value, n``).

    ``percent`` is the share of all pairs, given for categories. Pairs without a feed
    are not counted as a feed of their own.
    """
    named = pairs.select(
        F.coalesce("category", F.lit("unknown")).alias("category"),
        F.coalesce(FEED, F.lit("")).alias(FEED),
        F.coalesce("template_id", F.lit("unknown")).alias("template_id"),
    )
    counted = named.groupingSets(
        [["category"], [FEED], ["template_id"], []], "category", FEED, "template_id"
    ).agg(F.grouping_id().alias("g"), F.count(F.lit(1)).alias("n"))
    # grouping_id: a bit per column, set where the column is grouped away
    dimension = (
        F.when(F.col("g") == 0b011, "category")
        .when(F.col("g") == 0b101, "feed")
        .when(F.col("g") == 0b110, "template")
        .otherwise("all")
    )
    rows = counted.select(
        dimension.alias("dimension"),
        F.coalesce("category", FEED, "template_id", F.lit("")).alias("value"),
        "n",
    )
    share = F.try_divide(F.col("n"), pairs.agg(F.count(F.lit(1))).scalar())
    return rows.where("not (dimension = 'feed' and value = '')").select(
        "dimension",
        "value",
        "n",
        F.when(F.col("dimension") == "category", F.round(share * 100, 1)).alias("percent"),
    )


def category_counts(pairs: DataFrame, by_count: bool = True) -> DataFrame:
    counts = pairs.groupBy("category").agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.desc("n"), "category") if by_count else counts.orderBy("category")


def benchmark_metadata(items: DataFrame) -> DataFrame:
    """Items in total, per category and per difficulty (``dimension, value, n``).

    Items without a category count as ``unknown``, without a difficulty as ``medium``, as in
    ``score_report``.
    """
    items = items.select(
        F.coalesce("category", F.lit("unknown")).alias("category"),
        F.coalesce("difficulty", F.lit("medium")).alias("difficulty"),
    )
    counted = items.groupingSets(
        [["category"], ["difficulty"], []], "category", "difficulty"
    ).agg(F.grouping_id().alias("g"), F.count(F.lit(1)).alias("n"))
    dimension = (
        F.when(F.col("g") == 0b01, "category").when(F.col("g") == 0b10, "difficulty").otherwise("all")
    )
    return counted.select(
        dimension.alias("dimension"),
        F.coalesce("category", "difficulty", F.lit("")).alias("value"),
        "n",
    )


def pairs_with_stats(pairs: DataFrame, feed_stats: DataFrame) -> DataFrame:
    """Pairs with the statistics of their feed; pairs of unknown feeds are left out."""
    return pairs.join(feed_stats, FEED)


def stated_facts(pairs: DataFrame, feed_stats: DataFrame) -> DataFrame:
    """Counts stated in answers next to the true ones (``subject, found, expected``)."""
    known = pairs_with_stats(
        pairs.select(*PAIR_FIELDS[:5]).where(
            "category = 'network_stats' or template_id = 'agency_route_count_v1'"
        ),
        feed_stats.select(FEED, "total_routes", "total_stops"),
    )
    text = F.col("response")
    network = F.col("category") == "network_stats"
    agency = F.col("template_id") == "agency_route_count_v1"

    def fact(test: Column, subject: str, found: Column, expected: str) -> Column:
        holds = test & found.isNotNull() & (F.col(expected) > 0)
        return F.when(
            holds,
            F.struct(
                F.lit(subject).alias("subject"),
                found.alias("found"),
                F.col(expected).cast("bigint").alias("expected"),
            ),
        )

    facts = F.array_compact(
        F.array(
            fact(network, "route count", claimed_count(text, "routes"), "total_routes"),
            fact(network, "stop count", claimed_count(text, "stops"), "total_stops"),
            fact(
                agency, "agency route count",
                claimed_count(text, "routes", before="operates"), "total_routes",
            ),
        )
    )
    return known.select(FEED, "instruction", F.explode(facts).alias("fact")).select(
        FEED, "instruction", "fact.*"
    )


def check_facts(
    pairs: DataFrame, feed_stats: DataFrame, n: int = SHOWN_ISSUES
) -> DataFrame:
    """One row: counts checked, counts right, accuracy and the first mismatches."""
    facts = stated_facts(pairs, feed_stats)
    wrong = facts.where("found <> expected").select(
        "subject",
        FEED,
        "instruction",
        F.concat(
            F.lit("Feed "), FEED, F.lit(": "), "subject", F.lit(" "),
            F.col("found").cast("string"), F.lit(" != expected "),
            F.col("expected").cast("string"),
        ).alias("text"),
    )
    shown = wrong.orderBy("subject", FEED, "instruction").limit(n).agg(
        F.sort_array(F.collect_list("text")).alias("mismatches")
    )
    summed = facts.agg(
        F.count(F.lit(1)).alias("checks_performed"),
        F.count_if(F.col("found") == F.col("expected")).alias("checks_passed"),
    )
    share = F.try_divide(F.col("checks_passed"), F.col("checks_performed")) * 100
    return beside(summed, shown).select(
        F.lit("factual_accuracy").alias("check"),
        (F.col("checks_performed") == F.col("checks_passed")).alias("passed"),
        "checks_performed",
        "checks_passed",
        F.coalesce(F.round(share, 1), F.lit(0.0)).alias("accuracy"),
        "mismatches",
    )


def validation_report(
    checks: Sequence[DataFrame], sizes: DataFrame, split_ratio: float
) -> DataFrame:
    """One row: all checks passed, the sizes, and every check as JSON.

    Each check is a one-row DataFrame with ``check`` and, unless it only describes,
    ``passed``; ``sizes`` is one row of counts.
    """
    rows = [
        c.select(
            F.lit(i).alias("place"),
            (F.col("passed") if "passed" in c.columns else F.lit(True)).alias("passed"),
            F.to_json(F.struct(*c.columns)).alias("check"),
        )
        for i, c in enumerate(checks)
    ]
    listed = reduce(DataFrame.union, rows).agg(
        F.bool_and("passed").alias("all_checks_passed"),
        F.transform(
            F.array_sort(F.collect_list(F.struct("place", "check"))), lambda x: x["check"]
        ).alias("checks"),
    )
    return beside(sizes, listed).withColumn("split_ratio", F.lit(split_ratio))
