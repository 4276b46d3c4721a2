"""Training pairs from feed statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.operators.pairs import dedupe_instructions, union_pairs
from headway.operators.ranking import shuffle_rows
from headway.plans import views as V
from headway.plans import wording as W
from headway.plans.summarise import FeedSummary
from headway.plans.templates import ORDER, REGISTRY, dataset_wide, pairs_from
from headway.schema import FEED, PAIR_FIELDS

# generation order of the parts
DATA, KNOWLEDGE, COMPARATIVE, EXPANDED_STATIC, JOURNEY, EXPANDED, STATISTICS = range(7)


def agency_pairs(s: FeedSummary) -> DataFrame:
    return pairs_from(V.agency_view(s), W.AGENCY_OVERVIEW, DATA)


def route_pairs(s: FeedSummary) -> DataFrame:
    """Descriptions and schedules of the picked routes."""
    return pairs_from(V.route_view(s), W.ROUTE_INFO + W.SCHEDULE, DATA)


def route_list_pairs(s: FeedSummary) -> DataFrame:
    return pairs_from(V.route_type_view(s), W.ROUTE_LIST, DATA)


def stop_pairs(s: FeedSummary) -> DataFrame:
    return union_pairs(
        pairs_from(V.stop_view(s), W.STOP_LOCATION, DATA),
        pairs_from(V.feed_view(s), W.STOP_COUNT, DATA),
    )


def transfer_pairs(s: FeedSummary) -> DataFrame:
    return union_pairs(
        pairs_from(V.transfer_view(s), W.TRANSFER_INFO, DATA),
        pairs_from(V.feed_view(s), W.TRANSFER_COUNT, DATA),
    )


def network_pairs(s: FeedSummary) -> DataFrame:
    return pairs_from(V.feed_view(s), W.NETWORK_STATS, DATA)


def key_statistics_pairs(s: FeedSummary) -> DataFrame:
    return pairs_from(V.feed_view(s), W.KEY_STATISTICS, STATISTICS)


def journey_pairs(s: FeedSummary) -> DataFrame:
    return pairs_from(V.journey_view(s), W.JOURNEY_PLANNING, JOURNEY)


def _over_all(view: DataFrame, template, stage: int, item: int) -> DataFrame:
    if "item" not in view.columns:
        view = view.withColumn("item", F.lit(""))
    # the view keeps its own provider for the text, the pair belongs to no feed
    pairs = pairs_from(
        view.withColumn("item", F.concat(F.lit(f"{item:02d}"), "item")).withColumn(
            FEED, F.lit("")
        ),
        [template],
        stage,
    )
    return pairs.withColumn("provider", F.lit(""))


def comparative_pairs(s: FeedSummary) -> DataFrame:
    """Rankings, neighbours, multi-modal feeds and countries."""
    routes = V.ranking_view(s, "total_routes", W.RANKED_ENTRY["most_routes"])
    stops = V.ranking_view(s, "total_stops", W.RANKED_ENTRY["most_stops"])
    return union_pairs(
        _over_all(routes, W.MOST_ROUTES, COMPARATIVE, 0),
        _over_all(stops, W.MOST_STOPS, COMPARATIVE, 1),
        _over_all(V.neighbour_view(s), W.COMPARE_PAIR, COMPARATIVE, 2),
        _over_all(V.multimodal_view(s), W.MULTIMODAL, COMPARATIVE, 3),
        _over_all(V.countries_view(s), W.COUNTRIES, COMPARATIVE, 4),
    )


def size_pairs(s: FeedSummary) -> DataFrame:
    """Random feed pairs, most and fewest trips, most modes; none for fewer than two feeds."""
    pairs = union_pairs(
        _over_all(V.shuffled_view(s), W.SIZE_COMPARISON, EXPANDED, 0),
        _over_all(V.extremes_view(s), W.MOST_TRIPS, EXPANDED, 1),
        _over_all(V.diverse_view(s), W.MOST_DIVERSE, EXPANDED, 2),
    )
    return pairs.where(s.feeds.agg(F.count(F.lit(1)) > 1).scalar())


def static_pairs(
    table: DataFrame,
    stage: int = KNOWLEDGE,
    category: str | None = None,
    template_id: str | None = None,
) -> DataFrame:
    """A user's fixed texts tagged as pairs of no feed.

    ``category`` and ``template_id`` replace those of the table.
    """
    tagged = dataset_wide(table)
    if category:
        tagged = tagged.withColumn("category", F.lit(category))
    if template_id:
        tagged = tagged.withColumn("template_id", F.lit(template_id))
    order = F.struct(
        F.lit(stage).alias("stage"),
        F.lit("").alias("feed"),
        F.col("instruction").alias("item"),
        F.lit(0).alias("place"),
    )
    return tagged.select(*PAIR_FIELDS, order.alias(ORDER))


def registered_pairs(s: FeedSummary) -> DataFrame | None:
    """Pairs of the templates added with ``register_template``."""
    made = {
        "agency": V.agency_view, "route": V.route_view, "route_type": V.route_type_view,
        "stop": V.stop_view, "transfer": V.transfer_view, "feed": V.feed_view,
        "journey": V.journey_view,
    }
    parts = [pairs_from(made[name](s), found, DATA) for name, found in REGISTRY.items()]
    return union_pairs(*parts) if parts else None


def data_pairs(s: FeedSummary) -> DataFrame:
    return union_pairs(
        agency_pairs(s), route_pairs(s), route_list_pairs(s), stop_pairs(s), transfer_pairs(s),
        network_pairs(s),
    )


def generate_dataset(
    summary: FeedSummary,
    knowledge: DataFrame | None = None,
    seed: int = 42,
    expanded: bool = False,
    stored: bool = True,
) -> DataFrame:
    """All pairs, unique by instruction, in random order.

    ``knowledge`` holds the user's fixed texts; ``expanded`` adds the journey, size and
    key statistics pairs.
    """
    s = summary.stored() if stored else summary
    parts = [data_pairs(s), comparative_pairs(s)]
    if knowledge is not None:
        parts.append(static_pairs(knowledge))
    if expanded:
        parts += [journey_pairs(s), size_pairs(s), key_statistics_pairs(s)]
    added = registered_pairs(s)
    if added is not None:
        parts.append(added)
    unique = dedupe_instructions(union_pairs(*parts), [ORDER, "template_id", "response"])
    return shuffle_rows(unique.select(*PAIR_FIELDS), ["instruction"], seed)
