"""The catalog of published feeds: filters, search and selection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from headway.operators.single import beside

# Agencies looked for (search term, country, size, reason).
TARGETS = (
    ("Los Angeles County Metropolitan", "US", "large", "LA Metro — major US transit system"),
    ("Chicago Transit Authority", "US", "large", "Chicago CTA — major US grid network"),
    ("Massachusetts Bay Transportation", "US", "large", "Boston MBTA — large US rail+bus system"),
    ("Transport For London", "GB", "large", "TfL — one of the world's largest transit networks"),
    ("Verkehrsverbund Berlin-Brandenburg", "DE", "large", "Berlin VBB — major European transit"),
    ("Toronto Transit Commission", "CA", "medium", "Toronto TTC — major Canadian agency"),
    ("Société de transport de Montréal", "CA", "medium", "Montreal STM — major Canadian agency"),
    ("STIB", "BE", "medium", "Brussels STIB — European capital transit"),
    ("Auckland Transport", "NZ", "medium", "Auckland — Oceania mid-size city"),
    ("São Paulo Transporte", "BR", "medium", "São Paulo — largest South American transit"),
    ("Valley Metro", "US", "small", "Phoenix — US Sun Belt mid-size transit"),
    ("Capital Metro", "US", "small", "Austin — growing US transit system"),
    ("TriMet", "US", "small", "Portland TriMet — mid-size US city"),
    ("Transperth", "AU", "small", "Perth — smaller Australian city transit"),
    ("Rejseplanen", "DK", "small", "Denmark national transit data"),
)

# Countries per region of the catalog tour.
REGIONS = {
    "North America": ("US", "CA", "MX"),
    "Europe": ("GB", "DE", "FR", "NL", "BE", "CH"),
    "Asia-Pacific": ("AU", "NZ", "JP", "KR", "IN"),
    "South America": ("BR", "CL", "AR"),
}

TARGET_COLUMNS = "target int, search_term string, target_country string, category string, selected_reason string"


def _if_present(df: DataFrame, column: str, test: Column) -> Column:
    return test if column in df.columns else F.lit(True)


def usable_feeds(catalog: DataFrame) -> DataFrame:
    """Static feeds that are not inactive, have a download URL and need no key.

    A feed without a status is usable. Tests on absent columns are skipped.
    """
    url, auth = F.col("direct_download"), F.col("authentication_type")
    return catalog.where(
        _if_present(catalog, "data_type", F.col("data_type") == "gtfs")
        & _if_present(catalog, "status", ~F.col("status").eqNullSafe("inactive"))
        & _if_present(catalog, "direct_download", url.isNotNull() & (url != ""))
        & _if_present(
            catalog,
            "authentication_type",
            auth.isNull() | F.coalesce(auth.try_cast("double") == 0, F.lit(False)),
        )
    )


def active_feeds(catalog: DataFrame) -> DataFrame:
    """The stricter choice: marked active, with a URL, no authentication type at all."""
    url, auth = F.col("direct_download"), F.col("authentication_type")
    return catalog.where(
        _if_present(catalog, "data_type", F.col("data_type") == "gtfs")
        & _if_present(catalog, "status", F.col("status") == "active")
        & _if_present(catalog, "direct_download", url.isNotNull())
        & _if_present(
            catalog, "authentication_type", auth.isNull() | (auth.cast("string") == "")
        )
    )


def provider_search(catalog: DataFrame, term: str, country: str | None = None) -> DataFrame:
    """Feeds whose provider matches a pattern, whatever the case."""
    found = catalog.where(F.col("provider").rlike("(?iu)" + term))
    return found.where(F.col("country_code") == country) if country else found


def feeds_in_region(
    catalog: DataFrame, regions: dict[str, Sequence[str]] = REGIONS
) -> DataFrame:
    """Feeds with the region of their country; feeds of other countries are left out."""
    names = F.create_map(
        *[F.lit(x) for region, codes in regions.items() for code in codes for x in (code, region)]
    )
    return catalog.withColumn("region", F.try_element_at(names, F.col("country_code"))).where(
        "region is not null"
    )


def target_table(spark: SparkSession, targets=TARGETS) -> DataFrame:
    rows = [(i, *t) for i, t in enumerate(targets)]
    return spark.createDataFrame(rows, TARGET_COLUMNS)


def _matches(catalog: DataFrame, targets: DataFrame) -> DataFrame:
    hit = (F.col("country_code") == F.col("target_country")) & F.rlike(
        F.col("provider"), F.concat(F.lit("(?iu)"), F.col("search_term"))
    )
    # without a hint: Spark knows the size of the user's list and broadcasts a short one
    return catalog.join(targets, hit)


def select_seed_feeds(
    catalog: DataFrame, targets: DataFrame, order: Sequence[str | Column] = ("mdb_source_id",)
) -> DataFrame:
    """The first catalog entry for every target, as seed feed records in target order.

    The country is compared first, so the pattern is tried on the entries of a target's
    country only; the first match per target is cut out before the shuffle.
    """
    first = Window.partitionBy("target").orderBy(*order)
    found = _matches(catalog, targets).withColumn("_rank", F.row_number().over(first))

    def text(name: str, source: str) -> Column:
        # an absent value shows as "nan", as the catalog's empty cells always have
        return F.coalesce(F.col(source).cast("string"), F.lit("nan")).alias(name)

    return (
        found.where("_rank = 1")
        .select(
            "target",
            text("feed_id", "mdb_source_id"),
            text("provider", "provider"),
            text("country_code", "country_code"),
            text("subdivision", "subdivision_name"),
            text("municipality", "municipality"),
            text("download_url", "direct_download"),
            text("license_url", "license"),
            text("status", "status"),
            "category",
            "selected_reason",
        )
        .orderBy("target")
    )


def unmatched_targets(catalog: DataFrame, targets: DataFrame) -> DataFrame:
    """Targets without any catalog entry."""
    found = _matches(catalog, targets).select("target").distinct()
    return targets.join(found, "target", "left_anti")


def catalog_totals(catalog: DataFrame) -> DataFrame:
    return catalog.agg(
        F.count(F.lit(1)).alias("total_feeds"),
        F.count_distinct("country_code").alias("countries"),
        F.count_distinct("provider").alias("unique_providers"),
    )


def value_counts(catalog: DataFrame, column: str) -> DataFrame:
    """Feeds per value of a column such as ``status``, the most frequent first."""
    return (
        catalog.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("feeds"))
        .orderBy(F.desc("feeds"), column)
    )


def top_countries(catalog: DataFrame, n: int = 20) -> DataFrame:
    """The countries with the most feeds; equal counts go by country code."""
    return value_counts(catalog, "country_code").limit(n)


def catalog_stats(catalog: DataFrame, n: int = 20) -> DataFrame:
    """One row: totals and the top countries as a list."""
    top = top_countries(catalog, n).agg(
        F.array_sort(
            F.collect_list(F.struct((-F.col("feeds")).alias("order"), "country_code", "feeds"))
        ).alias("top")
    )
    listed = F.transform("top", lambda x: F.struct(x["country_code"], x["feeds"]))
    return beside(catalog_totals(catalog), top).withColumn("top_countries", listed).drop("top")
