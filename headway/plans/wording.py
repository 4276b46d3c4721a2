"""The wording of all generated questions and answers.

A text is a list of parts that are put together. A part is a pattern, or a condition
(SQL) with the pattern used where it holds. Names in braces are columns of the view the
text is made from, see ``headway.plans.views``.
"""

from __future__ import annotations

from headway.plans.templates import Template

AGENCY_OVERVIEW = [
    Template(
        "agency_overview", "agency_modes_v1", "agency",
        guard="agency_name <> '' and modes <> ''",
        instruction="What transit modes does {agency_name} operate?",
        response=[
            "{agency_name} operates the following transit services: {modes}."
            " In total, the agency has {total_routes} routes."
        ],
    ),
    Template(
        "agency_overview", "agency_modes_v2", "agency",
        guard="agency_name <> '' and modes <> ''",
        instruction="Describe the types of transit services provided by {agency_name}.",
        response=["{agency_name} provides the following transit services: {modes}."],
    ),
    Template(
        "agency_overview", "agency_route_count_v1", "agency",
        guard="agency_name <> '' and total_routes > 0",
        instruction="How many routes does {agency_name} have?",
        response=["{agency_name} operates {total_routes} routes. {breakdown}."],
    ),
    Template(
        "agency_overview", "agency_route_count_v2", "agency",
        guard="agency_name <> '' and total_routes > 0",
        instruction="Tell me about the size of {agency_name}'s transit network.",
        response=[
            "{agency_name} operates a transit network with {total_routes} routes,"
            " {total_stops} stops, and approximately {total_trips:,} scheduled trips."
        ],
    ),
    Template(
        "agency_overview", "agency_timezone", "agency",
        guard="agency_name <> '' and agency_timezone <> ''",
        instruction="What timezone does {agency_name} operate in?",
        response=["{agency_name} operates in the {agency_timezone} timezone."],
    ),
]

ROUTE_INFO = [
    Template(
        "route_info", "route_describe_v1", "route",
        guard="name <> ''",
        instruction="Describe route {name} operated by {provider}.",
        response=[
            "Route {full_name} is a {mode} service operated by {provider}.",
            ("trip_count > 0", " It runs approximately {trip_count:,} trips."),
            ("stop_count > 0", " The route serves {stop_count} stops."),
            ("destinations <> ''", " Destinations include: {destinations}."),
        ],
    ),
    Template(
        "route_info", "route_describe_v2", "route",
        guard="name <> ''",
        instruction="What type of service is route {name} by {provider}?",
        response=[
            "Route {name} by {provider} is a {mode} service.",
            ("route_long_name <> ''", " Its full name is '{route_long_name}'."),
        ],
    ),
]

SCHEDULE = [
    Template(
        "schedule", "route_trip_count", "route",
        guard="name <> '' and trip_count > 0",
        instruction="How many trips run on route {name} by {provider}?",
        response=[
            "Route {name} operated by {provider} has approximately {trip_count:,}"
            " scheduled trips."
        ],
    ),
    Template(
        "schedule", "route_schedule_v1", "route",
        guard="name <> '' and first_departure <> '' and last_departure <> ''",
        instruction="What are the first and last departure times for route {name} by {provider}?",
        response=[
            "Route {name} by {provider} has its first departure at {first_shown}"
            " and its last departure at {last_shown}."
        ],
    ),
    Template(
        "schedule", "route_schedule_v2", "route",
        guard="name <> '' and trip_count > 0",
        instruction="Give me a schedule overview of route {name} by {provider}.",
        response=[
            "Route {name} by {provider} runs {trip_count:,} trips serving {stop_count} stops.",
            (
                "first_departure <> '' and last_departure <> ''",
                " Service starts at {first_shown} and ends at {last_shown}.",
            ),
        ],
    ),
]

ROUTE_LIST = [
    Template(
        "route_info", "route_list_by_type", "route_type",
        guard="n > 0",
        instruction="List all {mode:lower} routes operated by {provider}.",
        response=[
            "{provider} operates {n} {mode:lower} routes: {names}",
            ("more <= 0", "."),
            ("more > 0", ", and {more} more."),
        ],
    ),
]

STOP_LOCATION = [
    Template(
        "stop_info", "stop_location_v1", "stop",
        guard="stop_name <> '' and stop_lat <> 0 and stop_lon <> 0",
        instruction="Where is the {stop_name} stop located in the {provider} network?",
        response=[
            "The {stop_name} stop is located at latitude {stop_lat:.4f}, longitude"
            " {stop_lon:.4f} in the {provider} transit network."
        ],
    ),
    Template(
        "stop_info", "stop_location_v2", "stop",
        guard="stop_name <> '' and stop_lat <> 0 and stop_lon <> 0",
        instruction="What are the coordinates of {stop_name}?",
        response=["{stop_name} is located at coordinates ({stop_lat:.4f}, {stop_lon:.4f})."],
    ),
]

STOP_COUNT = [
    Template(
        "stop_info", "stop_count", "feed",
        guard="provider <> '' and total_stops > 0",
        instruction="How many stops are in the {provider} network?",
        response=[
            "The {provider} network has {total_stops:,} stops.",
            (
                "station_count > 0",
                " Of these, {station_count} are classified as stations (parent stops).",
            ),
        ],
    ),
]

TRANSFER_INFO = [
    Template(
        "transfer", "transfer_info", "transfer",
        guard="from_stop_name <> '' and to_stop_name <> ''",
        instruction="What is the transfer between {from_stop_name} and {to_stop_name} in the"
        " {provider} system?",
        response=[
            "There is {kind} between {from_stop_name} and {to_stop_name} in the {provider}"
            " network.",
            (
                "min_transfer_time > 0",
                " The minimum transfer time is {min_transfer_time} seconds ({minutes} minutes).",
            ),
        ],
    ),
]

TRANSFER_COUNT = [
    Template(
        "transfer", "transfer_count", "feed",
        guard="provider <> '' and total_transfers > 0",
        instruction="How many transfer points does {provider} have?",
        response=[
            "{provider} has {total_transfers:,} defined transfer connections in its network."
        ],
    ),
]

NETWORK_STATS = [
    Template(
        "network_stats", "network_overview_v1", "feed",
        guard="provider <> ''",
        instruction="Give me an overview of the {provider} transit network.",
        response=[
            "The {provider} transit network consists of {total_routes} routes serving"
            " {total_stops:,} stops. There are approximately {total_trips:,} scheduled trips."
            " On average, each route serves about {avg_stops} stops and runs"
            " {avg_trips_per_route:.0f} trips."
        ],
    ),
    Template(
        "network_stats", "network_overview_v2", "feed",
        guard="provider <> ''",
        instruction="How large is the {provider} transit system?",
        response=[
            "{provider} ({country_code}) operates {total_routes} routes with {total_stops:,}"
            " stops across its network."
        ],
    ),
]

KEY_STATISTICS = [
    Template(
        "network_stats", "key_network_stats", "feed",
        guard="provider <> ''",
        instruction="What are the key network statistics for {provider}?",
        response=[
            "{provider} operates {total_routes} routes serving {total_stops:,} stops with"
            " {total_trips:,} scheduled trips. On average, each route serves {avg_stops}"
            " stops and runs {avg_trips_per_route:.0f} trips."
        ],
    ),
]

JOURNEY_PLANNING = [
    Template(
        "journey_planning", "transfer_availability", "journey",
        guard="has_transfer",
        instruction="Can I transfer between {from_stop_name} and {to_stop_name} in the"
        " {provider} network?",
        response=[
            "Yes, there is a transfer connection between {from_stop_name} and {to_stop_name}"
            " in the {provider} network.",
            (
                "min_transfer_time <> 0",
                " The minimum transfer time is {min_transfer_time} seconds ({minutes} minutes).",
            ),
            (
                "coalesce(min_transfer_time, 0) = 0",
                " This is a recommended transfer point.",
            ),
        ],
    ),
    Template(
        "journey_planning", "earliest_service", "journey",
        guard="early_departure is not null",
        instruction="What is the earliest service available on {provider}?",
        response=[
            "Route {early_name} has one of the earliest departures at {early_departure}, making"
            " it available for early morning commuters."
        ],
    ),
    Template(
        "journey_planning", "late_night_service", "journey",
        guard="late_departure is not null",
        instruction="Does {provider} offer late-night service?",
        response=[
            "Yes, route {late_name} runs until {late_departure}, providing late-night service."
        ],
    ),
    Template(
        "journey_planning", "multimodal_journey", "journey",
        guard="size(by_type) > 1",
        instruction="Can I combine different transit modes on {provider}?",
        response=[
            "Yes, {provider} operates multiple transit modes: {mode_names}. You can combine"
            " these modes in a single journey by transferring between them at connection"
            " points."
        ],
    ),
    Template(
        "journey_planning", "weekend_availability", "journey",
        guard="weekend_services > 0",
        instruction="Is weekend service available on {provider}?",
        response=[
            "Yes, {provider} defines {weekend_services} weekend service patterns (compared to"
            " {weekday_services} weekday patterns). Weekend service is typically reduced"
            " compared to weekdays."
        ],
    ),
    Template(
        "journey_planning", "most_frequent_route", "journey",
        guard="scheduled > 1",
        instruction="What is the most frequent route on {provider}?",
        response=[
            "Route {busiest_name} is the most frequent with {busiest_trips:,} scheduled trips,"
            " making it one of the best options for minimizing wait times."
        ],
    ),
]

MOST_ROUTES = Template(
    "comparative", "most_routes", "ranking",
    guard="true",
    instruction="Which transit agency in the dataset has the most routes?",
    response=[
        "{provider} ({country_code}) has the most routes with {total} routes. The top 5 by"
        " route count are: {top}."
    ],
)
MOST_STOPS = Template(
    "comparative", "most_stops", "ranking",
    guard="true",
    instruction="Which transit network has the most stops?",
    response=[
        "{provider} ({country_code}) has the most stops with {total:,}. The top 5 by stop"
        " count are: {top}."
    ],
)
RANKED_ENTRY = {"most_routes": "{provider} ({total})", "most_stops": "{provider} ({total:,})"}

COMPARE_PAIR = Template(
    "comparative", "compare_pair", "feed_pair",
    guard="true",
    instruction="Compare the transit networks of {a_provider} and {b_provider}.",
    response=[
        "{a_provider} ({a_country_code}) has {a_total_routes} routes and {a_total_stops:,} stops."
        " {b_provider} ({b_country_code}) has {b_total_routes} routes and {b_total_stops:,}"
        " stops. ",
        ("a_total_routes > b_total_routes", "The former"),
        ("a_total_routes <= b_total_routes", "The latter"),
        " has more routes, while ",
        ("a_total_stops > b_total_stops", "the former"),
        ("a_total_stops <= b_total_stops", "the latter"),
        " has more stops.",
    ],
)
MULTIMODAL = Template(
    "comparative", "multimodal_agencies", "multimodal",
    guard="names <> ''",
    instruction="Which transit agencies operate multiple transit modes?",
    response=[
        "The following agencies operate multiple transit modes: {names}. Multi-modal agencies"
        " provide a combination of services such as bus, subway, tram, rail, and ferry."
    ],
)
MULTIMODAL_ENTRY = "{provider} ({modes} modes)"

COUNTRIES = Template(
    "comparative", "countries", "countries",
    guard="n > 0",
    instruction="What countries are represented in the transit dataset?",
    response=["The dataset covers transit agencies from {n} countries: {listed}."],
)
COUNTRY_ENTRY = "{country_code}: {providers}"

SIZE_COMPARISON = Template(
    "comparative", "size_comparison_expanded", "feed_pair",
    guard="true",
    instruction="Compare the size of {a_provider} and {b_provider} transit networks.",
    response=[
        "{a_provider} ({a_country_code}) has {a_total_routes} routes, {a_total_stops:,} stops,"
        " and {a_total_trips:,} trips. {b_provider} ({b_country_code}) has {b_total_routes}"
        " routes, {b_total_stops:,} stops, and {b_total_trips:,} trips. ",
        ("a_total_routes > b_total_routes", "The former"),
        ("a_total_routes <= b_total_routes", "The latter"),
        " has more routes.",
    ],
)
MOST_TRIPS = Template(
    "comparative", "most_trips", "extremes",
    guard="true",
    instruction="Which transit agency has the most scheduled trips?",
    response=[
        "{provider} ({country_code}) has the most scheduled trips with {total:,}. The fewest is"
        " {last_provider} with {last_total:,} trips."
    ],
)
MOST_DIVERSE = Template(
    "comparative", "most_diverse_modes", "diverse",
    guard="true",
    instruction="Which transit agency offers the most diverse range of transit modes?",
    response=[
        "{provider} ({country_code}) offers the most diverse transit with {modes} different"
        " modes: {mode_names}."
    ],
)

# entries of the lists of modes inside the texts
MODE_COUNT_ENTRY = "{count} {mode}"
BREAKDOWN_ENTRY = "{count} are {mode} routes"
UNKNOWN_MODE = "type {code}"
NO_MODE = "transit"

ROUTE_ANALYSIS = [
    Template(
        "route_analysis", "easy", "network",
        guard="true",
        instruction="How many transit routes does {provider} operate?",
        response=["{provider} operates {total_routes} routes."],
        criteria="Must state {total_routes} routes",
    ),
    Template(
        "route_analysis", "easy", "network",
        guard="mode_counts <> ''",
        instruction="What types of transit services does {provider} offer?",
        response=["{provider} offers: {mode_counts}."],
        criteria="Must mention the transit modes and approximate counts",
    ),
    Template(
        "route_analysis", "medium", "network",
        guard="described_name <> ''",
        instruction="Describe route {described_name} operated by {provider}.",
        response=[
            "Route {described_name} is a {described_mode} service by {provider} with"
            " approximately {described_trips:,} trips serving {described_stops} stops."
        ],
        criteria="Must mention route type ({described_mode}), trip count (~{described_trips}),"
        " and stop count (~{described_stops})",
    ),
    Template(
        "route_analysis", "medium", "network",
        guard="busiest_trips is not null",
        instruction="Which route in the {provider} network has the most scheduled trips?",
        response=[
            "Route {busiest_name} has the most trips with approximately {busiest_trips:,}"
            " scheduled trips."
        ],
        criteria="Must identify route {busiest_name} with ~{busiest_trips} trips",
    ),
    Template(
        "route_analysis", "medium", "network",
        guard="widest_stops is not null",
        instruction="Which route in the {provider} network serves the most stops?",
        response=["Route {widest_name} serves the most stops with {widest_stops} stops."],
        criteria="Must identify route {widest_name} with {widest_stops} stops",
    ),
]

SCHEDULE_REASONING = [
    Template(
        "schedule_reasoning", "easy", "timetable",
        guard="true",
        instruction="What are the operating hours for route {name} by {provider}?",
        response=[
            "Route {name} by {provider} starts service at {first_shown} and ends at"
            " {last_shown}."
        ],
        criteria="Must mention first departure ~{first_departure} and last departure"
        " ~{last_departure}",
    ),
    Template(
        "schedule_reasoning", "medium", "timetable",
        guard="headway is not null",
        instruction="Route {name} by {provider} runs {trip_count:,} trips over approximately"
        " {span_hours} hours. Estimate the average frequency.",
        response=[
            "With {trip_count:,} trips over ~{span_hours} hours ({span} minutes), the average"
            " headway is approximately {headway:.1f} minutes between trips."
        ],
        criteria="Must calculate approximately {headway:.0f} minutes between trips",
    ),
    Template(
        "schedule_reasoning", "medium", "timetable",
        guard="weekday_services > 0 and range_start is not null",
        instruction="How many service patterns does {provider} define for weekdays vs weekends?",
        response=[
            "{provider} defines {weekday_services} weekday service patterns and"
            " {weekend_services} weekend service patterns. The schedule covers the date range"
            " {range_start} to {range_end}."
        ],
        criteria="Must mention {weekday_services} weekday and {weekend_services} weekend"
        " patterns",
    ),
]

NETWORK_SIZE = [
    Template(
        "transit_operations", "easy", "feed",
        guard="provider <> '' and total_stops > 0",
        instruction="How large is the {provider} transit network in terms of stops and routes?",
        response=["The {provider} network has {total_stops:,} stops and {total_routes} routes."],
        criteria="Must state approximately {total_stops:,} stops and {total_routes} routes",
    ),
]

# the text handed to a model together with a question about one feed
CONTEXT_AGENCY = "Agency: {agency_name} (timezone: {agency_timezone})"
CONTEXT_ROUTES = "Total routes: {total_routes}"
CONTEXT_TYPES = "Route types: {mode_counts}"
CONTEXT_DETAILS = "Route details:\n{lines}"
CONTEXT_ROUTE = (
    "  Route {name}: {mode}, {trip_count} trips, {stop_count} stops,"
    " {first_departure}-{last_departure}"
)
CONTEXT_STOPS = "Total stops: {total_stops}"
CONTEXT_SERVICES = (
    "Weekday services: {weekday_services}, Weekend services: {weekend_services}"
)
CONTEXT_RANGE = "Service date range: {range_start} to {range_end}"
CONTEXT_TRANSFERS = "Transfer connections: {total_transfers}"
CONTEXT_NETWORK = (
    "Network: {total_trips} total trips, avg {avg_stops} stops/route, avg {avg_trips}"
    " trips/route"
)
NAMELESS_ROUTE = "?"
UNSHOWN_MODE = "unknown"
PROMPT = (
    "I have uploaded a GTFS feed. Here is the feed data:\n\n{context}\n\n"
    "Based on this feed data, answer the following question:\n{question}"
)
