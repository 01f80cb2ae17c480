"""Topics: business categories by ordered prefixes, and rows from classifier answers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The first prefix that a topic starts with decides, in this order.
RULES = (
    ("/Arts & Entertainment/Events & Listings/Expos & Conventions", "Conventions & Expos"), ("/Arts & Entertainment/Events & Listings/", "Events"),
    ("/Arts & Entertainment/", "Arts & Entertainment"), ("/Autos & Vehicles/", "Transportation"), ("/Beauty & Fitness/", "Retail"),
    ("/Books & Literature/Book Retailers", "Retail"), ("/Books & Literature/", "Arts & Entertainment"),
    ("/Business & Industrial/Business Services/Corporate Events", "Events"), ("/Business & Industrial/", "Business & Professional"),
    ("/Finance/", "Logistics & Planning"), ("/Food & Drink/", "Food & Beverage"), ("/Hobbies & Leisure/Outdoors/", "Outdoor Recreation"),
    ("/Hobbies & Leisure/Paintball", "Outdoor Recreation"), ("/Hobbies & Leisure/Recreational Aviation", "Outdoor Recreation"),
    ("/Hobbies & Leisure/Water Activities/", "Outdoor Recreation"), ("/Hobbies & Leisure/Special Occasions/", "Events"), ("/Hobbies & Leisure/", "Attractions"),
    ("/Jobs & Education/Education/Study Abroad", "Logistics & Planning"), ("/Jobs & Education/Education/", "Education"), ("/Jobs & Education/", "Business & Professional"),
    ("/News/Sports News", "Sports"), ("/News/", "Logistics & Planning"), ("/Real Estate/", "Accommodations"), ("/Reference/Geographic Reference/Other", "Attractions"),
    ("/Reference/Humanities/", "Education"), ("/Reference/Libraries & Museums/", "Attractions"), ("/Reference/", "Logistics & Planning"), ("/Science/", "Education"),
    ("/Shopping/", "Retail"), ("/Sports/", "Sports"), ("/Travel/Air Travel", "Transportation"), ("/Travel/Bus & Rail", "Transportation"),
    ("/Travel/Car Rental & Taxi Services", "Transportation"), ("/Travel/Cruises & Charters", "Attractions"), ("/Travel/Hotels & Accommodations", "Accommodations"),
    ("/Travel/Tourist Destinations/Beaches & Islands", "Outdoor Recreation"), ("/Travel/Tourist Destinations/Mountain & Ski Resorts", "Outdoor Recreation"),
    ("/Travel/Tourist Destinations/Regional Parks & Gardens", "Outdoor Recreation"), ("/Travel/Tourist Destinations/Theme Parks", "Attractions"),
    ("/Travel/Tourist Destinations/Zoos-Aquariums-Preserves", "Attractions"), ("/Travel/Tourist Destinations", "Attractions"), ("/Travel", "Logistics & Planning"),
    ("/Travel & Transportation/Hotels & Accommodations", "Accommodations"), ("/Travel & Transportation/Luggage & Travel Accessories", "Retail"),
    ("/Travel & Transportation/Specialty Travel/Adventure Travel", "Attractions"), ("/Travel & Transportation/Specialty Travel/Business Travel", "Business & Professional"),
    ("/Travel & Transportation/Specialty Travel/Honeymoons & Romantic Getaways", "Accommodations"), ("/Travel & Transportation/Specialty Travel/Low Cost & Last Minute Travel", "Accommodations"),
    ("/Travel & Transportation/Specialty Travel/Luxury Travel", "Accommodations"), ("/Travel & Transportation/Specialty Travel/", "Attractions"),
    ("/Travel & Transportation/Tourist Destinations/Beaches & Islands", "Outdoor Recreation"), ("/Travel & Transportation/Tourist Destinations/Mountain & Ski Resorts", "Outdoor Recreation"),
    ("/Travel & Transportation/Tourist Destinations/Regional Parks & Gardens", "Outdoor Recreation"), ("/Travel & Transportation/Tourist Destinations/", "Attractions"),
    ("/Travel & Transportation/Transportation", "Transportation"), ("/Travel & Transportation/Travel Agencies & Services/", "Logistics & Planning"),
    ("/Travel & Transportation/Travel Guides & Travelogues", "Logistics & Planning"), ("/Travel & Transportation/", "Logistics & Planning"),
)
OTHER, HOME = "Miscellaneous", "Navigation & Home Page"
REVIEW_BELOW, LEAST_WORDS = 0.6, 20


def map_topic(topic: Column, longest_prefix: bool = False) -> Column:
    """The label of the first rule whose prefix starts the topic; of the longest such prefix, if asked."""
    rules = sorted(RULES, key=lambda r: -len(r[0])) if longest_prefix else RULES
    return F.coalesce(*(F.when(topic.startswith(p), F.lit(label)) for p, label in rules), F.lit(OTHER))


def rules(spark: SparkSession) -> DataFrame:
    """The rules as rows: ordinal, prefix, label."""
    return spark.createDataFrame([(i, p, label) for i, (p, label) in enumerate(RULES)], "ordinal int, prefix string, label string")


def render(categories: Column) -> Column:
    """Categories as text: name=confidence, joined by "; "."""
    return F.array_join(F.transform(categories, lambda c: F.concat(c["name"], F.lit("="), F.format_string("%.2f", c["confidence"]))), "; ")


def view_count(hits: Column) -> Column:
    return F.greatest(F.coalesce(hits.try_cast("bigint"), F.lit(1).cast("bigint")), F.lit(1).cast("bigint"))
