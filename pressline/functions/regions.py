"""Region names and the country each belongs to."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Regions by country, with the abbreviations that papers print.
REGIONS = {
    "United States": [
        "Alabama", "AL", "Ala", "Alaska", "AK", "Arizona", "AZ", "Ariz", "Arkansas", "AR", "Ark", "California", "CA", "Calif", "Cal",
        "Colorado", "CO", "Colo", "Connecticut", "CT", "Conn", "Delaware", "DE", "Del", "Florida", "FL", "Fla", "Georgia", "GA",
        "Hawaii", "HI", "Idaho", "ID", "Illinois", "IL", "Ill", "Indiana", "IN", "Ind", "Iowa", "IA", "Kansas", "KS", "Kan", "Kans",
        "Kentucky", "KY", "Ken", "Louisiana", "LA", "Maine", "ME", "Maryland", "MD", "Massachusetts", "MA", "Mass", "Michigan", "MI", "Mich",
        "Minnesota", "MN", "Minn", "Mississippi", "MS", "Miss", "Missouri", "MO", "Montana", "MT", "Mont", "Nebraska", "NE", "Neb", "Nebr",
        "Nevada", "NV", "Nev", "New Hampshire", "NH", "New Jersey", "NJ", "New Mexico", "NM", "New York", "NY", "North Carolina", "NC",
        "North Dakota", "ND", "Ohio", "OH", "Oklahoma", "OK", "Okla", "Oregon", "OR", "Ore", "Oreg", "Pennsylvania", "PA", "Penn",
        "Rhode Island", "RI", "South Carolina", "SC", "South Dakota", "SD", "Tennessee", "TN", "Tenn", "Texas", "TX", "Tex", "Utah", "UT",
        "Vermont", "VT", "Virginia", "VA", "Washington", "WA", "Wash", "West Virginia", "WV", "WVa", "Wisconsin", "WI", "Wis", "Wisc",
        "Wyoming", "WY", "Wyo", "District of Columbia", "DC",
    ],
    "United Kingdom": ["England", "Scotland", "Wales", "Northern Ireland", "Great Britain"],
    "Canada": [
        "Alberta", "AB", "Alta", "British Columbia", "BC", "Manitoba", "MB", "Man", "New Brunswick", "NB",
        "Newfoundland", "Newfoundland and Labrador", "NL", "Nfld", "Nova Scotia", "NS", "Ontario", "ON", "Ont",
        "Prince Edward Island", "PE", "PEI", "Quebec", "QC", "Que", "Saskatchewan", "SK", "Sask",
        "Northwest Territories", "NT", "NWT", "Nunavut", "NU", "Yukon", "YT",
    ],
}


def region_key(region: Column) -> Column:
    """J7. ASCII letters in upper case."""
    return F.upper(F.regexp_replace(F.coalesce(region, F.lit("")), "[^A-Za-z]", ""))


def region_table(spark: SparkSession, regions: dict[str, list[str]] | None = None) -> DataFrame:
    """S15. (region_key, country); a key that several countries claim has a null country.

    Names that start with _ are comments."""
    rows = [(country, region) for country, names in (regions or REGIONS).items() if not country.startswith("_") and isinstance(names, list) for region in names]
    table = spark.createDataFrame(rows, "country string, region string").withColumn("region_key", region_key(F.col("region")))
    return table.where("region_key <> ''").groupBy("region_key").agg(F.when(F.count_distinct("country") == 1, F.min("country")).alias("country"))


def with_country(df: DataFrame, region_col: str = "province", country_col: str = "country", regions: DataFrame | None = None) -> DataFrame:
    """J7. df with the country of region_col; null where no or several countries claim it.

    The region table has one row per region name, some 160: it is broadcast."""
    regions = regions if regions is not None else region_table(df.sparkSession)
    found = regions.select(F.col("region_key").alias("__key"), F.col("country").alias("__country"))
    joined = df.drop(country_col).join(F.broadcast(found), region_key(F.col(region_col)) == F.col("__key"), "left")
    return joined.withColumn(country_col, F.col("__country")).drop("__key", "__country")
