"""Integration of consumption, population, category and district sources into mean yearly consumption."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions.text import ADDRESS_PARTS, expand_column
from plumbline.operators.contains import contains_join
from plumbline.sources.unions import union_frames

DAYS = 365

# How Paris addresses are brought to the form of ADDRESS_PARTS.
PARIS_REPLACEMENTS = ((r"^Paris,\s*", "Paris, 75000, "), ("(?i)rue", ""))


def yearly_mean(df: DataFrame, keys: list[str], daily: str, name: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.avg(F.col(daily) * DAYS).alias(name))


def city_of(postcode: Column, low: int, high: int, city: str) -> Column:
    """`city` for postcodes in [low, high], else the postcode as text."""
    return F.when(postcode.between(low, high), F.lit(city)).otherwise(postcode.cast("string"))


def consumption_by_district_paris(consumption: DataFrame, districts: DataFrame) -> DataFrame:
    """Mean yearly consumption per district, joined on street and city."""
    placed = consumption.withColumn(
        "ID_Ville", city_of(F.col("Code_Postal"), 75000, 75999, "Paris")
    )
    joined = placed.join(districts.withColumnRenamed("ID_Rue", "Nom_Rue"), ["Nom_Rue", "ID_Ville"])
    return yearly_mean(joined, ["ID_Iris"], "NB_KW_Jour", "Conso_moyenne_annuelle")


def consumption_by_district_evry(consumption: DataFrame, districts: DataFrame) -> DataFrame:
    """As above, but the district's street only has to occur in the street name."""
    joined = contains_join(consumption, districts, "Nom_Rue", "ID_Rue", included="right", how="inner")
    return yearly_mean(joined, ["ID_Iris"], "NB_KW_Jour", "Conso_moyenne_annuelle")


def consumption_by_category(
    population_1: DataFrame,
    consumption_1: DataFrame,
    population_2: DataFrame,
    consumption_2: DataFrame,
    categories: DataFrame,
    how: str = "left",
) -> DataFrame:
    """Mean yearly consumption per social category, over a text-coded and a number-coded source.

    `how="left"` keeps people whose category text matches no description under a null category.
    """
    wanted = ["ID_CSP", "Salaire_Moyen", "NB_KW_Jour"]
    at_home_1 = expand_column(
        population_1, "Adresse", ADDRESS_PARTS[:-1], PARIS_REPLACEMENTS, types={"N": "bigint"}
    ).join(consumption_1.select("N", "Nom_Rue", "NB_KW_Jour"), ["N", "Nom_Rue"])
    branch_1 = contains_join(
        at_home_1.select("CSP", "NB_KW_Jour"),
        categories.select("ID_CSP", "Desc", "Salaire_Moyen"),
        "CSP", "Desc", how=how,
    ).select(*wanted)

    at_home_2 = expand_column(population_2, "Adresse", ADDRESS_PARTS, types={"N": "bigint"}).join(
        consumption_2.select("N", "Nom_Rue", "Code_Postal", "NB_KW_Jour"),
        ["N", "Nom_Rue", "Code_Postal"],
    )
    branch_2 = at_home_2.withColumnRenamed("CSP", "ID_CSP").join(
        categories.select("ID_CSP", "Salaire_Moyen"), "ID_CSP"
    ).select(*wanted)
    both = union_frames([branch_1, branch_2], "vertical_relaxed")
    return yearly_mean(both, ["ID_CSP", "Salaire_Moyen"], "NB_KW_Jour", "Conso_moyenne_annuelle")
