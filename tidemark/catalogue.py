"""The measured attributes: a static table for the warehouse and the alias lookup of a catalogue table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Warehouse attributes and their canonical unit (the unit that measurements are stored in).
CANONICAL_UNITS = {
    "salinity": "psu",
    "turbidity": "NTU",
    "suspended_particulate_matter": "mg/L",
    "light_attenuation": "/m",
    "dissolved_oxygen": "mg/L",
    "sediment_oxygen_demand": "mmol O2/m^2/d",
    "pco2": "µatm",
    "dissolved_inorganic_carbon": "µmol/kg",
    "total_alkalinity": "µmol/kg",
    "co2_flux": "mmol/m^2/d",
    "dissolved_organic_carbon": "mg/L",
    "particulate_organic_carbon": "mg/L",
    "net_primary_production": "g C/m^2/d",
    "gross_primary_production": "g C/m^2/d",
    "chlorophyll": "µg/L",
    "nitrate": "µmol/L",
    "ammonium": "µmol/L",
    "total_nitrogen": "µg/L",
    "denitrification": "µmol N/m^2/h",
    "nitrification": "µmol N/m^2/h",
    "nitrogen_fixation": "µmol N/m^2/h",
    "phosphate": "µmol/L",
    "silicate": "µmol/L",
}

#: Spellings that all mean practical salinity.
SALINITY_UNITS = ("psu", "PSU", "ppt", "g/kg", "‰")

#: A catalogue (aliases included) of at most this many spellings is broadcast; a larger one is joined by shuffle.
ALIAS_BROADCAST_ROWS = 100_000


def attribute_key(name: Column) -> Column:
    """An attribute's spelling without letter case, blanks, ``_`` and ``-``; null stays null."""
    return F.regexp_replace(F.lower(name), r"(?U)[\s_-]+", "")


def alias_lookup(catalogue: DataFrame) -> DataFrame:
    """(attribute_key, catalogue columns) with one row per spelling; a spelling shared by two attributes goes to the first."""
    spelled = catalogue.filter("attribute is not null").select(
        F.explode(F.concat(F.array("attribute"), F.coalesce("aliases", F.array().cast("array<string>")))).alias("spelling"),
        F.struct("attribute", "value_kind", "canonical_units").alias("entry"),
    )
    keyed = spelled.withColumn("attribute_key", attribute_key(F.col("spelling"))).filter("attribute_key <> ''")
    return keyed.groupBy("attribute_key").agg(F.min("entry").alias("entry")).select("attribute_key", "entry.*")
