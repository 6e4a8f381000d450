"""The US state seed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

SCHEMA = "state_code string, state_name string"

# Postal codes and names of states, the federal district and territories.
US_STATES = """
AL,Alabama
AK,Alaska
AZ,Arizona
AR,Arkansas
CA,California
CO,Colorado
CT,Connecticut
DE,Delaware
FL,Florida
GA,Georgia
HI,Hawaii
ID,Idaho
IL,Illinois
IN,Indiana
IA,Iowa
KS,Kansas
KY,Kentucky
LA,Louisiana
ME,Maine
MD,Maryland
MA,Massachusetts
MI,Michigan
MN,Minnesota
MS,Mississippi
MO,Missouri
MT,Montana
NE,Nebraska
NV,Nevada
NH,New Hampshire
NJ,New Jersey
NM,New Mexico
NY,New York
NC,North Carolina
ND,North Dakota
OH,Ohio
OK,Oklahoma
OR,Oregon
PA,Pennsylvania
RI,Rhode Island
SC,South Carolina
SD,South Dakota
TN,Tennessee
TX,Texas
UT,Utah
VT,Vermont
VA,Virginia
WA,Washington
WV,West Virginia
WI,Wisconsin
WY,Wyoming
DC,District of Columbia
AS,American Samoa
GU,Guam
MP,Northern Mariana Islands
PR,Puerto Rico
VI,U.S. Virgin Islands
"""


def read_seed(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("header", True).schema(SCHEMA).csv(path)


def us_states(spark: SparkSession) -> DataFrame:
    rows = [tuple(line.split(",", 1)) for line in US_STATES.strip().splitlines()]
    return spark.createDataFrame(rows, SCHEMA)
