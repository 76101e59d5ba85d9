"""Pairs of streets whose verdict is known, as a query whose SQL states the verdicts."""

from __future__ import annotations

from pyspark.sql import functions as F

from factloom.functions import streets
from factloom.plans.registry import query

# Spellings of one street, streets that are not the same, and the same with the parcel known.
SAME = [
    ("Commercial Circle", "Commercial Cir"), ("E. First St.", "E 1st St"), ("SW 252 Street", "SW 252nd St"), ("Ninth Avenue", "9th Ave E"),
    ("Saint Johns Road", "St Johns Rd"), ("E. Fort Wayne Rd", "Ft Wayne Rd"), ("Highway 231", "US-231"), ("N Hwy 231", "US-231"),
    ("Route 522", "US-522"), ("SR 17 N", "State Rte 17 N"), ("US Hwy 221 South", "US-221 S"), ("S Highway 319", "U S Hwy 319 S"),
    ("GA Highway 3", "GA Hwy 3"), ("cr 31", "County Rd 31"), ("C R # 3 South", "County Rd 3"), ("I-45 South", "I-45"), ("East I 20", "E I-20"),
    ("Route 442 Highway", "State Rte 442"), ("NW US Highway 24", "NW US-24 Hwy"), ("Old U.S. Highway 54", "Old United States Highway 54"),
    ("Old 421 Road", "Old 421st Rd"), ("120 Fairview", "Fairview St"), ("Clarcona", "Clarcona Rd"), ("Airport Road", "S Airport Rd"),
    ("Gees Mill Road", "Gees Mill Rd NE"), ("NW 32 Ave Bay B", "NW 32nd Ave"), ("Space Blvd Lot#104", "Space Blvd"), ("D N.W. 16 Terrace", "NW 16th Ter"),
    ("E. 27th St. Terrace", "E 27th Ter"), ("Clary Connector", "Clary Conn"), ("Park Place", "Park Pl"), ("Industrial Park Place", "Industrial Park Pl"),
    ("Delany RD", "Delaney Rd"), ("Satrun Blvd", "Saturn Blvd"), ("Etheridge Rd", "Ethridge Rd"), ("Palm Cove", "Palm Cv"), ("Oak Ridge", "Oak Rdg"),
]
DIFFERENT = [
    ("Alamo Dr", "Alamo Rd"), ("Eisenhower Dr.", "Eisenhower Rd"), ("Austin Street", "Austin Dr"), ("Oak St", "Oak Ave"),
    ("SW Silver Springs Blvd.", "W Silver Springs Blvd"), ("N Main St", "S Main St"), ("GA Highway 3", "US-19"), ("Highway 11W", "Appalachian Hwy"),
    ("Hwy. 17 N.", "Jones St"), ("Main St", "Maine St"), ("Jones St", "Jonas St"), ("New Tamap Highway", "New Tampa Hwy"),
    ("Anthony Grove CH Rd.", "Anthony Grove Rd"), ("Main St", ""), ("Jones Rd", "Jonas Rd"), ("Delaney Rd", "Delany Ave"),
]
PARCEL_SAME = [
    ("Alamo Dr", "Alamo Rd"), ("Eisenhower Dr.", "Eisenhower Rd"), ("PALM AVE", "Palm St"), ("INDUSTRIAL RD", "E Industrial Dr"),
    ("Imperial Loop Drive", "Imperial Loop"), ("McNaughton Street", "Mc Naughton Ave"), ("W SAM HOUSTON PARKWAY N STE 500", "W Sam Houston Pkwy"),
    ("Martin Luther King Ave", "Martin Luther King Jr Ave"), ("FM-2100", "Farm To Market Rd 2100th Rd"), ("US HWY 6", "US-Rte 6"),
]
PARCEL_DIFFERENT = [
    ("SOUTH LAKE STREET", "N Lake St"), ("NORTH HERITAGE ROAD", "S Heritage Rd"), ("Iris Drive SW", "Iris Dr SE"),
    ("SW Silver Springs Blvd.", "W Silver Springs Blvd"), ("New Tamap Highway", "New Tampa Hwy"), ("Delany Rd", "Delaney Ave"), ("GA Highway 3", "US-19"),
]


_ALL = [(a, b, parcel, same) for pairs, parcel, same in ((SAME, False, True), (DIFFERENT, False, False), (PARCEL_SAME, True, True), (PARCEL_DIFFERENT, True, False)) for a, b in pairs]


@query("street_pairs", f"select * from (values {', '.join(f'({a!r}, {b!r}, {parcel}, {same})' for a, b, parcel, same in _ALL)}) as t(a, b, parcel, same)")
def street_pairs(spark, sf):
    rows = spark.createDataFrame([x[:3] for x in _ALL], "a string, b string, parcel boolean")
    rule = F.when(F.col("parcel"), streets.parcel_rule("a", "b")).otherwise(streets.street_rule("a", "b"))
    return rows.select("a", "b", "parcel", (~rule.startswith("!")).alias("same"))
