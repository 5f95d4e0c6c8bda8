"""The study of road accidents, their casualties and the vehicles involved.

The three tables are the public British road safety files. Every row of the joined
table is one casualty together with one vehicle of the same accident.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from rowlens.functions.columns import AGE_BOUNDS
from rowlens.plans.accident_codes import LABELS
from rowlens.plans.study import ConditionalFill, Study
from rowlens.sources.files import scan_csv

# Column names and types of the three files; a name without a type is an integer.
ACCIDENTS = """
Accident_Index string
Location_Easting_OSGR
Location_Northing_OSGR
Longitude double
Latitude double
Police_Force
Accident_Severity
Number_of_Vehicles
Number_of_Casualties
Date string
Day_of_Week
Time string
Local_Authority_(District)
Local_Authority_(Highway) string
1st_Road_Class
1st_Road_Number
Road_Type
Speed_limit
Junction_Detail
Junction_Control
2nd_Road_Class
2nd_Road_Number
Pedestrian_Crossing-Human_Control
Pedestrian_Crossing-Physical_Facilities
Light_Conditions
Weather_Conditions
Road_Surface_Conditions
Special_Conditions_at_Site
Carriageway_Hazards
Urban_or_Rural_Area
Did_Police_Officer_Attend_Scene_of_Accident
LSOA_of_Accident_Location string
"""
CASUALTIES = """
Accident_Index string
Vehicle_Reference
Casualty_Reference
Casualty_Class
Sex_of_Casualty
Age_of_Casualty
Age_Band_of_Casualty
Casualty_Severity
Pedestrian_Location
Pedestrian_Movement
Car_Passenger
Bus_or_Coach_Passenger
Pedestrian_Road_Maintenance_Worker
Casualty_Type
Casualty_Home_Area_Type
"""
VEHICLES = """
Accident_Index string
Vehicle_Reference
Vehicle_Type
Towing_and_Articulation
Vehicle_Manoeuvre
Vehicle_Location-Restricted_Lane
Junction_Location
Skidding_and_Overturning
Hit_Object_in_Carriageway
Vehicle_Leaving_Carriageway
Hit_Object_off_Carriageway
1st_Point_of_Impact
Was_Vehicle_Left_Hand_Drive?
Journey_Purpose_of_Driver
Sex_of_Driver
Age_of_Driver
Age_Band_of_Driver
Engine_Capacity_(CC)
Propulsion_Code
Age_of_Vehicle
Driver_IMD_Decile
Driver_Home_Area_Type
"""

# Columns in which -1 is a value and not the code for "missing", or which hold no code.
_NO_SENTINEL = {"Accident_Index", "Longitude", "Latitude", "Date", "Time"}


def schema(fields: str) -> StructType:
    table = StructType()
    for line in fields.split("\n"):
        if line:
            column, _, dtype = line.partition(" ")
            table = table.add(column, dtype or "integer")
    return table


def _sentinel_columns() -> tuple[str, ...]:
    tables = (ACCIDENTS, CASUALTIES, VEHICLES)
    names = [f.name for fields in tables for f in schema(fields)] + ["Vehicle_Reference_Casualty"]
    return tuple(dict.fromkeys(n for n in names if n not in _NO_SENTINEL))


# What the study drops, fills, samples and models.
ROAD_ACCIDENTS = Study(
    key="Accident_Index",
    label="Accident_Severity_Binary",
    label_source="Accident_Severity",
    label_zero="1",
    ordered=("Number_of_Vehicles", "Number_of_Casualties", "Speed_limit"),
    nominal=(
        "Police_Force",
        "Local_Authority_District",
        "Local_Authority_Highway",
        *LABELS,
    ),
    numeric=("Age_of_Driver", "Number_of_Vehicles", "Number_of_Casualties", "Speed_limit"),
    row_key=("Accident_Index", "Casualty_Reference", "Vehicle_Reference"),
    date="Date",
    time="Time",
    sentinel="-1",
    sentinel_columns=_sentinel_columns(),
    located_by=("Location_Easting_OSGR", "Location_Northing_OSGR", "Longitude", "Latitude"),
    sparse=(
        "2nd_Road_Number",
        "2nd_Road_Class",
        "Was_Vehicle_Left_Hand_Drive?",
        "Engine_Capacity_(CC)",
        "Propulsion_Code",
        "Age_of_Vehicle",
        "Driver_IMD_Decile",
        "Driver_Home_Area_Type",
        "Sex_of_Casualty",
        "Age_of_Casualty",
        "Age_Band_of_Casualty",
        "Casualty_Home_Area_Type",
        "LSOA_of_Accident_Location",
        "Journey_Purpose_of_Driver",
    ),
    complete=(
        "Junction_Detail",
        "Pedestrian_Crossing-Human_Control",
        "Pedestrian_Crossing-Physical_Facilities",
        "Road_Surface_Conditions",
        "Special_Conditions_at_Site",
        "Carriageway_Hazards",
        "Vehicle_Type",
        "Towing_and_Articulation",
        "Vehicle_Manoeuvre",
        "Vehicle_Location-Restricted_Lane",
        "Skidding_and_Overturning",
        "Hit_Object_in_Carriageway",
        "Vehicle_Leaving_Carriageway",
        "Hit_Object_off_Carriageway",
        "1st_Point_of_Impact",
        "Car_Passenger",
        "Bus_or_Coach_Passenger",
        "Date",
        "Junction_Location",
        "Did_Police_Officer_Attend_Scene_of_Accident",
    ),
    renamed={
        "Local_Authority_(District)": "Local_Authority_District",
        "Local_Authority_(Highway)": "Local_Authority_Highway",
    },
    conditional_fills=(ConditionalFill("Junction_Control", "Junction_Location", 0, 0),),
    constant_fills={
        "Weather_Conditions": 9,
        "Sex_of_Driver": 3,
        "Pedestrian_Location": 10,
        "Pedestrian_Movement": 9,
        "Pedestrian_Road_Maintenance_Worker": 2,
        "Junction_Control": 0,
    },
    mean_fills=("Age_of_Driver",),
    band_fills={"Age_Band_of_Driver": ("Age_of_Driver", AGE_BOUNDS)},
    strata="Accident_Severity",
    fractions={"1": 1.0, "2": 0.02, "3": 0.02},
    pruned=(
        "Accident_Severity",
        "Vehicle_Reference",
        "Police_Force",
        "Local_Authority_District",
        "Junction_Location",
        "Local_Authority_Highway",
        "Accident_Index",
        "Casualty_Reference",
        "1st_Road_Class",
        "Location_Easting_OSGR",
        "Location_Northing_OSGR",
        "Special_Conditions_at_Site",
        "Car_Passenger",
        "Date",
        "Latitude",
        "Longitude",
        "1st_Road_Number",
        "Pedestrian_Road_Maintenance_Worker",
        "Urban_or_Rural_Area",
        "Vehicle_Reference_Casualty",
        "Casualty_Severity",
        "Casualty_Class",
        "Age_of_Driver",
    ),
    codebook=LABELS,
    histograms=(
        ("Age_of_Driver", "Sex_of_Driver", ("1", "2")),
        ("Age_of_Driver", "Accident_Severity", ("1", "2", "3")),
        ("Age_of_Driver", "Accident_Severity", ("1",)),
    ),
)


def read_tables(spark: SparkSession, folder: str) -> tuple[DataFrame, list[DataFrame]]:
    """The accidents, and the casualties and vehicles as their children, from three CSV files."""
    accidents = scan_csv(spark, f"{folder}/Accidents.csv", schema(ACCIDENTS))
    casualties = scan_csv(spark, f"{folder}/Casualties.csv", schema(CASUALTIES))
    vehicles = scan_csv(spark, f"{folder}/Vehicles.csv", schema(VEHICLES))
    return accidents, [casualties.withColumnRenamed("Vehicle_Reference", "Vehicle_Reference_Casualty"), vehicles]
