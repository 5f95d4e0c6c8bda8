"""Labels of the road accident codes."""

# The label of each code per column. Frequency tables are grouped by these
# labels, so codes that share one (such as the motorcycle sizes) are counted together and
# the spelling is part of the result.
LABELS = {
    "Accident_Severity": {"1": "fatal", "2": "serious", "3": "slight"},
    "Weather_Conditions": {
        "1": "fine",
        "2": "rain",
        "3": "snow",
        "4": "fine-wind",
        "5": "rain-wind",
        "6": "snow-wind",
        "7": "fog",
        "8": "other",
        "9": "unknown",
    },
    "Day_of_Week": {
        "1": "sunday",
        "2": "monday",
        "3": "tuesday",
        "4": "wednesday",
        "5": "thursday",
        "6": "friday",
        "7": "saturday",
    },
    "1st_Road_Class": {"1": "motorway", "2": "A(M)", "3": "A", "4": "B", "5": "C", "6": "unclassified"},
    "Road_Type": {
        "1": "roundabout",
        "2": "one-way-street",
        "3": "dual-carriageway",
        "6": "single-carriageway",
        "7": "slip-road",
        "9": "unknown",
        "12": "one-way/slip-road",
    },
    "Light_Conditions": {
        "1": "daylight",
        "4": "darkness-lit",
        "5": "darkness-unlit",
        "6": "darkness-no-light",
        "7": "darkness-unknown",
    },
    "Junction_Detail": {
        "0": "not-junction",
        "1": "roundabout",
        "2": "mini-roundabout",
        "3": "t/staggered-junction",
        "5": "slip-road",
        "6": "crossroads",
        "7": "more-than-4-arms",
        "8": "private-drive",
        "9": "other",
    },
    "Junction_Control": {
        "0": "not-junction",
        "1": "authorised-person",
        "2": "auto-traffic-signal",
        "3": "stop-sign",
        "4": "give-way/uncontrolled",
    },
    "Pedestrian_Crossing-Human_Control": {"0": "none", "1": "school-crossing-patrol", "2": "authorised-person"},
    "Pedestrian_Crossing-Physical_Facilities": {
        "0": "no-facilities",
        "1": "zebra",
        "4": "pedestrian-light-controlled-crossing",
        "5": "pedestrian-light",
        "7": "footbridge/subway",
        "8": "central-refuge",
    },
    "Road_Surface_Conditions": {
        "1": "dry",
        "2": "wet",
        "3": "snow",
        "4": "ice",
        "5": "flood",
        "6": "oil",
        "7": "mud",
    },
    "Special_Conditions_at_Site": {
        "0": "none",
        "1": "auto-signal-out",
        "2": "auto-signal-defective",
        "3": "road-sign",
        "4": "roadworks",
        "5": "road-surface-defective",
        "6": "oil",
        "7": "mud",
    },
    "Carriageway_Hazards": {
        "0": "none",
        "1": "vehicle",
        "2": "object",
        "3": "accident",
        "4": "dog",
        "5": "pedestrian",
        "7": "animal",
    },
    "Urban_or_Rural_Area": {"1": "urban", "2": "rural", "3": "unallocated"},
    "Did_Police_Officer_Attend_Scene_of_Accident": {"1": "yes", "2": "no", "3": "no"},
    "Vehicle_Type": {
        "1": "pedal-cycle",
        "2": "motorcycle",
        "3": "motorcycle",
        "4": "motorcycle",
        "5": "motorcycle",
        "8": "taxi",
        "9": "car",
        "10": "minibus",
        "11": "bus",
        "16": "horse",
        "17": "agricultural-vehicle",
        "18": "tram",
        "19": "van",
        "20": "goods",
        "21": "goods",
        "22": "scooter",
        "23": "motorcycle",
        "90": "other",
        "97": "motorcycle",
        "98": "goods",
    },
    "Sex_of_Driver": {"1": "male", "2": "female", "3": "not-known"},
    "Age_Band_of_Driver": {
        "1": "child",
        "2": "school-child",
        "3": "teen",
        "4": "child",
        "5": "young-adult",
        "6": "adult",
        "7": "middle-adult",
        "8": "old-adult",
        "9": "young-senior",
        "10": "middle-senior",
        "11": "old-senior",
    },
    "1st_Point_of_Impact": {"0": "no-impact", "1": "front", "2": "back", "3": "offside", "4": "nearside"},
    "Hit_Object_off_Carriageway": {
        "0": "none",
        "1": "sign",
        "2": "lamp",
        "3": "pole",
        "4": "tree",
        "5": "bus-stop",
        "6": "central-crash-barrier",
        "7": "near/offside-barrier",
        "8": "submerged",
        "9": "entered-ditch",
        "10": "other-object",
        "11": "wall",
    },
    "Vehicle_Leaving_Carriageway": {
        "0": "didnt-leave",
        "1": "nearside",
        "2": "nearside-rebound",
        "3": "straight-ahead",
        "4": "offside-central",
        "5": "offside-central-rebound",
        "6": "offside-cross-central",
        "7": "offside",
        "8": "offside-rebound",
    },
    "Hit_Object_in_Carriageway": {
        "0": "none",
        "1": "previous-accident",
        "2": "road-works",
        "4": "parked-vehicle",
        "5": "bridge(roof)",
        "6": "bridge(side)",
        "7": "bollard-of-refuge",
        "8": "open-door-of-vehicle",
        "9": "central-island-of-roundabout",
        "10": "kerb",
        "11": "other-object",
        "12": "any-animal",
    },
    "Skidding_and_Overturning": {
        "0": "none",
        "1": "skidded",
        "2": "skidded-overturned",
        "3": "jackknifed",
        "4": "jackknifed-overturned",
        "5": "overturned",
    },
    "Junction_Location": {
        "0": "not-junction",
        "1": "approaching-junction",
        "2": "cleared-junction",
        "3": "leaving-roundabout",
        "4": "entering-roundabout",
        "5": "leaving-main-road",
        "6": "entering-main-road",
        "7": "entering-from-slip-road",
        "8": "mid-junction",
    },
    "Vehicle_Location-Restricted_Lane": {
        "0": "on-main",
        "1": "tram-track",
        "2": "bus-lane",
        "3": "busway",
        "4": "cycleway",
        "5": "cycleway/footway",
        "6": "on-lay-by",
        "7": "entering-lay-by",
        "8": "leaving-lay-by",
        "9": "footway",
        "10": "not-on-carriageway",
    },
    "Vehicle_Manoeuvre": {
        "1": "reversing",
        "2": "parked",
        "3": "w8-to-go",
        "4": "slowing/stopping",
        "5": "moving-off",
        "6": "u-turn",
        "7": "turning-left",
        "8": "w8-to-turn-left",
        "9": "turning-right",
        "10": "w8-to-turn-right",
        "11": "changing-lane-to-left",
        "12": "changing-lane-to-right",
        "13": "overtaking-moving-vehicle",
        "14": "overtaking-static-vehicle",
        "15": "overtaking-nearside",
        "16": "going-ahead-left-hand-bend",
        "17": "going-ahead-right-hand-bend",
        "18": "going-ahead-other",
    },
    "Towing_and_Articulation": {
        "0": "no-tow",
        "1": "articulated",
        "2": "multiple-trailer",
        "3": "caravan",
        "4": "single-trailer",
        "5": "other-tow",
    },
    "Casualty_Class": {"1": "driver", "2": "passenger", "3": "pedestrian"},
    "Casualty_Severity": {"1": "fatal", "2": "serious", "3": "slight"},
    "Pedestrian_Location": {
        "0": "not-pedestrian",
        "1": "crossing-on-pedestrian-crossing-facility",
        "2": "crossing-in-zig-zag-approach-lines",
        "3": "crossing-in-zig-zag-exit-lines",
        "4": "crossing-elsewhere",
        "5": "in-carriageway-crossing",
        "6": "on-footway",
        "7": "on-refuge",
        "8": "in-centre-of-carriageway",
        "9": "in-carriageway-not-crossing",
        "10": "unknown",
    },
    "Pedestrian_Movement": {
        "0": "not-pedestrian",
        "1": "crossing-from-driver-nearside",
        "2": "crossing-from-nearside-masked",
        "3": "crossing-from-driver-offside",
        "4": "crossing-from-offside-masked",
        "5": "in-carriageway-stationary-not-crossing",
        "6": "in-carriageway-stationary-not-crossing-masked",
        "7": "walking-along-in-carriageway-facing-traffic",
        "8": "walking-along-in-carriageway-back-to-traffic",
        "9": "unknown",
    },
    "Car_Passenger": {"0": "not-passenger", "1": "font-seat", "2": "rear-seat"},
    "Bus_or_Coach_Passenger": {
        "0": "not-passenger",
        "1": "boarding",
        "2": "alighting",
        "3": "standing-passenger",
        "4": "seated-passenger",
    },
    "Pedestrian_Road_Maintenance_Worker": {"0": "no", "1": "yes", "2": "unknown"},
    "Casualty_Type": {
        "0": "pedestran",
        "1": "cyclist",
        "2": "motorcycler",
        "3": "motorcycler",
        "4": "motorcycler",
        "5": "motorcycler",
        "8": "taxi-occupant",
        "9": "car-occupant",
        "10": "minibus-occupant",
        "11": "bus-occupant",
        "16": "horse-rider",
        "17": "agricultural-occupant",
        "18": "tram-occupant",
        "19": "van-occupant",
        "20": "goods-occupant",
        "21": "goods-occupant",
        "22": "scooter-rider",
        "23": "motocycler",
        "90": "other-occupant",
        "97": "motorcycler",
        "98": "goods-occupant",
    },
}
