"""Parameters whose defaults are the reference pipeline's fixed values.

FIXED VALUES (must equal the reference for identical results):
status sets, offense keywords, target cities, weights, stations, bounding
boxes, year range, transit-score constants, green-cover steps.
"""

# --- fixed values: year range of the reference models
YEAR_LO, YEAR_HI = 2018, 2024

# --- fixed values: complaint status sets (compared on lower(status))
PENDING_STATUSES = ("pending", "open", "in progress", "assigned")
RESOLVED_STATUSES = ("resolved", "closed", "completed")
REJECTED_STATUSES = ("rejected", "cancelled")

# --- fixed values: crime categories pivoted by the crime model, in output order
CRIME_PIVOT = ("murder", "theft", "robbery", "assault", "kidnapping", "burglary")

# --- fixed values: offense category -> header keywords (first header containing any wins)
TARGET_OFFENSES = {
    "murder": ["murder", "culpable homicide"],
    "theft": ["theft", "auto theft", "vehicle theft"],
    "robbery": ["robbery", "dacoity"],
    "assault": ["assault", "hurt", "grievous hurt"],
    "kidnapping": ["kidnapping", "abduction"],
    "burglary": ["burglary", "housebreaking", "house-breaking"],
    "crimes against women": ["rape", "dowry death", "cruelty by husband"],
    "economic offenses": ["cheating", "forgery", "criminal breach of trust"],
    "cyber crimes": ["cyber crime", "information technology act"],
}

# --- fixed values: cities kept by the crime-table parser (substring match on lower case)
TARGET_CITIES = ["bengaluru", "bangalore", "delhi", "mumbai", "chennai",
                 "hyderabad", "kolkata", "pune", "ahmedabad", "jaipur"]

# --- fixed values: score weights and dimension inputs
WEIGHTS = {"safety": 0.20, "aqi": 0.20, "civic": 0.15, "transit": 0.20,
           "green": 0.15, "affordability": 0.10}
DIMENSIONS = {"safety": ["crime_rate_per_1000"], "aqi": ["avg_aqi"],
              "civic": ["resolution_rate"], "transit": ["transit_score"],
              "green": ["avg_ndvi"], "affordability": ["median_price_sqft"]}
INVERTED = ("safety", "aqi", "affordability")
SCORE_MONTH = 3

# --- fixed values: city bounding boxes (degrees)
CITY_BBOXES = {
    "Bengaluru": {"west": 77.35, "south": 12.73, "east": 77.85, "north": 13.18},
    "Mumbai": {"west": 72.77, "south": 18.89, "east": 72.98, "north": 19.27},
    "Delhi": {"west": 76.84, "south": 28.41, "east": 77.35, "north": 28.88},
}

# --- fixed values: air-quality station master (id, name, lat, lon, city)
STATIONS = [
    ("site_5029", "BTM Layout", 12.9165, 77.6101, "Bengaluru"),
    ("site_5030", "Peenya", 13.0285, 77.5192, "Bengaluru"),
    ("site_5031", "Silk Board", 12.9173, 77.6228, "Bengaluru"),
    ("site_5032", "Jayanagar", 12.9299, 77.5838, "Bengaluru"),
    ("site_5033", "Hebbal", 13.0358, 77.5970, "Bengaluru"),
    ("site_5034", "Bapuji Nagar", 12.9519, 77.5381, "Bengaluru"),
    ("site_5035", "Hombegowda Nagar", 12.9400, 77.5900, "Bengaluru"),
    ("site_5036", "City Railway Station", 12.9784, 77.5710, "Bengaluru"),
    ("site_5101", "Colaba", 18.9067, 72.8147, "Mumbai"),
    ("site_5102", "Bandra Kurla Complex", 19.0626, 72.8633, "Mumbai"),
    ("site_5103", "Vile Parle West", 19.1025, 72.8391, "Mumbai"),
    ("site_5001", "Anand Vihar", 28.6476, 77.3158, "Delhi"),
    ("site_5002", "R.K. Puram", 28.5668, 77.1706, "Delhi"),
    ("site_5003", "Ito", 28.6286, 77.2410, "Delhi"),
]

# --- fixed values: transit sources -> city (substring rules, default Bengaluru)
SOURCE_CITY_RULES = [(("BMTC", "BMRCL"), "Bengaluru"), (("BEST", "MMRDA"), "Mumbai"),
                     (("DTC", "DMRC"), "Delhi")]
GTFS_FEEDS = {"Bengaluru": [("bmtc", "BMTC"), ("bmrcl", "BMRCL")],
              "Mumbai": [("best", "BEST")], "Delhi": [("dtc", "DTC")]}
METRO_SOURCE = "BMRCL"

# --- fixed values: transit score
TRANSIT_STOP_CAP, TRANSIT_KM_SCALE, TRANSIT_FREQ_CAP = 50, 10.0, 100
TRANSIT_W_STOPS, TRANSIT_W_METRO, TRANSIT_W_FREQ = 40, 40, 20
NO_METRO_KM = 99.0

# --- fixed values: green cover steps (avg_ndvi greater than -> percent), else 10
GREEN_STEPS = [(0.6, 80.0), (0.4, 60.0), (0.3, 40.0), (0.2, 20.0)]
GREEN_ELSE = 10.0

# --- fixed values: property price sanity band, AQI good-day threshold
PRICE_SQFT_LO, PRICE_SQFT_HI = 1000, 100000
AQI_GOOD_MAX = 50

# --- fixed values: NDVI masking
SCL_MASKED = (3, 8, 9, 10)
SCENE_CLOUD_MAX = 30
MONTH_CLOUD_MAX = 80

# --- fixed values: spatial
WARD_SNAP_METERS = 500.0
EARTH_RADIUS_KM = 6371.0088

# --- fixed values: census loader header aliases, required and optional columns
CENSUS_ALIASES = {
    "name": "ward_name", "ward": "ward_name", "ward_no": "ward_number",
    "pop": "population", "total_population": "population", "area": "area_sqkm",
    "pop_density": "density", "population_density": "density",
    "literacy": "literacy_rate", "hh_size": "household_size",
    "avg_household_size": "household_size", "households": "total_households",
}
CENSUS_REQUIRED = ["ward_name", "ward_number", "population", "area_sqkm",
                   "density", "literacy_rate", "household_size", "year"]
CENSUS_OPTIONAL = ["male_population", "female_population", "male_literacy",
                   "female_literacy", "total_households"]
CENSUS_MIN_WARDS, CENSUS_EXPECTED_WARDS = 150, 198

# --- fixed values: suffix of the crime model's source_pdf column (city || suffix)
CRIME_SOURCE_SUFFIX = "_ncrb"

DEFAULT_CRIME_YEAR = 2022
DEFAULT_STATE = "Karnataka"
