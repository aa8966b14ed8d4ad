"""Fixed values that results depend on.

Everything in this module is a FIXED VALUE that must stay equal to the
behaviour being reproduced (header names, code maps, grid geometry, walk
presets, keyword rules, stop-words).  They are listed plainly, in their
natural order; operators turn them into small literal maps or broadcast
lookup tables.
"""

from __future__ import annotations

# --- FIXED VALUES: raw header -> column name (27 entries) -------------------
COLUMN_RENAME: dict[str, str] = {
    "CAMIS": "camis",
    "DBA": "dba",
    "BORO": "boro",
    "BUILDING": "building",
    "STREET": "street",
    "ZIPCODE": "zipcode",
    "PHONE": "phone",
    "CUISINE DESCRIPTION": "cuisine",
    "INSPECTION DATE": "inspection_date",
    "ACTION": "action",
    "VIOLATION CODE": "violation_code",
    "VIOLATION DESCRIPTION": "violation_description",
    "CRITICAL FLAG": "critical_flag",
    "SCORE": "score",
    "GRADE": "grade",
    "GRADE DATE": "grade_date",
    "RECORD DATE": "record_date",
    "INSPECTION TYPE": "inspection_type",
    "Latitude": "latitude",
    "Longitude": "longitude",
    "Community Board": "community_board",
    "Council District": "council_district",
    "Census Tract": "census_tract",
    "BIN": "bin",
    "BBL": "bbl",
    "NTA": "nta",
    "Location": "location",
}

# --- FIXED VALUES: texts the CSV reader treats as missing -------------------
NA_STRINGS: list[str] = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
]

# --- FIXED VALUES: typed columns ---------------------------------------------
DATE_COLUMNS = ["inspection_date", "grade_date", "record_date"]
DATE_FORMAT = "M/d/yyyy"
NEVER_INSPECTED_DATE = "1900-01-01"
NUMERIC_COLUMNS = ["score", "latitude", "longitude", "community_board",
                   "council_district", "census_tract", "bin", "bbl", "zipcode"]

# --- FIXED VALUES: grades -----------------------------------------------------
LETTER_GRADES = ["A", "B", "C"]
GRADE_TO_INT = {"A": 3, "B": 2, "C": 1}
SAFETY_SCORES = {"A": 3.0, "B": 2.0, "C": 1.0}
NEUTRAL_SAFETY = 2.0
NO_GRADE_LABEL = "No grade"
GRADE_COLOR_RGBA = {"A": [0, 200, 100, 210], "B": [255, 200, 0, 210],
                    "C": [240, 80, 60, 210]}
NO_GRADE_RGBA = [158, 158, 158, 140]

# --- FIXED VALUES: entity table ------------------------------------------------
IDENTITY_COLUMNS = ["dba", "boro", "building", "street", "zipcode", "phone",
                    "cuisine", "latitude", "longitude", "nta",
                    "community_board", "council_district", "location"]
ENTITY_COLUMN_ORDER = IDENTITY_COLUMNS + [
    "latest_grade", "latest_grade_encoded", "latest_grade_date",
    "latest_score", "latest_inspection_date", "latest_action",
    "latest_inspection_type",
    "inspection_count", "mean_score", "min_score", "max_score",
    "days_since_last_inspection",
    "total_violations", "critical_violations", "non_critical_violations",
    "unique_violation_codes",
]

# --- FIXED VALUES: model features ---------------------------------------------
KNN_FEATURES = ["mean_score", "critical_violations", "total_violations",
                "days_since_last_inspection"]
TREE_BASE_FEATURES = list(KNN_FEATURES)
TREE_EXTRA_FEATURES = ["min_score", "max_score", "score_range",
                       "inspection_count", "critical_rate",
                       "violations_per_inspection"]
TREE_ALL_FEATURES = TREE_BASE_FEATURES + TREE_EXTRA_FEATURES
FEATURE_DEPENDENCIES = {
    "mean_score": ["mean_score"],
    "critical_violations": ["critical_violations"],
    "total_violations": ["total_violations"],
    "days_since_last_inspection": ["days_since_last_inspection"],
    "min_score": ["min_score"],
    "max_score": ["max_score"],
    "score_range": ["min_score", "max_score"],
    "inspection_count": ["inspection_count"],
    "critical_rate": ["critical_violations", "total_violations"],
    "violations_per_inspection": ["total_violations", "inspection_count"],
}
BLEND_REQUIRED = ["mean_score", "critical_violations", "total_violations",
                  "days_since_last_inspection", "inspection_count",
                  "min_score", "max_score"]

# --- FIXED VALUES: label prediction --------------------------------------------
MIN_LABEL_COUNT = 10

# --- FIXED VALUES: city grid ----------------------------------------------------
LAT_MIN, LAT_MAX = 40.477, 40.920
LNG_MIN, LNG_MAX = -74.260, -73.699
GRID_LAT_RES = 0.004
GRID_LNG_RES = 0.005
GRID_ROWS = 111
GRID_COLS = 113
METRES_PER_ROW = 444.0
METRES_PER_COL = 420.0
WALK_SPEED_KMH = 4.5
METRES_PER_DEG_LAT = 111_000.0
METRES_PER_DEG_LNG = 85_000.0
DESTINATION_RADIUS_CELLS = 2
WARNING_RADIUS_CELLS = 4
MIN_MATCH = 0.05
REFERENCE_SAME_LABEL = 1.0
REFERENCE_RELATED_LABEL = 0.6
REFERENCE_OTHER_LABEL = 0.08

# --- FIXED VALUES: walk presets (name, walk_km, gamma, max_steps, sigma_km) -----
WALK_PRESETS = [
    ("5 min  (~375 m)", 0.375, 0.50, 2, 0.25),
    ("8 min  (~600 m)", 0.600, 0.65, 3, 0.35),
    ("10 min (~750 m)", 0.750, 0.70, 4, 0.45),
    ("12 min (~900 m)", 0.900, 0.75, 5, 0.55),
    ("15 min (~1.1 km)", 1.125, 0.80, 6, 0.70),
    ("20 min (~1.5 km)", 1.500, 0.85, 8, 1.00),
]
# --- FIXED VALUES: named places to start from (name, lat, lng) --------------------
PLACES = [
    ("Midtown Manhattan (Times Sq.)", 40.7580, -73.9855),
    ("Hell's Kitchen / 9th Ave", 40.7638, -73.9918),
    ("Upper East Side", 40.7736, -73.9566),
    ("Upper West Side", 40.7870, -73.9754),
    ("Harlem", 40.8116, -73.9465),
    ("East Village", 40.7264, -73.9815),
    ("Lower East Side", 40.7157, -73.9863),
    ("Greenwich Village / NYU", 40.7335, -74.0027),
    ("SoHo / Nolita", 40.7233, -74.0030),
    ("Tribeca / Financial District", 40.7163, -74.0086),
    ("Chelsea / Flatiron", 40.7465, -74.0014),
    ("Flushing (Queens)", 40.7675, -73.8330),
    ("Astoria (Queens)", 40.7721, -73.9302),
    ("Jackson Heights (Queens)", 40.7557, -73.8831),
    ("Williamsburg (Brooklyn)", 40.7081, -73.9571),
    ("Park Slope (Brooklyn)", 40.6710, -73.9777),
    ("Brooklyn Heights / DUMBO", 40.6981, -73.9949),
    ("Bensonhurst (Brooklyn)", 40.6036, -73.9951),
    ("Grand Concourse (Bronx)", 40.8448, -73.9285),
    ("Fordham / Arthur Ave (Bronx)", 40.8599, -73.8924),
    ("St. George (Staten Island)", 40.6437, -74.0739),
    ("Click on the map to set location", 40.7580, -73.9855),
]

DEFAULT_PRESET = "15 min (~1.1 km)"

# --- FIXED VALUES: keyword expansion rules (pattern, expansion), in order --------
KEYWORD_RULES = [
    (r"\bramen\b", "japanese noodles asian"),
    (r"\bsushi\b", "japanese"),
    (r"\bsashimi\b", "japanese seafood"),
    (r"\budon\b", "japanese noodles"),
    (r"\btonkatsu\b", "japanese"),
    (r"\bbento\b", "japanese"),
    (r"\bteriyaki\b", "japanese"),
    (r"\bgyoza\b", "japanese chinese"),
    (r"\bdim\s*sum\b", "chinese"),
    (r"\bdumplings?\b", "chinese asian"),
    (r"\bfried\s*rice\b", "chinese asian"),
    (r"\bwonton\b", "chinese"),
    (r"\bchow\s*mein\b", "chinese"),
    (r"\bpeking\b", "chinese"),
    (r"\bbbq\b", "barbecue korean"),
    (r"\bkimchi\b", "korean"),
    (r"\bbibimbap\b", "korean"),
    (r"\bpad\s*thai\b", "thai southeast asian"),
    (r"\bthai\s*curry\b", "thai"),
    (r"\bpho\b", "southeast asian vietnamese"),
    (r"\bbanh\s*mi\b", "southeast asian vietnamese"),
    (r"\bcurry\b", "indian thai"),
    (r"\bnaan\b", "indian"),
    (r"\bbiryani\b", "indian"),
    (r"\btandoori\b", "indian"),
    (r"\bsamosa\b", "indian"),
    (r"\btacos?\b", "mexican tex-mex"),
    (r"\bburritos?\b", "mexican"),
    (r"\bguacamole\b", "mexican"),
    (r"\bquesadillas?\b", "mexican"),
    (r"\bnachos?\b", "tex-mex mexican"),
    (r"\bpizzas?\b", "pizza italian"),
    (r"\bpastas?\b", "italian"),
    (r"\brisotto\b", "italian"),
    (r"\bgnocchi\b", "italian"),
    (r"\blasagna\b", "italian"),
    (r"\bburgers?\b", "hamburgers american"),
    (r"\bsteaks?\b", "steakhouse american"),
    (r"\bwings?\b", "chicken american"),
    (r"\bsandwiches?\b", "sandwiches american"),
    (r"\bshawarma\b", "middle eastern mediterranean"),
    (r"\bfalafel\b", "middle eastern"),
    (r"\bhummus\b", "middle eastern mediterranean"),
    (r"\bgyros?\b", "greek mediterranean"),
    (r"\bkebabs?\b", "middle eastern turkish mediterranean"),
    (r"\bnoodles?\b", "asian chinese japanese"),
    (r"\bseafood\b", "seafood"),
    (r"\bsalads?\b", "salads"),
    (r"\bsushi\s*roll\b", "japanese"),
    (r"\bcrepes?\b", "french"),
    (r"\bcroissants?\b", "french bakery"),
    (r"\bbagels?\b", "bagels jewish"),
    (r"\bjerk\b", "caribbean"),
    (r"\bpoke\b", "hawaiian japanese"),
    (r"\btapas?\b", "tapas spanish"),
    (r"\bpaella\b", "spanish"),
]

# --- FIXED VALUES: stop-words for reference-name detection ----------------------
STOPWORDS = [
    "the", "and", "a", "an", "of", "in", "at", "on", "for",
    "i", "want", "like", "find", "me", "give", "something",
    "noodles", "noodle", "chicken", "beef", "pork", "fish", "rice",
    "pizza", "burger", "burgers", "taco", "tacos", "sushi", "ramen",
    "curry", "salad", "soup", "bread", "cake", "food", "restaurant",
    "cafe", "bar", "grill", "kitchen", "house", "place", "spot",
    "spicy", "crispy", "fresh", "best", "good", "great", "nice",
    "thai", "chinese", "japanese", "korean", "indian", "italian",
    "mexican", "american", "greek", "french", "latin", "bbq",
]

# ASCII punctuation removed by name normalisation (Python's string.punctuation).
ASCII_PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
