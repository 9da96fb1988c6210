"""Rule tables and default parameters.

Every operator takes its rules as arguments; the values below are only the
default configuration (the venue cleaning / scoring job).
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# FIXED VALUES — these must equal the reference job's values for identical
# results. They are listed plainly, in the reference's natural order.
# ---------------------------------------------------------------------------

NULL_STRINGS = ["null", "NULL", "Null", "none", "None", "NONE", "n/a", "N/A", ""]

# Extra strings a pandas CSV load treats as missing (keep_default_na=True).
PANDAS_DEFAULT_NA = [
    "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null", "",
]

TEXT_COLUMNS = ["name", "city", "display_address", "website"]

REQUIRED_COLUMNS = [
    "id", "name", "city", "display_address", "google_place_id",
    "latitude", "longitude", "price_point", "primary_type", "website",
]

FUZZY_ADDRESS_THRESHOLD = 85
FUZZY_NAME_CITY_THRESHOLD = 90

PRICE_POINT_NUMERIC = {"budget": 1.0, "low": 2.0, "medium": 3.0, "high": 4.0}
PRICE_POINT_DEFAULT = 2.5

MIN_URL_LENGTH = 8
UNKNOWN_COHORT = "__unknown__"
GENERIC_TYPE = "restaurant"
FALLBACK_CUISINE = "Contemporary"
DEFAULT_CUISINE_AFFINITY = 0.3

TYPE_PRICE_MAP = {
    "fine_dining_restaurant": "high",
    "kaiseki_restaurant": "high",
    "diner": "low",
    "fast_food_restaurant": "budget",
}

URL_HIGH_TOKENS = [
    "bellagio", "aria", "mgmgrand", "waldorf", "peninsula",
    "fourseasons", "ritz", "trump", "mandalaybay", "venetian",
    "wynn", "encore", "themirage",
]

KNOWN_CITIES = [
    "New York City", "Los Angeles", "Chicago", "Houston", "San Francisco Bay Area",
    "San Francisco", "Seattle", "Denver", "Washington, DC", "Nashville",
    "New Orleans", "Atlanta", "San Diego", "Miami", "Philadelphia",
    "Minneapolis-Saint Paul", "Minneapolis", "Austin", "Boston", "Dallas",
    "Las Vegas", "Brooklyn", "Queens", "Bronx", "Manhattan",
    "Oakland", "Berkeley", "San Jose", "Sacramento", "Portland",
    "Phoenix", "Tucson", "Scottsdale", "Baltimore", "Arlington",
    "Alexandria", "Bethesda", "Coral Gables", "Fort Lauderdale",
    "Long Beach", "Anaheim", "Santa Monica", "Beverly Hills",
    "West Hollywood", "Culver City", "Costa Mesa", "Plano", "Fort Worth",
    "Charlotte", "Raleigh", "Durham", "Indianapolis", "Columbus",
    "Cleveland", "Cincinnati", "Pittsburgh", "Louisville", "Memphis",
    "Oklahoma City", "Baton Rouge", "Salt Lake City", "Albuquerque",
    "Milwaukee", "Madison", "St. Louis", "Kansas City", "Saint Paul",
    "Omaha", "Lincoln", "Richmond", "Norfolk", "Hartford", "Providence",
    "Detroit", "Grand Rapids",
]

PRIMARY_TYPE_TO_CUISINE = {
    "american_restaurant": "American",
    "asian_fusion_restaurant": "Asian Fusion",
    "bar": "Bar/Lounge",
    "brunch_restaurant": "American",
    "cafe": "Café",
    "californian_restaurant": "American",
    "chinese_restaurant": "Chinese",
    "cocktail_bar": "Bar/Lounge",
    "corporate_office": "Other",
    "creole_restaurant": "Creole/Cajun",
    "diner": "American",
    "event_venue": "Venue",
    "fine_dining_restaurant": "Fine Dining",
    "french_restaurant": "French",
    "gastropub": "American",
    "greek_restaurant": "Greek",
    "historical_landmark": "Venue",
    "hotel": "Hotel/Venue",
    "indian_restaurant": "Indian",
    "indonesian_restaurant": "Southeast Asian",
    "italian_restaurant": "Italian",
    "japanese_restaurant": "Japanese",
    "kaiseki_restaurant": "Japanese",
    "korean_restaurant": "Korean",
    "live_music_bar": "Bar/Lounge",
    "live_music_venue": "Venue",
    "mediterranean_restaurant": "Mediterranean",
    "mexican_restaurant": "Mexican",
    "modern_art_museum": "Venue",
    "new_american_restaurant": "American",
    "pizza_restaurant": "Italian",
    "ramen_restaurant": "Japanese",
    "restaurant": "Contemporary",
    "roman_restaurant": "Italian",
    "seafood_restaurant": "Seafood",
    "south_american_restaurant": "Latin American",
    "southern_restaurant_us": "American",
    "spanish_restaurant": "Spanish",
    "steak_house": "Steakhouse",
    "sushi_restaurant": "Japanese",
    "thai_restaurant": "Southeast Asian",
    "ukrainian_restaurant": "European",
    "vietnamese_restaurant": "Southeast Asian",
    "west_african_restaurant": "African",
}

NAME_KEYWORDS_TO_CUISINE = [
    ("african", "African"),
    ("american", "American"),
    ("barbecue", "American"),
    ("bbq", "American"),
    ("burger", "American"),
    ("diner", "American"),
    ("grill", "American"),
    ("smokehouse", "American"),
    ("bar", "Bar/Lounge"),
    ("cafe", "Café"),
    ("coffee", "Café"),
    ("dim sum", "Chinese"),
    ("dumpling", "Chinese"),
    ("peking", "Chinese"),
    ("chinese", "Chinese"),
    ("cajun", "Creole/Cajun"),
    ("creole", "Creole/Cajun"),
    ("nola", "Creole/Cajun"),
    ("brasserie", "French"),
    ("patisserie", "French"),
    ("bistro", "French"),
    ("greek", "Greek"),
    ("tandoor", "Indian"),
    ("curry", "Indian"),
    ("indian", "Indian"),
    ("pizzeria", "Italian"),
    ("trattoria", "Italian"),
    ("osteria", "Italian"),
    ("pasta", "Italian"),
    ("pizza", "Italian"),
    ("omakase", "Japanese"),
    ("kaiseki", "Japanese"),
    ("yakitori", "Japanese"),
    ("izakaya", "Japanese"),
    ("kappo", "Japanese"),
    ("sushi", "Japanese"),
    ("ramen", "Japanese"),
    ("tempura", "Japanese"),
    ("tonkatsu", "Japanese"),
    ("udon", "Japanese"),
    ("soba", "Japanese"),
    ("sake", "Japanese"),
    ("korean", "Korean"),
    ("ceviche", "Latin American"),
    ("peruvian", "Latin American"),
    ("latin", "Latin American"),
    ("mediterranean", "Mediterranean"),
    ("falafel", "Mediterranean"),
    ("hummus", "Mediterranean"),
    ("taqueria", "Mexican"),
    ("cantina", "Mexican"),
    ("burrito", "Mexican"),
    ("tacos", "Mexican"),
    ("taco", "Mexican"),
    ("mexican", "Mexican"),
    ("seafood", "Seafood"),
    ("oyster", "Seafood"),
    ("lobster", "Seafood"),
    ("fish", "Seafood"),
    ("pho", "Southeast Asian"),
    ("banh mi", "Southeast Asian"),
    ("vietnamese", "Southeast Asian"),
    ("thai", "Southeast Asian"),
    ("tapas", "Spanish"),
    ("paella", "Spanish"),
    ("spanish", "Spanish"),
    ("steakhouse", "Steakhouse"),
    ("chophouse", "Steakhouse"),
    ("steak", "Steakhouse"),
    ("vegan", "Vegetarian"),
    ("vegetarian", "Vegetarian"),
    ("plant", "Vegetarian"),
]

WEBSITE_KEYWORDS_TO_CUISINE = [
    ("african", "African"),
    ("bbq", "American"),
    ("chinese", "Chinese"),
    ("cajun", "Creole/Cajun"),
    ("creole", "Creole/Cajun"),
    ("nola", "Creole/Cajun"),
    ("bistro", "French"),
    ("french", "French"),
    ("greek", "Greek"),
    ("indian", "Indian"),
    ("italian", "Italian"),
    ("pasta", "Italian"),
    ("pizza", "Italian"),
    ("izakaya", "Japanese"),
    ("kaiseki", "Japanese"),
    ("omakase", "Japanese"),
    ("ramen", "Japanese"),
    ("sushi", "Japanese"),
    ("korean", "Korean"),
    ("mediterranean", "Mediterranean"),
    ("mexican", "Mexican"),
    ("taqueria", "Mexican"),
    ("seafood", "Seafood"),
    ("thai", "Southeast Asian"),
    ("vietnamese", "Southeast Asian"),
    ("steakhouse", "Steakhouse"),
    ("steak", "Steakhouse"),
    ("vegan", "Vegetarian"),
    ("vegetarian", "Vegetarian"),
]

ROMANTIC_SCORE_WEIGHTS = {
    "price_point": 0.30,
    "address": 0.25,
    "fancy_type": 0.20,
    "name_keyword": 0.10,
    "cuisine": 0.10,
    "has_website": 0.05,
}

FANCY_PRIMARY_TYPES = [
    "californian_restaurant",
    "fine_dining_restaurant",
    "french_restaurant",
    "greek_restaurant",
    "italian_restaurant",
    "japanese_restaurant",
    "kaiseki_restaurant",
    "mediterranean_restaurant",
    "new_american_restaurant",
    "seafood_restaurant",
    "spanish_restaurant",
    "steak_house",
    "sushi_restaurant",
]

ROMANTIC_NAME_KEYWORDS_HIGH = [
    "atelier", "chateau", "château", "chez", "garden", "hideaway", "kaiseki",
    "l'", "la ", "le ", "maison", "manor", "omakase", "secret", "terrace", "villa",
]

ROMANTIC_NAME_KEYWORDS_MEDIUM = [
    "alley", "bistro", "bloom", "brasserie", "cellar", "flora", "grove",
    "lounge", "olive", "parlor", "petal", "rose",
]

CUISINE_ROMANCE_SCORE = {
    "African": 0.40,
    "American": 0.30,
    "Asian Fusion": 0.65,
    "Bar/Lounge": 0.30,
    "Café": 0.25,
    "Chinese": 0.45,
    "Contemporary": 0.60,
    "Creole/Cajun": 0.45,
    "European": 0.55,
    "Fine Dining": 1.00,
    "French": 1.00,
    "Greek": 0.70,
    "Hotel/Venue": 0.20,
    "Indian": 0.40,
    "Italian": 0.85,
    "Japanese": 0.90,
    "Korean": 0.50,
    "Latin American": 0.55,
    "Mediterranean": 0.80,
    "Mexican": 0.35,
    "Other": 0.10,
    "Seafood": 0.75,
    "Southeast Asian": 0.45,
    "Spanish": 0.75,
    "Steakhouse": 0.70,
    "Vegetarian": 0.40,
    "Venue": 0.15,
}

HIGH_TICKET_ADDRESS_TOKENS = [
    "park avenue", "park ave", "fifth avenue", "5th ave", "madison avenue",
    "madison ave", "central park", "rockefeller", "wall st", "tribeca",
    "waldorf", "plaza", "trump", "lotte", "mercer", "1 hotel",
    "rodeo dr", "rodeo drive", "beverly hills", "west hollywood", "sunset blvd",
    "bel air", "santa monica blvd",
    "pennsylvania ave", "k street", "georgetown",
    "bellagio", "aria", "mgm grand", "mgm national", "mandalay bay", "venetian",
    "four seasons", "peninsula", "ritz", "wynn", "encore",
    "nob hill", "pacific heights", "union square",
    "resort & casino", "resort and casino", "luxury",
]

# Right-closed score bins (-inf, 2], (2, 4], (4, 6], (6, 8], (8, inf).
SCORE_BIN_EDGES = [2.0, 4.0, 6.0, 8.0]
SCORE_LABELS = ["Not Romantic", "Casual", "Somewhat Romantic", "Romantic", "Highly Romantic"]

# Output schema of the enrichment stage (appended to the clean columns).
ENRICHED_COLUMNS = [
    "cuisine_category", "score_price", "score_address", "score_fancy_type",
    "score_name", "score_cuisine", "score_website", "romantic_score", "romantic_label",
]

# ---------------------------------------------------------------------------
# Engine parameters (ours, not the reference's).
# ---------------------------------------------------------------------------

# Distinct match keys per similarity-join packet; a packet pair is one unit
# of work in the block join, so this bounds per-task memory and time.
SIMJOIN_PACKET_SIZE = 8192
