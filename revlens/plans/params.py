"""Parameters that bind the operators to the test tables.

The reference hard-codes a province, a city, a cuisine list, k = 10, bucket
width 10, a rating threshold of 3, 50 users and today's date. Here they are
arguments of the operators; these are the values used by the registered
queries on the stand-in data (see plans/views.py for the mapping).
"""

PROVINCE = "MEDIUM"          # a p_type value: business state
CITY = "Brand#1"             # a p_brand value: business city
CITY_LIKE = "%Brand#1%"      # the geo analyses match the city by pattern
CATEGORY_LIKE = "%hot%"      # and the cuisine by pattern
# Category words of the stand-in businesses that play the cuisine list.
CUISINES = ["small", "hot", "widget", "gear", "red", "blue", "bolt", "ring", "rod", "gizmo",
            "anvil", "FoodCourt"]
TOP_K = 10
BUCKET_WIDTH = 10
ATTR_MAIN_KEY = "WiFi"
ATTR_SUBSET_KEY = "Ambience"
TEXT_CITY = "Toronto"
RATING_THRESHOLD = 3.0
LEXICON_LEAST = 5            # reviews that hold a word of a learnt lexicon
N_USERS = 50
TOP_N = 10
AS_OF_DATE = "2024-06-30"    # the reference's current_date, fixed for reproducibility
GROUP_COLUMNS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
CHUNK_CHARS = 20_000         # characters of a chunk of a merged text
LDA_K = 6
LDA_SEED = 123
SPLIT_SEED = 42
