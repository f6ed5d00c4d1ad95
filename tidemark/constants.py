"""They must equal the published data format for results to match."""

# Text that a delimited scan reads as null.
NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None",
    "n/a", "nan", "null",
)

# Columns a review file must have.
REQUIRED_COLUMNS = (
    "review_id", "customer_id", "product_id", "product_category", "review_body",
    "review_headline", "star_rating", "verified_purchase", "review_date",
)

# Columns by the way they are coerced.
FLAG_COLUMNS = ("vine", "verified_purchase")
NUMBER_COLUMNS = ("star_rating", "helpful_votes", "total_votes")
DATE_COLUMNS = ("review_date",)

# The flag spelling, the rating bounds, the text columns that must be present.
FLAG_TRUE, FLAG_FALSE = "Y", "N"
RATING_LOW, RATING_HIGH = 1, 5
TEXT_COLUMNS = ("review_body",)
DEDUP_KEYS = ("review_id",)

# File naming and layout.
CATEGORY_PATTERN = r"amazon_reviews_us_([A-Za-z0-9_\-]+)_v"
UNKNOWN_CATEGORY = "Unknown"
CHUNK_ROWS = 200_000
COMPRESSION = "snappy"
LAYOUT = ("year", "month", "category", "source_file", "file_id")
DATASET_KEY = "AMAZON_DATASET_FULLY_INGESTED"

# The known categories.
CATEGORIES = (
    "Apparel", "Automotive", "Baby", "Beauty", "Books", "Camera",
    "Digital_Ebook_Purchase", "Digital_Music_Purchase", "Digital_Software",
    "Digital_Video_Download", "Digital_Video_Games", "Electronics", "Furniture",
    "Gift_Card", "Grocery", "Health_Personal_Care", "Major_Appliances",
    "Mobile_Apps", "Mobile_Electronics", "Music", "Musical_Instruments",
    "Office_Products", "Outdoors", "PC", "Personal_Care_Appliances",
    "Pet_Products", "Shoes", "Software", "Sports", "Tools", "Toys", "Unknown",
    "Video", "Video_DVD", "Video_Games", "Watches", "Wireless",
)

# A number as the numeric cast accepts it (Spark's own cast would also take '5d' and '5f').
NUMBER_PATTERN = r"^\s*[+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?\s*$|^[+-]?(?i:inf|infinity)$"
DATE_FORMAT = "yyyy-MM-dd"
