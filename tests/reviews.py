"""A small file with one row per edge case."""

COLUMNS = (
    "marketplace", "customer_id", "review_id", "product_id", "product_category", "star_rating", "helpful_votes",
    "total_votes", "vine", "verified_purchase", "review_headline", "review_body", "review_date",
)
DAY = "2015-08-31"
# customer, review, rating, helpful, total, verified, headline, body, date
ROWS = (
    ("1", "R1", "5", "0", "0", "Y", '"q head', 'body "x" back\\slash', DAY),
    ("2", "R2", "1", "0", "0", "N", "h", "one star", DAY),
    ("3", "R3", "2", "9", "3", "y", "h", "inverted", DAY),
    ("4", "R4", "4", "1", "2", "Y", "h", "None", DAY),
    ("5", "R5", "4", "1", "2", "y", "h", "short row"),
    ("6", "R6", "4", "1", "2", "Y", "h", "long row", DAY, "extra"),
    None,
    ("7", "R1", "3", "1", "2", "Y", "h", "dup key", DAY),
    ("8", "R8", "abc", "1", "2", "Y", "h", "bad rating", DAY),
    ("9", "R9", "4.5", "1", "2", "Y", "h", "frac", "08/31/2015"),
    ("10", "", "5", "1", "2", "Y", "h", "null key a", "notadate"),
    ("11", "", "5", "1", "2", "Y", "h", "null key b", DAY),
    ("12", "R12", " 5 ", "1", "2", "Y", "h", "padded", DAY),
    ("13", "R13", "5", "300", "301", "Y", "h", "   ", DAY),
    ("14", "R14", "5", "", "3", "Y", "h", "null votes", DAY),
)
KEPT = ("1", "5", "9", "10", "12", "13")


def line(row):
    if row is None:
        return ""
    customer, review, rating, helpful, total, verified, *rest = row
    product = "0439784549" if customer == "1" else customer.rjust(10, "0")
    return "\t".join(["US", customer, review, product, "Books", rating, helpful, total, "N", verified, *rest])


def text(rows=ROWS, columns=COLUMNS):
    return "\n".join(["\t".join(columns), *map(line, rows)]) + "\n"


def plain(n, start=0):
    """Rows without any fault."""
    return [(str(i), f"K{i}", "4", "1", "2", "Y", "h", f"text {i}", DAY) for i in range(start, start + n)]
