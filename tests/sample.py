"""A sample of 16 historical reviews with known report results.

The grid of products, scores and days is fixed; the texts are made up so that each has the
keyword flags noted next to it.
"""

# product, score, text, (has negative keyword, has positive keyword)
ROWS = [
    ("P001", 5, "A great cup, I love it", (False, True)),
    ("P002", 4, "Good beans", (False, True)),
    ("P003", 5, "Perfect as a gift, said \"everyone\"", (False, True)),
    ("P004", 2, "Stale and poor", (True, False)),
    ("P005", 3, "It is what it is", (False, False)),
    ("P006", 5, "Excellent and fresh", (False, True)),
    ("P007", 4, "Tasty,\nin a second line too", (False, True)),
    ("P008", 1, "The worst I had", (True, False)),
    ("P009", 4, "Would recommend", (False, True)),
    ("P010", 5, "Amazing", (False, True)),
    ("P011", 3, "good for evenings", (False, True)),
    ("P012", 2, "Came broken", (True, False)),
    ("P001", 5, "LOVE", (False, True)),
    ("P006", 2, "Good oil, broken cap", (True, True)),
    ("P003", 4, "A great snap", (False, True)),
    ("P008", 3, "not bad", (True, False)),
]
FIRST_SECOND = 1767225600  # 2026-01-01 00:00:00 UTC, then one review a day
DAY = 86400

HEADER = (
    "Id,ProductId,UserId,ProfileName,HelpfulnessNumerator,HelpfulnessDenominator,"
    "Score,Time,Summary,Text"
)


def csv_text(rows=None):
    lines = [HEADER]
    for number, (product, score, text, _) in enumerate(rows or ROWS, start=1):
        quoted = text.replace('"', '""')
        when = FIRST_SECOND + (number - 1) * DAY
        lines.append(f'{number},{product},U{1000 + number},Name,1,2,{score},{when},Sum,"{quoted}"')
    return "\n".join(lines) + "\n"
