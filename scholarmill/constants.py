"""Constant relations and texts. Every size here is fixed, so all of it may be broadcast or inlined."""

from __future__ import annotations

# ---- Fixed values: must equal the published data set -------------------------------------------

CATEGORY_ID = 1
CATEGORY = "CS"

FIELDS: dict[str, list[str]] = {
    "AI": [
        "Artificial intelligence",
        "Computer vision",
        "Machine learning",
        "Natural language processing",
        "The Web & information retrieval",
    ],
    "Systems": [
        "Computer architecture",
        "Computer networks",
        "Computer security",
        "Databases",
        "Design automation",
        "Embedded & real-time systems",
        "High-performance computing",
        "Mobile computing",
        "Measurement & perf. analysis",
        "Operating systems",
        "Programming languages",
        "Software engineering",
    ],
    "Theory": [
        "Algorithms & complexity",
        "Cryptography",
        "Logic & verification",
    ],
    "Interdisciplinary Areas": [
        "Comp. bio & bioinformatics",
        "Computer graphics",
        "Computer science education",
        "Economics & computation",
        "Human-computer interaction",
        "Robotics",
        "Visualization",
    ],
    "etc": [
        "Uncategorized",
    ],
}

UNCATEGORIZED_ID = 55

# (area id, area name, sub-field ids)
AREAS: list[tuple[str, str, list[int]]] = [
    ("ai", "AI", [1, 2, 3, 4, 5]),
    ("systems", "Systems", [6, 7, 8, 9, 10, 11, 12, 13, 14, 15, 16, 17]),
    ("theory", "Theory", [18, 19, 20]),
    ("interdisciplinary", "Interdisciplinary Areas", [21, 22, 23, 24, 25]),
    ("etc", "etc", [UNCATEGORIZED_ID]),
]

LARGE_LAB = 20
MEDIUM_LAB = 8
UNKNOWN = "알 수 없음"
SIZE_LABELS = {"large": "대형", "medium": "중형", "small": "소형", "unknown": UNKNOWN}
SIZE_CRITERIA = {"small": "7명 이하", "medium": "8-19명", "large": "20명 이상", "unknown": UNKNOWN}
NO_FIELDS_TEXT = "정보 없음"
MIN_PASSWORD_LENGTH = 6

# Texts by which a failed sign-in or sign-up is recognised, in order of precedence.
AUTH_MESSAGE_RULES: list[tuple[str, str]] = [
    ("Invalid login credentials", "bad_credentials"),
    ("Email not confirmed", "email_unconfirmed"),
    ("already registered", "already_registered"),
]

# White space removed by trimming: the ECMAScript set, written as a regex class body.
TRIM_CLASS = (
    r"\t\n\x0b\f\r \x{00a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}\x{feff}"
)

# ---- Derived from the fixed values -------------------------------------------------------------


def taxonomy_rows() -> list[tuple[int, str, int, str, int, str]]:
    """(category_id, category, field_id, field, sub_field_id, sub_field); ids follow listing order."""
    rows = []
    next_id = 1
    for field_id, (field, sub_fields) in enumerate(FIELDS.items(), start=1):
        for sub_field in sub_fields:
            sub_field_id = UNCATEGORIZED_ID if field == "etc" else next_id
            next_id += 1
            rows.append((CATEGORY_ID, CATEGORY, field_id, field, sub_field_id, sub_field))
    return rows
