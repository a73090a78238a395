"""Five labs in three universities and a three-row taxonomy."""

from __future__ import annotations

from scholarmill import schemas

ROWS = [
    # category_id, category, field_id, field, sub_field_id, sub_field
    (1, "CS", 1, "AI", 1, "Machine learning"),
    (1, "CS", 2, "Systems", 2, "Databases"),
    (1, "CS", 2, "Systems", 3, "Computer security"),
]
UNIVERSITIES = [("u1", "Alpha"), ("u2", "Beta"), ("u3", "")]
LABS = [
    ("p1", "u1", 10, 20, [2, 1, 3]),
    ("p2", "u1", 5, 8, [99]),
    ("p3", "u2", 15, None, [1]),
    ("p4", "u2", 0, 0, []),
    ("p5", "u3", 50, 7, [2]),
]


def universities(spark):
    return spark.createDataFrame(UNIVERSITIES, schemas.UNIVERSITIES)


def labs(spark, rows=LABS):
    full = [
        (i, f"Lab {i}", "CS", papers, members, None, "", "https://dblp.org/x", university, ids)
        for i, university, papers, members, ids in rows
    ]
    return spark.createDataFrame(full, schemas.PROFESSORS)


def tuples(df) -> list[tuple]:
    return [tuple(r) for r in df.collect()]
