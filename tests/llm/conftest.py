import os
import random

import duckdb
import pytest

SMALL = "/root/testdata/sf0.001"
TABLES = "documents embeddings pages benchmark labels conversations".split()
# column names that operators use inside
CLASHES = "fp id node component u v size score row text_ target taken __size __key __bin __plan __row number found names term df".split()


@pytest.fixture(scope="session")
def small():
    return SMALL


@pytest.fixture(scope="session")
def con():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{os.path.join(SMALL, name)}.parquet'")
    return con


@pytest.fixture(scope="session")
def awkward_rows():
    """(doc_id, text, source): nulls, empty and very long texts, ties, repeated rows."""
    rng = random.Random(5)
    vocabulary = ["alpha", "Beta", "gamma.", "delta", "é", "zeta,", "eta!", "theta"]
    long = " ".join(rng.choice(vocabulary) for _ in range(40_000))
    prose = " ".join(rng.choice(vocabulary) for _ in range(80))
    return [
        (1, None, "a"),
        (2, "", "a"),
        (3, " \n\t ", None),
        (4, "one", "b"),
        (5, "one two", "b"),
        (6, long, "b"),
        (7, prose, "a"),
        (8, prose, "c"),
        (8, prose, "c"),
        (9, prose + " extra", None),
        (None, prose, "a"),
        (None, None, None),
        (10, "x\n" * 50, "a"),
        (11, "mail me: a.b@example.org or +1 (555) 555-0100\nReleased under the MIT License.", "a"),
        (12, "é" * 3000 + "😀 ỹ   end", "a"),
    ]


@pytest.fixture(scope="session")
def awkward(spark, awkward_rows):
    rows = [(*r, len(r[1]) if r[1] is not None else None, *range(len(CLASHES))) for r in awkward_rows]
    schema = ", ".join(["doc_id bigint, text string, source string, n_chars bigint", *(f"`{c}` int" for c in CLASHES)])
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="session")
def nothing(awkward):
    return awkward.limit(0)
