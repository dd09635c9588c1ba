"""Column names and types of the staging inputs and the warehouse tables.

Keys are BIGINT: row numbers of a 100 TB fact table do not fit an INT.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

LONG, INT, DOUBLE, TEXT, DATE = T.LongType(), T.IntegerType(), T.DoubleType(), T.StringType(), T.DateType()
MONEY = T.DecimalType(10, 2)


def columns(**types: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in types.items()])


DEPARTMENT = columns(department_id=LONG, department_name=TEXT)
SUB_BUDGET = columns(sub_dep_id=LONG, sub_dep_name=TEXT, department_id=LONG, budget=LONG)
RATE_RESPONSE = columns(rate_date=DATE, code=TEXT, rates=T.ArrayType(columns(mid=DOUBLE)))

DEPARTMENT_BUDGET = columns(department_id=LONG, department_name=TEXT, budget=T.DecimalType(38, 2))
CURRENCIES = columns(purchase_date=T.TimestampNTZType(), usd_price=DOUBLE, ils_price=DOUBLE)

DIM_PLAYLIST = columns(playlist_id=LONG, playlist_name=TEXT, track_id=LONG, last_update=DATE)
DIM_TRACK = columns(
    trackid=LONG,
    track_name=TEXT,
    albumid=LONG,
    mediatypeid=LONG,
    mediatype_name=TEXT,
    last_update=DATE,
    genreid=LONG,
    genre_last_update=DATE,
    composer=TEXT,
    unitprice=MONEY,
    mediatype_last_update=DATE,
    seconds=INT,
    track_duration=TEXT,
    genre_name=TEXT,
    album_name=TEXT,
    album_last_update=DATE,
    artistid=LONG,
    artist_name=TEXT,
    artist_last_update=DATE,
)
FACT_INVOICE = columns(
    invoiceid=LONG,
    customerid=LONG,
    invoicedate=DATE,
    billingaddress=TEXT,
    billingcity=TEXT,
    billingstate=TEXT,
    billingcountry=TEXT,
    billingpostalcode=TEXT,
    total=MONEY,
    last_update=DATE,
)
FACT_INVOICELINE = columns(
    invoiceline_id=LONG,
    invoice_id=LONG,
    track_id=LONG,
    unitprice=MONEY,
    quantity=INT,
    last_update=DATE,
    line_total=MONEY,
)
CUSTOMER_EXTRA = columns(email_domain=TEXT)
EMPLOYEE_EXTRA = columns(
    department_name=TEXT, department_budget=INT, years_employed=TEXT, is_manager=INT, email_domain=TEXT
)


# fixed values: declared lengths of text columns; Spark's string has none, so a check looks after them
MAX_LENGTHS = {
    "dim_playlist": {"playlist_name": 255},
    "dim_track": {"track_name": 255, "track_duration": 5, "composer": 255},
    "fact_invoice": {
        "billingaddress": 70,
        "billingcity": 40,
        "billingstate": 40,
        "billingcountry": 40,
        "billingpostalcode": 10,
    },
}


def clone_schema(source: T.StructType, extra: T.StructType | None = None) -> T.StructType:
    """The columns of ``source`` followed by those of ``extra``."""
    return T.StructType(list(source.fields) + (list(extra.fields) if extra else []))


def conform(df: DataFrame, schema: T.StructType, only: tuple[str, ...] = ()) -> DataFrame:
    """Select ``schema``'s columns by name and cast them; a column ``df`` lacks is NULL.

    With ``only`` just those are kept, so that Catalyst prunes the rest.
    """
    have = {name.lower() for name in df.columns}
    wanted = {name.lower() for name in only}
    return df.select(
        *(
            (F.col(field.name) if field.name.lower() in have else F.lit(None)).cast(field.dataType).alias(field.name)
            for field in schema.fields
            if not wanted or field.name.lower() in wanted
        )
    )
