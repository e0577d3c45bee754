"""One local session, the five-row subscriber fixture and its processed forms."""

from __future__ import annotations

import pathlib
import sys

import pytest

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[1]))

from loyalscope import schema  # noqa: E402
from loyalscope.operators import cleaning  # noqa: E402
from loyalscope.plans import churn  # noqa: E402
from loyalscope.session import local_session  # noqa: E402

COLUMNS = schema.RAW.fieldNames()
FIVE = [  # invented; every value of every coded column occurs
    ("ann", "Female", 0, "No", "Yes", 3, "Yes", "Yes", "Fiber optic", "Yes", "No", "Yes", "No", "Yes", "No",
     "Month-to-month", "No", "Mailed check", 71.10, "213.30", "Yes"),
    ("bo", "Male", 0, "Yes", "Yes", 30, "Yes", "No", "DSL", "No", "Yes", "No", "Yes", "No", "Yes",
     "Two year", "Yes", "Credit card (automatic)", 44.00, "1320.00", "No"),
    ("cy", "Female", 1, "No", "No", 60, "Yes", "No", "No", *["No internet service"] * 6,
     "One year", "No", "Electronic check", 20.50, "1230.00", "No"),
    ("di", "Male", 0, "No", "No", 9, "No", "No phone service", "DSL", "Yes", "Yes", "No", "No", "No", "No",
     "Month-to-month", "Yes", "Bank transfer (automatic)", 33.30, " \t", "No"),
    ("ed", "Female", 1, "Yes", "No", 15, "Yes", "Yes", "Fiber optic", "No", "No", "Yes", "Yes", "Yes", "Yes",
     "One year", "Yes", "Electronic check", 101.25, "1518.75", "Yes"),
]


@pytest.fixture(scope="session")
def spark():
    return local_session(8, "loyalscope-tests", memory="6g")


def subscribers(spark, *changes):
    """The five rows, then copies of the first with the given changes."""
    base = dict(zip(COLUMNS, FIVE[0]))
    rows = FIVE + [tuple({**base, **change}[c] for c in COLUMNS) for change in changes]
    return spark.createDataFrame(rows, schema.RAW)


@pytest.fixture(scope="session")
def raw(spark):
    return subscribers(spark)


@pytest.fixture(scope="session")
def cleaned(raw):
    return cleaning.clean(raw)


@pytest.fixture(scope="session")
def featured(raw):
    return churn.transform(raw)


def by_key(df, key="customerID"):
    return {row[key]: row for row in df.collect()}
