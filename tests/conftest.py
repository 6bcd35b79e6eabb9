import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from salesflow.session import build_session  # noqa: E402
from salesflow.sources import sales_from_rows  # noqa: E402

# Fixture A, for the partitioned load and the ETL: every band edge, rows that differ in their id only, a category
# with a space, capitals to even out, and months on either side of the zero padding.
FIXTURE_A = [
    (1, "2021-10-31", "wall clock", 1000.0, "home goods"),
    (2, "2021-10-02", "OIL lamp", 299.99, "home goods"),
    (3, "2022-01-09", "kettle", 300.0, "home goods"),
    (4, "2022-01-09", "kettle", 300.0, "home goods"),
    (5, "2022-01-30", "gravel bike", 2499.5, "sport"),
    (6, "2021-10-17", "yoga mat", 20.25, "sport"),
]

# Fixture B, for the aggregate job: first and last days of months, groups of one and two rows, a category with an
# ampersand, and averages that need cents.
FIXTURE_B = [
    (1, "2023-02-28", "novel", 12.5, "books"),
    (2, "2023-02-01", "atlas", 40.0, "books"),
    (3, "2023-12-24", "puzzle", 15.0, "toys & games"),
    (4, "2023-12-25", "kite", 15.0, "toys & games"),
    (5, "2023-12-31", "comic", 5.75, "books"),
    (6, "2023-02-14", "drum", 60.0, "toys & games"),
]


@pytest.fixture(scope="session")
def spark():
    session = build_session("local[*]", shuffle_partitions=8, app="salesflow-tests")
    yield session


@pytest.fixture
def fixture_a(spark):
    return sales_from_rows(spark, FIXTURE_A)


@pytest.fixture
def fixture_b(spark):
    return sales_from_rows(spark, FIXTURE_B)
