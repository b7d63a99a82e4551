import pytest

from lexmill.plans.runtime import session


@pytest.fixture(scope="session")
def spark():
    return session("local[4]", "tests", **{"spark.sql.shuffle.partitions": "4", "spark.driver.memory": "4g"})
