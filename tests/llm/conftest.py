import pytest

from ratecal.llm.ship import ship


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    ship(spark)
