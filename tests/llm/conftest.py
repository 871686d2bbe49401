import pytest

from ledgerline.llm.ship import ship


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    ship(spark)
