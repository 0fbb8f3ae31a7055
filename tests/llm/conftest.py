import pytest

from carelens.llm.common import on_workers


@pytest.fixture(autouse=True, scope="session")
def package_on_workers(spark):
    on_workers(spark)
