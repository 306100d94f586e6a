import pytest

from tidemark.llm import ship
from tidemark.session import work_dir


@pytest.fixture(autouse=True)
def _ready(spark):
    work_dir(spark)
    ship(spark)
