import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

from floodplan.llm.text import small_batches  # noqa: E402


@pytest.fixture(autouse=True)
def batches(spark):
    small_batches(spark)
