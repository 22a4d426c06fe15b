import pytest
from edge_cases import ROWS, SCHEMA


@pytest.fixture(scope="session")
def docs(spark):
    """Edge cases, with further columns whose names the operators use themselves."""
    wide = [(*row, i, f"x{i}", i) for i, row in enumerate(ROWS)]
    return spark.createDataFrame(wide, SCHEMA + ", size int, shard string, part int").cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
