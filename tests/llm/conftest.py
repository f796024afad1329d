import pytest


@pytest.fixture(scope="session")
def brute():
    """DuckDB over one data directory's tables."""
    from tests.oracle_check import duck
    return duck
