import pytest


@pytest.fixture(scope="session")
def lspark(spark):
    from lossledger.llm.frames import prepared

    return prepared(spark)
