import pytest

from millrace.session import Scratch, local_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    checkpoints = tmp_path_factory.mktemp("checkpoints")
    session = local_session(4, shuffle_partitions=3, **{"spark.checkpoint.dir": str(checkpoints)})
    yield session
    session.stop()


@pytest.fixture
def scratch(spark):
    return Scratch(spark)


@pytest.fixture
def rows():
    """Rows of a frame as plain tuples, in a fixed order."""

    def collect(df, *columns):
        picked = df.select(*columns) if columns else df
        return sorted((tuple(r) for r in picked.collect()), key=lambda t: [str(x) for x in t])

    return collect
