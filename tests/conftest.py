import pytest

from tallyloom.session import local_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = tmp_path_factory.mktemp("shared")
    session = local_session(
        4,
        **{
            "spark.checkpoint.dir": str(folder),
            "spark.sql.shuffle.partitions": "3",
            "spark.default.parallelism": "2",
            "spark.driver.memory": "4g",
        },
    )
    yield session
    session.stop()


@pytest.fixture
def rows():
    """Rows of a frame as a sorted list of tuples."""

    def collected(df, *columns):
        found = df.select(*columns) if columns else df
        return sorted((tuple(r) for r in found.collect()), key=repr)

    return collected
