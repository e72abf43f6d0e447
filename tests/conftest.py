import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from rillmart import session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    built = session.build(
        "tests", "local[4]",
        **{"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.driver.memory": "4g",
           "spark.checkpoint.dir": tempfile.mkdtemp(prefix="rillmart-checkpoints-")},
    )
    built.sparkContext.setLogLevel("ERROR")
    yield built
    built.stop()


@pytest.fixture
def rows():
    """Rows of a frame as a sorted list of tuples."""

    def collect(df, *columns):
        return sorted((tuple(row) for row in df.select(*(columns or df.columns)).collect()), key=str)

    return collect


@pytest.fixture
def feed(spark, tmp_path):
    """A file stream that reads one written batch per micro-batch, in the given order."""

    def build(name, *batches):
        folder = str(tmp_path / name)
        for number, batch in enumerate(batches):
            batch.coalesce(1).write.mode("append").parquet(folder)
            for entry in os.listdir(folder):
                if entry.endswith(".parquet"):
                    path = os.path.join(folder, entry)
                    if not hasattr(build, "seen") or path not in build.seen:
                        build.seen = getattr(build, "seen", set()) | {path}
                        os.utime(path, (1_700_000_000 + number * 10,) * 2)
        return spark.readStream.schema(batches[0].schema).option("maxFilesPerTrigger", 1).parquet(folder)

    return build
