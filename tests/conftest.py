import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from rosterlift import RunContext, discard_durables, get_session  # noqa: E402
from rosterlift.session import scratch_root  # noqa: E402


def kept_folders(session, root):
    """Folders of intermediate tables that this library has made under ``root``."""
    folder = Path(root.removeprefix("file:"))
    return sorted(p.name for p in folder.iterdir() if p.name.startswith(("run-", "durable-"))) if folder.exists() else []


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = get_session("tests", "local[4]", **{
        "spark.sql.shuffle.partitions": "4", "spark.driver.memory": "4g",
        "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse"))})
    session.sparkContext.setLogLevel("ERROR")
    before = kept_folders(session, scratch_root(session))
    yield session
    discard_durables(session)
    left = [name for name in kept_folders(session, scratch_root(session)) if name not in before]
    session.stop()
    assert left == []


@pytest.fixture
def ctx():
    from datetime import datetime
    return RunContext("acme", "agency-1", "master-0", "corp.example.com", datetime(2024, 6, 30, 12))


@pytest.fixture
def values(spark):
    """Apply a column expression to a list of texts and return the results in order."""
    from pyspark.sql import functions as F

    def run(make, texts, kind="string"):
        df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], f"i int, v {kind}")
        return [r[0] for r in df.select(make(F.col("v")).alias("out"), "i").orderBy("i").select("out").collect()]
    return run
