import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from lodestone.session import local_session

    session = local_session(8)
    session.conf.set("spark.sql.shuffle.partitions", "4")
    session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoints")))
    yield session
    session.stop()


@pytest.fixture
def make_files(spark):
    def make(named: dict, repo="repo", branch="main"):
        from lodestone import schema

        rows = [
            (repo, branch, path, bytearray(c.encode() if isinstance(c, str) else c))
            for path, c in named.items()
        ]
        return spark.createDataFrame(rows, schema.FILES)

    return make
