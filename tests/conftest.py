import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from watchtide.session import get_spark
    s = get_spark("local[4]", app="watchtide-tests", shuffle_partitions=4,
                  conf={"spark.sql.adaptive.coalescePartitions.minPartitionSize": "1"})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    from watchtide.session import clear_scratch
    clear_scratch(s)
    s.stop()


@pytest.fixture()
def tmp_dir(tmp_path):
    return str(tmp_path)


def ts(s):
    import datetime as dt
    return dt.datetime.fromisoformat(s)


def rows(df, *cols):
    cols = cols or df.columns
    def key(t):  # NULLs sort last
        return tuple((True, 0) if v is None else (False, v) for v in t)
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=key)
