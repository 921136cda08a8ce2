import os
import shutil
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from mercato.session import local_session

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folders = {
        "spark.checkpoint.dir": tmp_path_factory.mktemp("shared").as_uri(),
        "spark.sql.warehouse.dir": tmp_path_factory.mktemp("warehouse").as_uri(),
    }
    session = local_session(8, "tests", **folders)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def shop(spark):
    from mercato.sources.shop import Shop

    return Shop(spark, SF)


def copied(folder, *without):
    """A writable folder with the given tables, but for those named."""
    os.makedirs(folder)
    for name in os.listdir(SF):
        if name.removesuffix(".parquet") not in without:
            shutil.copyfile(f"{SF}/{name}", f"{folder}/{name}")
    return folder


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def final_plan(df) -> str:
    """The physical plan after adaptive execution."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
