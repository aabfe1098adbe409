"""Cumulative landings are joined once: what follows reads the landing and not its sources."""

import os
import shutil

import pytest

from paddock import session
from paddock.plans import build
from paddock.plans import maintenance as mt

from .conftest import SF_SMALL, rows


@pytest.fixture()
def sources(tmp_path, monkeypatch):
    """A copy of the tables whose lineitem is gone once something was landed from it."""
    d = str(tmp_path / "sf")
    shutil.copytree(SF_SMALL, d)
    os.chmod(d, 0o755)
    path, land = f"{d}/lineitem.parquet", session.stored

    def stored(df, purpose):
        out = land(df, purpose)
        if purpose.startswith("landed") and any(path in f for f in df.inputFiles()):
            os.chmod(path, 0o644)
            with open(path, "wb") as f:
                f.write(b"not parquet")
        return out

    monkeypatch.setattr(mt, "stored", stored)
    monkeypatch.setattr(build, "stored", stored)
    return d


def test_incremental_results_join_once(spark, sources):
    want = rows(mt.incremental_results(spark, SF_SMALL))
    assert rows(mt.incremental_results(spark, sources)) == want and len(want) > 1000


def test_incremental_laps_join_once(spark, sources):
    want = rows(mt.incremental_laps(spark, SF_SMALL))
    assert rows(mt.incremental_laps(spark, sources)) == want and len(want) > 100


def test_streamed_landings_join_once(spark, sources):
    want = rows(mt.incremental_results(spark, SF_SMALL))
    assert rows(mt.stream_incremental_results(spark, sources)) == want


def test_a_warehouse_of_three_batches_joins_once(spark, sources):
    want = rows(build.warehouse_driver_standings(spark, SF_SMALL))
    assert rows(build.warehouse_driver_standings(spark, sources)) == want and len(want) > 10
