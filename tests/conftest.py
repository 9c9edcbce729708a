from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from lapstack.session import GROUP_ROWS, local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folders = {
        "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
    }
    session = local_session(8, 2, "6g", **folders)
    yield session
    session.stop()


@pytest.fixture
def tiny_groups(spark):
    """Window groups above three rows count as hot."""
    spark.conf.set(GROUP_ROWS, "3")
    yield
    spark.conf.unset(GROUP_ROWS)


def rows(df, *columns):
    """Rows as sorted tuples of the named columns."""
    shown = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in shown.collect()), key=repr)
