from __future__ import annotations

import contextlib
import io

import pytest

from clearwell.session import local_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    # Four cores, and up to three attempts per task.
    folder = str(tmp_path_factory.mktemp("shared"))
    return local_session("tests", cores="4,3", partitions=4, folder=folder)


@pytest.fixture
def plan_of():
    """Physical plan of a DataFrame as text."""

    def plan(df) -> str:
        text = io.StringIO()
        with contextlib.redirect_stdout(text):
            df.explain("formatted")
        return text.getvalue()

    return plan


@pytest.fixture
def rows():
    """Rows of a DataFrame as a sorted list of tuples."""

    def sorted_rows(df):
        return sorted((tuple(r) for r in df.collect()), key=repr)

    return sorted_rows
