from __future__ import annotations

import pytest

from clearwell.llm.common import let_workers_import

DOCUMENT = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def llm(spark):
    let_workers_import(spark)
    return spark


@pytest.fixture
def documents(llm):
    """Documents from (doc_id, text, lang, source) rows, with extra columns whose names operators use inside."""

    def make(rows):
        rows = [(*row, *[None] * (4 - len(row))) for row in rows]
        df = llm.createDataFrame([(i, t, lang, s, len(t or "")) for i, t, lang, s in rows], DOCUMENT)
        return df.selectExpr("*", "1 AS key", "2 AS size", "'x' AS row", "3 AS node", "4 AS draw", "5 AS component")

    return make
