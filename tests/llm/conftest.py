from __future__ import annotations

import pytest

SF = "/root/testdata/sf0.01"
SF_SMALL = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session", autouse=True)
def workers(spark):
    from tabsmith.llm.common import let_workers_import

    let_workers_import(spark)


def docs_of(spark, texts, extra=None):
    """Documents table from texts (None allowed), ids from 0; ``extra`` adds columns that clash with results."""
    rows = [(i, t, ("en", "fr")[i % 2], ("a", "b", None)[i % 3], len(t or "")) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, DOCS)
    return df.selectExpr("*", *extra) if extra else df


CLASHING = ["1 as size", "2 as target", "'x' as rule", "3 as score", "4 as node", "5 as rank", "6 as number", "7 as task",
            "8 as length", "'y' as registers", "9 as kept", "10 as source_size", "11 as copies", "12 as part", "13 as kind"]
