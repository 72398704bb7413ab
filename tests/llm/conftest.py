import os

import pytest

SF = "/root/testdata/sf0.001"


def pytest_collection_modifyitems(items):
    for item in items:
        if "sf" in item.fixturenames and not os.path.isdir(SF):
            item.add_marker(pytest.mark.skip(reason="driver tables are absent"))


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents from texts, with ids from 0 and clashing extra columns."""

    def make(texts, ids=None, **extra):
        ids = list(range(len(texts))) if ids is None else ids
        rows = [(i, t, "en", f"src{k % 3}", 1, True) for k, (i, t) in enumerate(zip(ids, texts, strict=True))]
        return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, row int, kept boolean")

    return make
