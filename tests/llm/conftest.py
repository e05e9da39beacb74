"""Small tables with the awkward cases every operator must take."""

import pytest

from llm_samples import DOCUMENTS, odd_texts, sentence


@pytest.fixture(scope="session")
def odd_documents(spark):
    """Null, blank, tiny, repeated and long texts; a null id, a row twice, clashing names, many copies."""
    texts = odd_texts()
    rows = [(i * 3 + 1, t, None if i % 4 == 0 else "en", "src", None, "b", "p", "s", "q", {"a": "b"}) for i, t in enumerate(texts)]
    rows.append((None, "no id here", "en", None, 3, None, None, None, None, None))
    rows.append(rows[12])
    rows += [(1000 + i, "copy of one text that many rows share", "en", "hot", 1, None, None, None, None, None) for i in range(40)]
    return spark.createDataFrame(rows, DOCUMENTS).repartition(4)


@pytest.fixture(scope="session")
def no_documents(spark):
    return spark.createDataFrame([], DOCUMENTS)
