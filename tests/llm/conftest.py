from __future__ import annotations

import random

import pytest

from conftest_llm import ODD_TEXTS, words

@pytest.fixture(scope="session")
def corpus():
    """(doc_id, text) with odd texts, copies, near copies, a null id and a repeated row."""
    rng = random.Random(5)
    rows = list(enumerate(ODD_TEXTS))
    base = words(rng, 120)
    rows += [(100 + k, base) for k in range(6)]
    for k in range(6):
        edited = base.split()
        edited[10 * k + 5] = f"edit{k}"
        rows.append((200 + k, " ".join(edited).upper() if k % 2 else " ".join(edited)))
    rows += [(300 + k, words(rng, rng.randint(1, 400))) for k in range(60)]
    return [*rows, (None, "a row without an id"), (300, rows[-60][1])]


@pytest.fixture(scope="session")
def docs(spark, corpus):
    """The corpus with columns whose names operators might want for themselves."""
    rows = [(i, t, "lang", 1, "x") for i, t in corpus]
    names = "doc_id long, text string, shard string, slot long, contaminated string"
    return spark.createDataFrame(rows, names).repartition(5)


@pytest.fixture(scope="session")
def nothing(docs):
    return docs.limit(0)
