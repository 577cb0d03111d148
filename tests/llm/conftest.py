from __future__ import annotations

import pytest

from samples import EDGE, SCHEMA, edited, prose


@pytest.fixture
def rows():
    """Edge cases, exact and near copies, a shared passage, equal rows."""
    base, passage = prose(1, 120), prose(2, 40)
    texts = EDGE + [base, base, edited(base, 1, 0.03), edited(base, 2, 0.05), edited(base, 3, 0.3)]
    texts += [f"{prose(10 + i, 30)} {passage} {prose(50 + i, 30)}" for i in range(8)]
    return [(i, t, "en", f"s{i % 3}", len(t or "")) for i, t in enumerate(texts)]


@pytest.fixture
def frame(spark):
    def build(rows, schema=SCHEMA):
        return spark.createDataFrame(rows, schema)

    return build


@pytest.fixture
def clashing(spark, frame):
    """The same rows with columns that bear the names the operators add or use inside."""
    def build(rows):
        df = frame(rows)
        for name in ("doc", "id", "row", "sum", "n_words", "kept", "spans", "items", "score", "slot", "group", "words",
                     "host", "component_id", "start", "length", "label", "meta", "part", "tie", "window"):
            df = df.selectExpr("*", f"'{name}' AS {name}")
        return df

    return build
