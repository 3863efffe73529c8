from __future__ import annotations

import pytest

from tripforge.llm.ship import ship

#: Columns whose names the operators use themselves.
CLASHING = ["id", "row", "tie", "class", "score", "spans", "text_", "lang_pred", "token_ids", "component_id", "host"]


@pytest.fixture(autouse=True)
def shipped(spark):
    ship(spark)


@pytest.fixture
def make_documents(spark):
    """Documents of (doc_id, text, lang) rows, with further columns of clashing names."""

    def make(rows, extra: bool = True):
        schema = "doc_id long, text string, lang string, source string, n_chars long"
        values = [(i, t, lang, "s", len(t or "")) for i, t, lang in rows]
        if extra:
            schema += "".join(f", {c} string" for c in CLASHING)
            values = [(*v, *[f"x{v[0]}"] * len(CLASHING)) for v in values]
        return spark.createDataFrame(values, schema)

    return make


#: Nulls, empty and blank texts, ties, repeated rows, a repeated id, and a long text.
EDGES = [
    (1, None, "en"),
    (2, "", "en"),
    (3, " \t\n", None),
    (4, "12 34!", "en"),
    (5, "The cat sat on the mat, and the dog lay by the door of the old house near the river.", "en"),
    (6, "The cat sat on the mat, and the dog lay by the door of the old house near the river.", "en"),
    (6, "The cat sat on the mat, and the dog lay by the door of the old house near the river.", "en"),
    (7, "Der Hund lag vor der Tür des alten Hauses.", "de"),
    (7, "Un autre texte avec le même numéro.", "fr"),
    (None, "A text without an id, that is kept.", "en"),
    (8, "word " * 60_000, "en"),
    (9, "é" * 150_000, None),
]


@pytest.fixture
def edges():
    return list(EDGES)
