from __future__ import annotations

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
PHRASE = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"
OTHER = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma"


@pytest.fixture(scope="session")
def documents(spark):
    """Frames of documents from (doc_id, text[, source]); other columns are filled or clash."""

    def build(rows, clash=()):
        whole = [
            (r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or "")) for r in rows
        ]
        df = spark.createDataFrame(whole, DOCS)
        for name in clash:
            df = df.selectExpr("*", f"'x' as `{name}`")
        return df

    return build


@pytest.fixture(scope="session")
def awkward():
    """Nulls, empties, white space, repeated rows, ties and a long text."""
    return [
        (5, PHRASE),
        (1, PHRASE + " and more"),
        (1, PHRASE + " and more"),
        (2, None),
        (3, ""),
        (4, " \t\n\x0b\x0c\r "),
        (None, PHRASE),
        (7, OTHER),
        (8, OTHER.upper()),
        (9, "  " + OTHER.replace(" ", "\n")),
        (10, "word"),
        (11, "Word"),
        (12, " ".join(f"w{k % 97}x{k % 89}" for k in range(30_000))),
        (13, "é é   a b   naïve \U0001f600"),
    ]
