import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, `set` long, n long, segment long, offset long"


@pytest.fixture
def documents(spark):
    """Rows (doc_id, text[, source]) as documents, with more columns whose names the operators use inside."""

    def make(rows):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or ""), 1, 2, 3, 4) for r in rows]
        return spark.createDataFrame(full, SCHEMA)

    return make


@pytest.fixture(scope="session")
def corpus():
    """Texts with copies, near copies, empty and null ones, one id on two texts, a repeated row, a null id, a long text."""
    rng = random.Random(7)
    words = [a + b for a in ("ka", "lo", "mi", "nu", "re", "so", "ti") for b in ("ba", "de", "fi", "go", "ÿa")]

    def text(n):
        return " ".join(rng.choice(words) + rng.choice(["", "", ",", ".\n"]) for _ in range(n))

    rows = [(k, text(rng.choice((1, 3, 12, 60, 150)))) for k in range(40)]
    base = text(200)
    for k in range(40, 60):  # near copies
        parts = base.split(" ")
        for _ in range(rng.randrange(6)):
            parts[rng.randrange(len(parts))] = rng.choice(words)
        rows.append((k, " ".join(parts)))
    rows += [(60, rows[5][1]), (61, rows[5][1].upper()), (62, ""), (63, None), (64, "  \n\t"), (65, text(6000)), (66, rows[41][1])]
    rows += [(2, text(30)), (3, rows[3][1]), (None, text(20)), (None, base)]
    return rows
