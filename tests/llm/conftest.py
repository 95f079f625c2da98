import random

import pytest

DOC_SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
WORDS = [a + b for a in ("ba", "ko", "ri", "tu", "me", "sa") for b in ("na", "lo", "ki", "ru", "te", "po", "vi")]


@pytest.fixture(scope="session")
def make_docs(spark):
    def make(rows, extra=()):
        """rows: (doc_id, text[, source[, lang]]); extra: names of more columns, to clash with."""
        full = [(r[0], r[1], r[3] if len(r) > 3 else "en", r[2] if len(r) > 2 else "s0", len(r[1] or "")) for r in rows]
        df = spark.createDataFrame(full, DOC_SCHEMA)
        for c in extra:
            df = df.selectExpr("*", f"'x' AS `{c}`")
        return df
    return make


@pytest.fixture()
def prose():
    rng = random.Random(7)

    def make(n):
        return " ".join(rng.choice(WORDS) + rng.choice(["", "", "", ".", ","]) for _ in range(n))
    make.rng = rng
    return make


def edge_rows(long_text):
    """Nulls, empty and blank texts, repeated rows, ties and a very long text."""
    return [(None, "null id text here"), (1, None, None), (2, "", "s1"), (3, " \t\n", "s1"), (4, "same text twice over"),
            (4, "same text twice over"), (5, "same text twice over", "s2"), (6, long_text), (7, "é ñ ü ß 漢字 🙂", "s2")]
