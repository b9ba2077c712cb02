import pytest

SCHEMA = "doc_id long, text string, lang string, source string, h1 long, sha string, name string, hits string, spans string, score string, n long, id string, _id string"


@pytest.fixture(scope="session")
def frame(spark):
    """Document rows (doc_id, text[, lang]) with extra columns whose names the operators use themselves."""
    def make(rows, parts=3):
        full = [(r[0], r[1], r[2] if len(r) > 2 else None, "s", 1, "x", "y", "h", "p", "q", 2, "i", "j") for r in rows]
        return spark.createDataFrame(full, SCHEMA).repartition(parts)
    return make


@pytest.fixture(scope="session")
def prose():
    """Reproducible invented prose: words(n, seed) -> list of words."""
    import random

    def words(n, seed=0):
        rng = random.Random(seed)
        return ["".join(rng.choice("bcdfglmnprst") + rng.choice("aeiou") for _ in range(rng.randint(1, 4))) for _ in range(n)]
    return words
