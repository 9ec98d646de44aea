import pytest

#: Columns of documents and some more whose names the operators use inside.
DOCS = "doc_id long, text string, lang string, source string, n_chars long, fp long, score double, size long, sketch string, m string, w string, key string, o long"


@pytest.fixture(scope="session")
def docs(spark):
    def make(rows):
        """rows: (doc_id, text, lang, source), or fewer."""
        full = [(*r, *(None,) * (4 - len(r))) for r in rows]
        return spark.createDataFrame([(*r, None if r[1] is None else len(r[1]), 7, 0.5, 9, "s", "m", "w", "k", 1) for r in full], DOCS)

    return make


WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon phi chi psi omega".split()


@pytest.fixture(scope="session")
def prose():
    import random

    def make(seed, n, words=WORDS):
        r = random.Random(seed)
        return " ".join("".join(r.choices(words, k=2)) for _ in range(n))

    return make
