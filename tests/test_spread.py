"""A scan of one file may be one task; the work on texts is spread behind it."""

from paperloom.operators import clusters, languages


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_languages_are_guessed_behind_an_exchange(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "the cat and the dog", "en"), (2, "der hund und die katze", "de"), (3, "le chat et le chien", "fr"), (4, None, None)], "doc_id long, text string, lang string")
    plans = []
    monkeypatch.setattr(languages, "materialise", lambda df: plans.append(plan(df)) or df)
    names, known = languages.profiles(docs)
    assert names == ["de", "en", "fr"] and "Rebalance" in plans[0]
    guesses = languages.guessed(docs, names, known, "doc_id")
    assert "Rebalance" in plan(guesses)
    margin = languages.least_lead(guesses, docs, "doc_id")
    assert margin == languages.calibrated(docs, names, known, "doc_id") > 0
    for m in (margin, 1e-9, 1e9):
        key = lambda df: sorted((r["doc_id"], r["guess"], r["lead"] and round(r["lead"], 9)) for r in df.collect())
        assert key(languages.refused(guesses, m)) == key(languages.guessed(docs, names, known, "doc_id", margin=m))


def test_terms_are_counted_once_behind_an_exchange(spark, monkeypatch):
    docs = spark.createDataFrame([(0, "laser optics laser"), (1, "memory cell memory"), (-1, "laser"), (1, None)], "label int, text string")
    plans = []
    monkeypatch.setattr(clusters, "materialise", lambda df: plans.append(plan(df)) or df)
    found = {(r["label"], r["term"]) for r in clusters.terms(docs).collect()}
    assert found == {(0, t) for t in ("laser", "optics", "laser optics", "optics laser")} | {(1, t) for t in ("memory", "cell", "memory cell", "cell memory")}
    assert len(plans) == 1 and "Rebalance" in plans[0]


def test_texts_are_embedded_behind_an_exchange(spark):
    found = clusters.embedded(spark.createDataFrame([(1, "a laser"), (2, None)], "doc_id long, text string"))
    assert "Rebalance" in plan(found) and found.count() == 2
