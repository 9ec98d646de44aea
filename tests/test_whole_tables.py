"""Queries that are to read whole tables with the operators' own values."""

from paperloom.plans import catalog


def test_every_part_is_bridged(spark, tmp_path):
    names = [(i, f"red{i % 4} blue{i % 3} green") for i in range(1, 41)]
    spark.createDataFrame(names, "p_partkey long, p_name string").write.parquet(f"{tmp_path}/part.parquet")
    spark.createDataFrame([(i,) for i in range(1, 13)], "s_suppkey long").write.parquet(f"{tmp_path}/supplier.parquet")
    short = {i: (n.split()[0], n, f"{n} limited")[i % 3] for i, n in names}
    right = {i: n + (" company" if i % 2 == 0 else "") for i, n in names if i <= 12}
    expected = {}
    for i, a in short.items():
        fits = [r for r, b in right.items() if a.split()[0] == b.split()[0] and (set(a.split()) <= set(b.split()) or set(b.split()) <= set(a.split()))]
        if fits:
            expected[i] = min(fits)
    found = {r["id"]: r["rid"] for r in catalog.queries()["blocked_subset_bridge"](spark, str(tmp_path)).collect()}
    assert found == expected
    assert any(i % 10 for i in found)


def test_passages_of_many_copies_are_candidates(spark, tmp_path):
    spark.createDataFrame([(i, "wandering albatross colony") for i in range(60)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, "albatross colony")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    found = catalog.queries()["inverted_index_topk"](spark, str(tmp_path)).collect()
    assert sorted((r["item_id"], r["doc_id"], r["shared"]) for r in found) == [(1, i, 2) for i in range(30)]


def test_rarer_terms_are_kept(spark, tmp_path):
    word = lambda i: "q" + "".join(chr(97 + i // 26**k % 26) for k in range(3))
    common = " ".join(word(i) for i in range(2500))
    spark.createDataFrame([(1, f"{common} {common}", "en"), (2, "zeldzaam", "de")], "doc_id long, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    found = catalog.queries()["ctfidf_terms"](spark, str(tmp_path)).collect()
    assert [r["term"] for r in found if r["label"] == 1] == ["zeldzaam"]
