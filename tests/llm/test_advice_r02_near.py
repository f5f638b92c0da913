from tallymark.llm import near_dedup


def words(prefix, n=40):
    return " ".join(f"{prefix}{k}" for k in range(n))


def test_rows_that_repeat_an_id_follow_their_own_text(spark):
    rows = [(1, words("a")), (5, words("a", 39)), (5, words("b")), (6, words("b", 39)), (7, words("c")), (7, words("c", 39)), (7, words("d"))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r.doc_id, r.text) for r in near_dedup.distinct_documents(docs).collect())
    sevens = [g for g in got if g[0] == 7]
    assert [g for g in got if g[0] != 7] == [(1, words("a")), (5, words("b"))]
    assert len(sevens) == 2 and (7, words("d")) in sevens
    found = {(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in near_dedup.near_duplicates(docs).collect()}
    assert {(5, 35, 1, False), (5, 36, 5, True), (6, 35, 5, False)} <= found
