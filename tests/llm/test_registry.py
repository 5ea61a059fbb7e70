from parlance.llm import doc_queries, registry


def test_document_queries(spark):
    d = "/root/testdata/sf0.001"
    for name, q in doc_queries.queries().items():
        df = q(spark, d)
        assert df.columns and df.count() > 0, name


def test_names():
    assert set(registry.oracle_sql()) <= set(registry.queries())
    for n in (1, 2, 3, 4, 8, 9):
        assert f"p{n}_found" in registry.queries()
