import pytest

# names that the operators use inside or return
CLASHING = ["fp", "component_id", "score", "spans", "ids", "block", "bucket", "words", "shard", "slot", "rank", "group",
            "first", "cell", "log_weight", "selected", "passage", "item_id", "_range", "_h1", "lang_pred", "page_id"]
LONG = " ".join(f"longword{k % 997} of{k % 13}" for k in range(20_000))
TEXTS = [
    (0, "The quick brown fox jumps over the lazy dog near the river bank"),
    (1, None), (2, ""), (3, " \t\n "), (4, LONG), (5, "one"), (6, "one two"),
    (7, "The quick brown fox jumps over the lazy dog near the river bank"),
    (7, "The quick brown fox jumps over the lazy dog near the river bank"),
    (8, "der schnelle braune fuchs springt über den faulen hund"), (None, "a row without an id"),
    (9, "12345 !!! ???"), (10, "THE QUICK  brown\nfox jumps over the lazy dog near the river bank"),
    (11, "x" * 3000), (12, "don't we're 's 'll   tabs\tand \u3000spaces 漢字 ½"), (13, None),
]


@pytest.fixture(scope="session")
def stored(spark, tmp_path_factory):
    """Writes rows as a table and reads it back."""
    def store(rows, schema):
        path = str(tmp_path_factory.mktemp("stored") / "t.parquet")
        spark.createDataFrame(rows, schema).write.parquet(path)
        return spark.read.parquet(path)
    return store


@pytest.fixture(scope="session")
def odd_docs(stored):
    """Documents with every odd case, and columns of clashing names."""
    rows = [(i, t, "en" if i != 8 else "de", "s", len(t) if t else 0, *[1] * len(CLASHING)) for i, t in TEXTS]
    return stored(rows, "doc_id long, text string, lang string, source string, n_chars long, "
                  + ", ".join(f"`{c}` int" for c in CLASHING))


@pytest.fixture(scope="session")
def no_docs(stored):
    return stored([], "doc_id long, text string, lang string, source string, n_chars long")


@pytest.fixture(scope="session")
def small_dir():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def docs(spark, small_dir):
    return spark.read.parquet(f"{small_dir}/documents.parquet")


@pytest.fixture(scope="session")
def texts(docs):
    return {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
