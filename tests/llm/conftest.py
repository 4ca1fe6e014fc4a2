import pytest

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use for columns of their own.
CLASHING = "part string, spans string, hash string, digest string, fp string, bucket string, kind string, gram string, " \
    "text_hash string, row string, node string, root string, rows string, keep string, d string, s string, size string"  # fmt: skip


@pytest.fixture(scope="session")
def documents(spark):
    """Makes a documents table from texts (or (doc_id, text) pairs), with extra columns of clashing names."""

    def make(texts, partitions=3):
        pairs = [t if isinstance(t, tuple) else (i, t) for i, t in enumerate(texts)]
        rows = [(i, t, "en", "src", None if t is None else len(t)) for i, t in pairs]
        names = CLASHING.count(",") + 1
        rows = [(*r, *["x"] * names) for r in rows]
        return spark.createDataFrame(rows, f"{DOCUMENTS}, {CLASHING}").repartition(partitions)

    return make
