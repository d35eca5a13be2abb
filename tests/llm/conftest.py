import duckdb
import pytest

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def small_docs():
    """(doc_id, text, lang) of the smallest table."""
    return duckdb.sql(f"select doc_id, text, lang from '{SMALL}/documents.parquet' order by doc_id").fetchall()


def frame(spark, rows, extra=True):
    """documents-like frame of (doc_id, text) with the usual columns and clashing extras."""
    names = "doc_id long, text string, lang string, source string, n_chars long"
    values = [(i, t, "en", "s", len(t) if t is not None else None) for i, t in rows]
    if extra:
        names += ", fp long, score string, ids int, pii string, words int, hash int, verdict int"
        values = [(*v, 1, "x", 2, "y", 3, 4, 5) for v in values]
    return spark.createDataFrame(values, names)


def written(spark, folder, **tables):
    """Write frames as <folder>/<name>.parquet; the folder as sf_dir."""
    for name, df in tables.items():
        df.write.parquet(f"{folder}/{name}.parquet")
    return folder
