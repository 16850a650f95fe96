import pytest


@pytest.fixture(scope="session")
def documents(spark):
    """A function that makes a documents table, with columns whose names clash."""
    def make(rows):
        schema = ("doc_id long, text string, lang string, source string, n_chars long, "
                  "row string, lines int, fp string, id int, h1 double, block string")
        full = [(*row, *[None] * (4 - len(row)), len(row[1] or ""), "x", 1, "f", 5, 0.5, "b") for row in rows]
        return spark.createDataFrame(full, schema)
    return make


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"
