from __future__ import annotations

import duckdb
import pytest

SF_DIR = "/root/testdata/sf0.001"

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def rows_of_table(name: str, columns: str) -> list[tuple]:
    return duckdb.sql(f"select {columns} from read_parquet('{SF_DIR}/{name}.parquet') order by 1").fetchall()


@pytest.fixture(scope="session")
def documents():
    """doc_id, text of the small table."""
    return rows_of_table("documents", "doc_id, text")


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in every column, empty and very long texts, repeated rows, one id with two texts, clashing column names."""
    long_ = " ".join(f"word{i % 977} other{i % 31}" for i in range(60_000))
    plain = " ".join(f"alpha{i % 83} beta{i % 89}." for i in range(60))
    rows = [
        (1, plain, "en", "a", 3), (1, plain, "en", "a", 3), (2, "", "en", "a", 0), (3, None, None, None, None), (None, plain, "de", "b", 1),
        (None, None, None, None, None), (4, long_, "en", "a", 9), (5, " \n\t ", "en", "b", 3), (6, "one", "fr", "b", 3), (7, "one two", "fr", "b", 7),
        (8, plain + " tail", "en", "c", 5), (8, "x " * 100, "en", "c", 5), (9, "é中 🙂 " * 40, "de", "c", 5),
    ]
    extra = "fp string, ids string, score string, _id string, _text string, _doc string, root string, n_words string, word string, kept string"
    names = [c.split()[0] for c in extra.split(", ")]
    return spark.createDataFrame([(*r, *names) for r in rows], f"{DOCS}, {extra}")


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], DOCS)
