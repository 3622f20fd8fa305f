from __future__ import annotations

import pytest

SMALL = "/root/testdata/sf0.001"
CLASHING = """score double, kept boolean, fingerprint string, fp long, row long, n_words long, found string,
    group long, part long, segments string, words_key string, start long, ids string"""


@pytest.fixture(scope="session")
def small():
    return SMALL


@pytest.fixture(scope="session")
def texts(spark):
    """The small table by id, in order."""
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    return dict(sorted((r.doc_id, r.text) for r in rows))


def _rows():
    prose = " ".join(f"word{i % 97} of line {i}" for i in range(40))
    return [
        (1, prose, "en", "a", len(prose)),
        (2, None, "en", "a", None),
        (3, "", "en", None, 0),
        (4, "", None, "a", 0),
        (4, "", None, "a", 0),
        (5, prose, "en", "a", len(prose)),
        (5, prose + " more", "en", "a", len(prose) + 5),
        (None, "a text without an id, token = \"0f1e2d3c4b5a69788796a5b4c3d2e1f00f1e2d3c\"", "fr", "b", None),
        (6, "\n \t\n", "", "", 4),
        (7, "one", "en", "a", 3),
        (8, "ein zwei drei \x00\x1c　﷽ 😀 ΑΣ é <|endoftext|> ▁", "de", "b", 40),
        (9, "same same same " * 400 + "\n" + "x" * 30_000 + " " + "lang " * 20_000, "en", "a", 136_000),
    ]


@pytest.fixture(scope="session")
def edges(spark):
    """Nulls, empty and long texts, ties, repeated rows, and further columns with common names."""
    base = spark.createDataFrame(_rows(), "doc_id long, text string, lang string, source string, n_chars long")
    names = [c.split()[0:2] for c in CLASHING.split(",")]
    return base.selectExpr("*", *(f"CAST(NULL AS {kind}) AS {name}" for name, kind in names)).repartition(3, "n_chars")


@pytest.fixture(scope="session")
def none(spark, edges):
    """The same columns without rows."""
    return spark.createDataFrame([], edges.schema)


@pytest.fixture(scope="session")
def edge_labels(spark):
    rows = [(1, 1, 0), (5, 1, 1), (7, None, None), (None, 1, 1), (1, 0, 0), (9, 0, 1), (3, 1, 0)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
