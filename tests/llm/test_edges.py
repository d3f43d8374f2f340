"""Every query of the operators over empty tables, and over tables with columns named like its own."""

import pytest

from conftest import rows_of
from tallyhouse.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
SIZES = {"documents": 40, "embeddings": 60, "pages": 30, "benchmark": 10, "labels": 200, "conversations": 40}
CLASHING = (
    "c", "x", "m", "n", "k", "h", "a", "b", "i", "j", "id", "doc", "part", "size", "score", "kept", "word", "root", "node", "rank", "digest", "_text",
    "_new", "_n", "_c", "_host", "_kept0", "in_text", "in_doc_id", "n_words", "base_failed", "start", "length", "salt", "low", "file", "hash", "turns",
)


@pytest.fixture(scope="module")
def folders(spark, tmp_path_factory):
    made = {kind: str(tmp_path_factory.mktemp(kind)) for kind in ("plain", "empty", "clashing")}
    for name, size in SIZES.items():
        rows = spark.read.parquet(f"{FOLDER}/{name}.parquet")
        rows = rows.orderBy(*[c for c in rows.columns if c.endswith("_id")]).limit(size).coalesce(1)
        extra = [f"{k} AS {c}" for k, c in enumerate(CLASHING) if c not in rows.columns]
        for kind, frame in (("plain", rows), ("empty", rows.limit(0)), ("clashing", rows.selectExpr("*", *extra))):
            frame.write.parquet(f"{made[kind]}/{name}.parquet")
    return made


@pytest.mark.parametrize("name", sorted(q for q in QUERIES if q.startswith("op")))
def test_empty_tables_and_clashing_columns(spark, folders, name):
    plain = QUERIES[name](spark, folders["plain"])
    empty = QUERIES[name](spark, folders["empty"])
    assert empty.dtypes == plain.dtypes
    # The conversation that op3 adds is all it has.
    assert empty.count() == (1 if name.startswith("op3") else 0)
    assert rows_of(QUERIES[name](spark, folders["clashing"])) == rows_of(plain)
