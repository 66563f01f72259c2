"""Cells against the brute-force cosine search."""

import numpy as np
import pytest

from pagesieve.operators import retrieval as RT
from pagesieve.operators.vector_index import VectorIndex


@pytest.fixture(scope="module")
def clustered(spark):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(20, 12))
    v = centres[rng.integers(0, 20, 900)] + rng.normal(size=(900, 12)) * 0.05
    rows = [(i, v[i].tolist()) for i in range(900)] + [(2000 + i, v[0].tolist()) for i in range(200)]  # many copies
    rows += [(3000, [0.0] * 12), (3001, None), (3002, [])]
    asked = [(f"q{i}", (v[i] * 2).tolist()) for i in range(0, 900, 30)] + [("far", rng.normal(size=12).tolist()),
                                                                           ("zero", [0.0] * 12)]
    return (spark.createDataFrame(rows, "id int, v array<double>").repartition(4),
            spark.createDataFrame(asked, "q string, v array<double>").repartition(3))


def test_same_rows_with_few_cells_read(clustered):
    vectors, queries = clustered
    usable = vectors.where("size(v) > 0")
    want = sorted(map(tuple, RT.cosine_search(usable, "id", "v", queries, "q", "v", k=7).collect()))
    index = VectorIndex(vectors, "id", "v", cells=20, part_rows=30)
    assert index.parts.max() > 1
    got = index.search(queries, "q", "v", k=7)
    assert got.columns == ["q", "rank", "id", "score"] and got.schema["id"].dataType.simpleString() == "int"
    assert sorted(map(tuple, got.collect())) == want
    # most queries find their vectors in their own cluster; the far one and the zero vector read more
    assert index.cells_read(queries.where("q like 'q%'"), "q", "v", k=7) < 0.3


def test_more_asked_than_there_is(spark, clustered):
    vectors, queries = clustered
    few = vectors.where("id < 3")
    got = VectorIndex(few, "id", "v").search(queries, "q", "v", k=5)
    assert sorted(map(tuple, got.collect())) == sorted(
        map(tuple, RT.cosine_search(few, "id", "v", queries, "q", "v", k=5).collect()))
    assert VectorIndex(few, "id", "v").search(queries.limit(0), "q", "v").count() == 0
    assert VectorIndex(few.limit(0), "id", "v").search(queries, "q", "v").count() == 0
