"""Leaders among vectors against the leaders of all pairs."""

import numpy as np
import pyarrow.parquet as pq
import pytest

from sievework import queries
from sievework.operators import leaders, rank
from sievework.plans import shared

SCHEMA = "id {}, v array<double>, score double, label string"


def by_pairs(df, threshold):
    return {r["id"]: r["cluster"] for r in rank.leader_clusters(rank.similar_pairs(df, ["label"], threshold), df.select("id", "score"), threshold).collect()}


@pytest.mark.parametrize("threshold", [0.1, 0.5, 0.95])
def test_the_same_as_by_all_pairs(spark, monkeypatch, threshold):
    for name, small in (("FIRST", 8), ("MOST", 32), ("SLOT", 30), ("LEADERS", 5), ("STEP", 3)):
        monkeypatch.setattr(leaders, name, small)  # many rounds, slots and tiles
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(size=6).tolist(), float(rng.integers(0, 9)), "ab"[i % 2]) for i in range(160)]
    rows += [(200 + i, rows[i][1], rows[i][2], rows[i][3]) for i in range(20)]  # copies
    rows += [(300, [1.0, 2.0], 1.0, "a"), (301, [2.0, 4.0], None, "a"), (302, [0.0] * 6, 99.0, "a"), (303, None, 99.0, "a"), (304, rows[0][1], 99.0, None), (305, rows[0][1], float("nan"), "a")]
    rows += [(306, [1.0, None], 1.0, "a"), (307, [float("nan")] * 6, -1.0, "b"), (308, [1.0], 1.0, "lone"), (309, [], 1.0, "a")]
    for kind in ("long", "string"):
        df = spark.createDataFrame([(r[0] if kind == "long" else str(r[0]), *r[1:]) for r in rows], SCHEMA.format(kind))
        got = leaders.vector_leaders(df, ["label"], threshold).collect()
        assert len(got) == len(rows) and {r["id"]: r["cluster"] for r in got} == by_pairs(df, threshold)


def test_no_vectors(spark):
    assert leaders.vector_leaders(spark.createDataFrame([], SCHEMA.format("long")), ["label"], 0.2).isEmpty()
    assert leaders.vector_leaders(spark.createDataFrame([(1, None, 1.0, "a")], SCHEMA.format("long")), ["label"], 0.2).collect() == [(1, 1)]


def test_the_query_writes_no_list_of_pairs(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(shared, "shared_dir", lambda _: str(tmp_path / "shared"))
    rows = [(i, [1.0, i / 1000, 0.5], i % 2) for i in range(400)]  # 39,800 pairs
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").write.parquet(str(tmp_path / "embeddings.parquet"))
    assert {r["cluster"] for r in queries.leader_clusters(spark, str(tmp_path)).collect()} <= set(range(400))
    assert sum(pq.read_metadata(f).num_rows for f in (tmp_path / "shared").rglob("*.parquet")) < 5 * len(rows)
