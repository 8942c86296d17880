"""Plan-shape checks: the physical strategies the design relies on."""

from conftest import SF_SMALL
from newsflow.operators import ingest as IN
from newsflow.operators import vectors as VE
from newsflow.sources import tables as TB


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_similar_by_id_is_a_scan_and_take_ordered(spark):
    p = plan(VE.similar_by_id(TB.vector_index(spark, SF_SMALL), 7))
    assert "TakeOrderedAndProject" in p
    assert "Join" not in p and "CartesianProduct" not in p and "NestedLoop" not in p


def test_source_filter_pushed_down(spark):
    v = TB.read_table(spark, SF_SMALL, "embeddings")
    p = v._jdf.queryExecution().executedPlan().toString()
    df = VE.similar_by_id(v.selectExpr("vec_id AS id", "embedding"), 7)
    assert "EqualTo(vec_id,7)" in plan(df)


def test_new_articles_uses_anti_join(spark):
    raw = TB.raw_articles(spark, SF_SMALL)
    p = plan(IN.new_articles(raw, IN.seen_hashes(raw.limit(5))))
    assert "LeftAnti" in p


def test_caps_use_partial_window_group_limit(spark):
    e = TB.page_entries(spark, SF_SMALL)
    df = IN.cap_per_feed(e)
    df.count()
    p = df._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in p


def test_first_wins_is_a_partial_aggregate(spark):
    raw = TB.raw_articles(spark, SF_SMALL)
    p = plan(IN.new_articles(raw, None))
    assert "partial_min_by" in p


def test_knn_all_has_no_pair_join(spark):
    df = VE.knn_all(TB.vector_index(spark, SF_SMALL))
    p = plan(df)
    assert "CartesianProduct" not in p and "NestedLoop" not in p
    assert "FlatMapCoGroupsInPandas" in p


def test_no_local_checkpoint_in_library():
    import pathlib
    root = pathlib.Path(__file__).resolve().parents[1] / "newsflow"
    for f in root.rglob("*.py"):
        assert "localCheckpoint" not in f.read_text(), f
