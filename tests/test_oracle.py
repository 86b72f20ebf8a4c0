"""Every query with reference SQL against DuckDB, on the given tables and on a skewed copy of them."""

import pytest
from check import TABLES, compare, connect
from conftest import SF

from foroscope.plans import ORACLES, QUERIES

ITERATIVE = sorted(set(QUERIES) - set(ORACLES))


@pytest.fixture(scope="session")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, con, name):
    ok, message, _ = compare(spark, con, name, QUERIES[name], ORACLES[name], SF)
    assert ok, message


@pytest.mark.parametrize("name", [n for n in ITERATIVE if n not in ("structural_signals", "broker_overlap")])
def test_runs_without_sql(spark, name):
    df = QUERIES[name](spark, SF)
    assert df.count() > 0
    assert len(df.columns) == len(set(df.columns))


# one key holds a third of all rows of each table
SKEW = {
    "orders": "select o_orderkey, case when o_orderkey % 3 = 0 then 7 else o_custkey end as o_custkey, o_orderstatus, "
              "o_totalprice, case when o_orderkey % 3 = 1 then timestamp '1997-03-03' else o_orderdate end as o_orderdate, "
              "o_orderpriority from orders",
    "lineitem": "select case when l_partkey % 3 = 0 then 11 else l_orderkey end as l_orderkey, l_partkey, "
                "case when l_linenumber % 3 = 0 then 3 else l_suppkey end as l_suppkey, l_linenumber, l_quantity, "
                "l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate from lineitem",
    "events": "select event_id, ts, case when event_id % 3 = 0 then 5 else user_id end as user_id, event_type, value, "
              "props from events",
    "documents": "select doc_id, text, case when doc_id % 3 = 0 then 'en' else lang end as lang, "
                 "case when doc_id % 3 = 0 then 'src3' else source end as source, n_chars from documents",
    "embeddings": "select vec_id, embedding, case when vec_id % 3 = 0 then 2 else label end::int as label from embeddings",
}
SKEW_QUERIES = """copart_edges copart_strong copart_edges_banded participation degree_centrality components clustering_coeff
even_time_sample stratified_sample quota_sample topn_longest topn_actors first_of_top_actors actor_corpus actor_style
tfidf_top_terms burrows_delta language_route utc_offset peak_hours actor_centroids sampled_centroids cohesion_matrix
net_reputation concentration rank_size describe_group threads_per_actor conversation_stats conversation_medians
dedup_posts posts_by_section active_users snapshot_transitions top_actors label_share section_stats pm_edges
combined_score common_contacts pm_with_receiver""".split()


@pytest.fixture(scope="session")
def skewed(tmp_path_factory):
    root = tmp_path_factory.mktemp("skewed")
    source = connect(SF)
    for name in TABLES:
        sql = SKEW.get(name, f"select * from {name}")
        source.execute(f"copy ({sql}) to '{root}/{name}.parquet' (format parquet)")
    return str(root)


@pytest.mark.parametrize("name", SKEW_QUERIES)
def test_matches_sql_under_skew(spark, skewed, name):
    ok, message, _ = compare(spark, connect(skewed), name, QUERIES[name], ORACLES[name], skewed)
    assert ok, message
