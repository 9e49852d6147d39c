"""The visited table of the crawl: rounds do not shuffle what earlier rounds reached."""

import re

from sitelens.operators import graph as G
from tests.helpers import sites


def test_the_visited_side_is_not_shuffled(spark):
    visited = G.Visited(spark)
    visited.append(spark.createDataFrame([("s", f"u{k}") for k in range(500)], "site_id string, norm_url string"), 0)
    visited.append(spark.createDataFrame([("s", f"v{k}") for k in range(500)], "site_id string, norm_url string"), 1)
    cand = spark.createDataFrame([("s", "u1"), ("s", "v7"), ("s", "w"), ("t", "u1")], "site_id string, norm_url string").distinct()
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        new = visited.unseen(cand)
        plan = new._jdf.queryExecution().executedPlan().toString()
        assert sorted(map(tuple, new.collect())) == [("s", "w"), ("t", "u1")]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    join = plan[plan.index("SortMergeJoin"):]
    assert not re.search(r"Exchange", join[join.index("FileScan") - 200:]) and plan.count("Exchange hashpartitioning") == 1
    assert visited.level(1).count() == 500
    assert visited.close().groupBy("depth").count().count() == 2
    assert not spark.catalog.tableExists(visited.name)


def test_depths_of_a_long_chain_with_shortcuts(spark):
    """Deeper than any fixture: each URL once, at its least depth, within the limit."""
    n = 12
    edges = [("s", f"http://e.com/{k}", f"http://e.com/{k + 1}") for k in range(n)] + [("s", "http://e.com/0", "http://e.com/5"),
             ("s", "http://e.com/6", "http://e.com/0"), ("s", "http://e.com/1", "http://other.com/x")]
    df = spark.createDataFrame(edges, "site_id string, src string, link string")
    got = {r.norm_url: r.depth for r in G.crawl_depths(df, sites(spark, "http://e.com/0", depth=6)).collect()}
    assert got == {f"http://e.com/{k}": d for k, d in ((0, 0), (1, 1), (5, 1), (2, 2), (6, 2), (3, 3), (7, 3), (4, 4), (8, 4), (9, 5))}
