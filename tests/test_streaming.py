"""Streaming replays (Trigger.AvailableNow) equal the batch operators."""

import datetime as dt
import os

from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from sitelens.operators import canonical as CN
from sitelens.operators import extract as X
from sitelens.operators import outcomes as O
from sitelens.operators import report as R
from sitelens.plans import queries_streaming as Q
from sitelens.streaming import jobs as T
from tests.helpers import T0


def test_stream_claims_equal_batch_first_claims(spark):
    root = T.scratch(spark, "t-claims")
    rows = [("s1", u, T0 + dt.timedelta(seconds=i)) for i, u in
            enumerate(["http://A.com/x/", "http://a.com/x", "http://a.com/y#f", "http://a.com/y", "http://b.com/"])]
    rows += [("s2", "http://a.com/x", T0)]
    spark.createDataFrame(rows, "site_id string, url string, fetched_at timestamp").repartition(3) \
        .write.parquet(f"{root}/in")
    batch = CN.dedupe_first(O.with_norm(spark.read.parquet(f"{root}/in")), ["site_id", "norm_url"], ["fetched_at"])
    want = {(r.site_id, r.norm_url) for r in batch.collect()}
    for mode in ("keyed", "state"):
        stream = spark.readStream.schema("site_id string, url string, fetched_at timestamp") \
            .option("maxFilesPerTrigger", 1).parquet(f"{root}/in")
        path = T.stream_claims(stream, f"{root}/{mode}", mode=mode, watermark="3650 days" if mode == "state" else None)
        rows = T.read_epochs(spark, path).select("site_id", "norm_url").collect()
        assert len(rows) == len(want)  # every key claimed exactly once
        got = {(r.site_id, r.norm_url) for r in rows}
        assert got == want
    assert got == {("s1", "http://a.com/x"), ("s1", "http://a.com/y"), ("s1", "http://b.com"), ("s2", "http://a.com/x")}


def test_stream_extract_equals_batch(spark):
    root = T.scratch(spark, "t-extract")
    rows = [(i, f"http://h.com/p{i}", f'<a href="/q{i}">x</a><img src="/i{i % 2}.png"><title>T{i}</title>')
            for i in range(6)]
    spark.createDataFrame(rows, "page_id int, url string, body string").repartition(3).write.parquet(f"{root}/in")
    stream = spark.readStream.schema("page_id int, url string, body string").option("maxFilesPerTrigger", 1) \
        .parquet(f"{root}/in")
    paths = T.stream_extract(stream, root, ["page_id"], ctype_col=None)
    got = {tuple(r) for r in T.read_epochs(spark, paths["links"]).select("page_id", "pos", "link").collect()}
    batch = X.explode_positions(X.extract_pages(spark.read.parquet(f"{root}/in"), ctype_col=None), ["page_id"], "links",
                                ("pos", "link"))
    assert got == {tuple(r) for r in batch.collect()}
    assert {r.title for r in T.read_epochs(spark, paths["seo"]).collect()} == {f"T{i}" for i in range(6)}
    assert T.read_epochs(spark, paths["assets"]).select(F.count_distinct("url")).first()[0] == 2


def test_stream_broken_links_waits_for_the_get(spark):
    """HEAD 405 in one batch, GET 200 in the next: never reported; GET 404: reported once; equals batch."""
    root = T.scratch(spark, "t-broken")
    schema = "site_id string, url string, method string, status_code int, error string, fetched_at timestamp"
    batches = [[("s", f"http://h.com/{k}", "HEAD", 405, None, T0) for k in range(3)] + [("s", "http://h.com/9", "HEAD", 500, None, T0)],
               [("s", "http://h.com/0", "GET", 200, None, T0), ("s", "http://h.com/1", "GET", 404, None, T0)],
               [("s", "http://h.com/9", "HEAD", 500, None, T0)]]
    for b in batches:
        spark.createDataFrame(b, schema).coalesce(1).write.mode("append").parquet(f"{root}/in")
    links = spark.createDataFrame([("s", "http://h.com", k, f"http://h.com/{k}", f"http://h.com/{k}") for k in (0, 1, 2, 9)],
                                  "site_id string, page_norm string, pos int, link string, link_norm string")
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/in")
    out = T.read_epochs(spark, T.stream_broken_links(links, stream, root))
    assert sorted((r.link, r.status_code) for r in out.collect()) == [("http://h.com/1", 404), ("http://h.com/9", 500)]
    batch = R.broken_links(links, O.resolve_link_probe(spark.read.parquet(f"{root}/in")))
    assert sorted(r.link for r in batch.collect()) == sorted(r.link for r in out.collect())


PROBE = "site_id string, url string, method string, status_code int, error string, fetched_at timestamp"


def test_the_state_of_probes_outlives_the_query(spark):
    """One run a batch: every pair once, whichever of HEAD and GET comes first, and nothing stored but state and result."""
    root = T.scratch(spark, "t-state")
    late = T0 + dt.timedelta(seconds=9)
    batches = [[("s", "http://h.com/0", "GET", 404, None, T0), ("s", "http://h.com/1", "HEAD", 501, None, T0),
                ("s", "http://h.com/2", "HEAD", 404, None, T0), ("s", "http://h.com/4", "GET", 200, None, T0),
                ("s", "http://h.com/5", "GET", 410, None, T0), ("s", "http://h.com/6", "HEAD", None, "reset", T0)],
               [("s", "http://h.com/0", "HEAD", 405, None, T0), ("s", "http://h.com/1", "GET", None, "reset", T0),
                ("s", "http://h.com/2", "HEAD", 404, None, late), ("s", "http://h.com/2", "GET", 404, None, T0),
                ("s", "http://h.com/4", "HEAD", 500, None, T0), ("s", "http://h.com/5", "HEAD", 410, None, T0)],
               [("s", f"http://h.com/{k}", m, 404, None, late) for k in (0, 1, 2, 4, 5) for m in ("HEAD", "GET")]]
    links = spark.createDataFrame([("s", "http://h.com", k, f"http://h.com/{k}", f"http://h.com/{k}") for k in range(7)],
                                  "site_id string, page_norm string, pos int, link string, link_norm string")
    seen = []
    for b in batches:
        spark.createDataFrame(b, PROBE).coalesce(1).write.mode("append").parquet(f"{root}/in")
        out = T.stream_broken_links(links, spark.readStream.schema(PROBE).parquet(f"{root}/in"), root)
        seen.append(sorted((r.link[-1], r.status_code) for r in T.read_epochs(spark, out).collect()))
    first = [("0", 404), ("2", 404), ("5", 410)]
    assert seen == [first, sorted(first + [("1", 0), ("4", 500)]), sorted(first + [("1", 0), ("4", 500)])]


def test_claims_of_a_hot_url_over_restarts(spark):
    root = T.scratch(spark, "t-hot")
    schema = "site_id string, url string, fetched_at timestamp"
    for run in range(3):
        rows = spark.range(3000).select(F.lit("s").alias("site_id"), F.when(F.col("id") % 3 > 0, F.lit("http://a.com/hot")).otherwise(
            F.concat(F.lit("http://a.com/"), (F.col("id") % 50 + 25 * run).cast("string"))).alias("url"),
            F.lit(T0 + dt.timedelta(seconds=-run)).cast("timestamp").alias("fetched_at"))
        rows.write.mode("append").parquet(f"{root}/in")
        out = T.stream_claims(spark.readStream.schema(schema).parquet(f"{root}/in"), root)
    claims = T.read_epochs(spark, out).collect()
    assert len(claims) == len({r.norm_url for r in claims}) == 101          # the hot one and 0..99
    assert {r.fetched_at for r in claims if r.url.endswith("hot")} == {T0}    # the first batch has it, later ones with earlier times don't


SITE = "http://s.example"


def _page(name, *links):
    return "s", f"{SITE}/{name}", "".join(f'<a href="/{x}">x</a>' for x in links)


def _levels(pages, limit):
    """Least depths by breadth-first search over the pages."""
    at, level = {"": 0}, [""]
    out = {name: links for name, *links in pages}
    for d in range(1, limit):
        level = sorted({x for p in level for x in out.get(p, ())} - at.keys())
        at.update(dict.fromkeys(level, d))
    return at


def _frontier(spark, root, sites):
    stream = spark.readStream.schema("site_id string, url string, body string").option("maxFilesPerTrigger", 1).parquet(f"{root}/in")
    rows = T.read_epochs(spark, T.frontier_rounds(stream, sites, root, ["site_id"])).collect()
    return sorted((r.norm_url[len(SITE):].strip("/"), r.depth) for r in rows)


def test_frontier_over_restarts_late_pages_and_replays(spark):
    root = T.scratch(spark, "t-frontier")
    sites = spark.createDataFrame([("s", f"{SITE}/", 5)], "site_id string, root_url string, depth int")
    # pages before what leads to them, a long way first, a shorter way later, a cycle, repeats and the depth limit
    batches = [[("b", "c"), ("c", "d", "b")], [("", "a", "a"), ("a", "b", "hot")], [("d", "e"), ("e", "f")],
               [("hot", "d", ""), ("x", "y")], [("", "d")]]
    so_far = []
    for pages in batches:
        spark.createDataFrame([_page(*p) for p in pages], "site_id string, url string, body string").write.mode("append").parquet(f"{root}/in")
        rows = _frontier(spark, root, sites)
        for name, *links in pages:
            so_far.append((name, *links, *[x for p in so_far if p[0] == name for x in p[1:]]))
        least = {}
        for name, depth in rows:
            least[name] = min(depth, least.get(name, 99))
        assert least == _levels(so_far, 5)
        # a URL is there once for each fall of its depth
        assert len(rows) == len(set(rows))
    assert ("d", 4) in rows and ("d", 1) in rows and ("f", 3) in rows

    # the last batch's commit is lost: it runs again and writes the same rows
    commits = f"{root}/_ckpt_frontier/commits".removeprefix("file:")
    last = max(int(x) for x in os.listdir(commits) if x.isdigit())
    for name in (f"{last}", f".{last}.crc"):
        if os.path.exists(f"{commits}/{name}"):
            os.remove(f"{commits}/{name}")
    assert _frontier(spark, root, sites) == rows


def test_a_frontier_batch_answers_for_its_own_pages_only(spark):
    """What a batch writes does not grow with what was reached before it."""
    root = T.scratch(spark, "t-delta")
    sites = spark.createDataFrame([("s", f"{SITE}/", 9)], "site_id string, root_url string, depth int")
    schema = "site_id string, url string, body string"
    spark.createDataFrame([_page("", *[f"p{i}" for i in range(300)])], schema).write.parquet(f"{root}/in")
    assert len(_frontier(spark, root, sites)) == 301
    before = spark.read.parquet(f"{root}/messages").agg(F.max("epoch")).first()[0]
    spark.createDataFrame([_page("p7", "p8", "new")], schema).write.mode("append").parquet(f"{root}/in")
    assert len(_frontier(spark, root, sites)) == 302
    assert spark.read.parquet(f"{root}/messages").filter(F.col("epoch") > before).count() == 2


def test_a_replayed_batch_is_read_by_many_tasks(spark):
    """Three batches whatever the size, and a large one's rows are not one file of one row group."""
    for n, least in ((40_000, 4), (50, 1)):
        root = T.scratch(spark, "t-replay")
        rows = spark.range(n).select("id", F.col("id").cast("string").alias("url"))
        seen = []
        stream = Q._replay(spark, rows, f"{root}/in", "id", source=rows)

        def sink(batch, epoch):
            files = batch.groupBy(F.input_file_name()).count().collect()
            seen.append((len(files), sum(r["count"] for r in files), max(r["count"] for r in files)))

        T._run(stream.writeStream.foreachBatch(sink).option("checkpointLocation", f"{root}/ckpt"))
        assert len(seen) == 3 and sum(x[1] for x in seen) == n
        assert all(x[0] == least and x[2] < 1.2 * x[1] / least for x in seen)


def test_all_rounds_are_one_query_whose_state_fits_the_pages(spark, monkeypatch):
    """A round costs each state partition: their number goes by the pages, and a further round starts no query and reads no sites."""
    root, data, started = T.scratch(spark, "t-rounds"), T.scratch(spark, "t-data"), []
    spark.range(60).select(F.col("id").alias("page_id"), F.concat(F.lit("http://s.example/"), F.col("id").cast("string")).alias("url"),
                           F.lit("<p>x</p>").alias("html")).write.parquet(f"{data}/pages.parquet")
    monkeypatch.setattr(T, "scratch", lambda spark, name: root)
    start = DataStreamWriter.start
    monkeypatch.setattr(DataStreamWriter, "start", lambda self: started.append(start(self)) or started[-1])
    before = spark.conf.get("spark.sql.shuffle.partitions")
    rows = {r.norm_url: r.depth for r in Q.frontier_rounds(spark, data).collect()}
    assert rows == {f"http://s.example/p/{k}": (k + 1).bit_length() - 1 for k in range(60)}
    assert len(started) == 2 and not any(q.isActive for q in started)
    state = os.listdir(f"{root}/_ckpt_frontier/state/0".removeprefix("file:"))
    assert len([x for x in state if x.isdigit()]) == spark.sparkContext.defaultParallelism < int(before)
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    # only a batch that sends messages writes some: each file in the inbox is input of the next round
    messages = spark.read.parquet(f"{root}/messages").groupBy("epoch").count().collect()
    assert len(messages) == len([x for x in os.listdir(f"{root}/messages".removeprefix("file:")) if x.startswith("epoch=")]) - 1
