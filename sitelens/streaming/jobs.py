"""Structured Streaming variants.

Every job reads files with ``readStream`` and writes parquet with ``writeStream`` (or
``foreachBatch`` when one micro-batch feeds several tables or needs the stored state of earlier
batches).  What a job must know of earlier batches about a key (T1, T3) lies in the state store, one row
a key, so a batch reads the state of its own keys.  ``foreachBatch`` output goes to one folder per epoch written with ``overwrite`` in one
commit, and a batch reads only earlier epochs of what it writes, so an epoch replayed after a failure
gives the same rows again.  Every such table starts with an empty epoch -1: a read that fails is an
error, never taken for a first batch.  Sinks and streaming checkpoints live under the shared folder
named by ``spark.checkpoint.dir``; nothing is collected to the driver.  ``Trigger.AvailableNow``
processes what is there and stops, however long that takes; T4, whose batches are each other's input, stops
when nothing is left to process.
"""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitelens.operators import extract as X
from sitelens.operators import graph as G
from sitelens.operators import outcomes as O
from sitelens.operators import report as R
from sitelens.operators.skew import hot_keys, with_site
from sitelens.functions import status as S
from sitelens.functions import urls as U
from sitelens.session import ensure_checkpoint_dir, store


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint directory."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/stream-{name}-{uuid.uuid4().hex[:12]}"


def _epoch_dir(path: str, epoch: int, sub: str | None = None) -> str:
    return f"{path}/epoch={epoch}" + (f"/{sub}" if sub else "")


def _write(df: DataFrame, path: str, epoch: int, sub: str | None = None) -> None:
    """Idempotent per-epoch write (a replayed epoch overwrites its own folder)."""
    df.write.mode("overwrite").parquet(_epoch_dir(path, epoch, sub))


def read_epochs(spark: SparkSession, path: str) -> DataFrame:
    """All epochs of a foreachBatch table (the ``epoch`` partition column is dropped)."""
    return spark.read.option("recursiveFileLookup", "true").parquet(path)


def _earlier(spark: SparkSession, path: str, epoch: int) -> DataFrame:
    """The rows that epochs before this one wrote."""
    return spark.read.parquet(path).filter(F.col("epoch") < epoch).drop("epoch")


def _create(spark: SparkSession, path: str, schema) -> None:
    _write(spark.createDataFrame([], schema), path, -1)


def _run(writer) -> None:
    q = writer.trigger(availableNow=True).start()
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))


@contextmanager
def _state_partitions(spark: SparkSession, n: int | None):
    """A query first started inside has ``n`` state partitions (None: the session's shuffle partitions), for good."""
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    spark.conf.set(key, str(n or before))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def with_arrival(stream: DataFrame) -> DataFrame:
    """``arrived``: the time of the row's micro-batch, the same for all its rows and when it is replayed."""
    return stream.withColumn("arrived", F.current_timestamp())


def stream_claims(stream: DataFrame, root: str, mode: str = "keyed", watermark: str | None = None) -> str:
    """First-seen (site, canonical URL) as captures arrive; returns the sink path.

    ``mode="keyed"`` (default): a streaming aggregation keeps each key's first capture, by batch, then time,
    then URL, in the state store.  Copies collapse by partial aggregation before the shuffle, so a URL that
    holds a third of the rows never lands whole in one task; a batch looks up its own keys only, however many
    claims there are.  A key is emitted in the batch that saw it first.  The state holds one row a key for
    good; a cluster keeps it on disk with the RocksDB provider (README).  ``mode="state"``: ``withWatermark``
    + ``dropDuplicatesWithinWatermark``; the state is bounded by ``watermark``, which has to be given.  Input
    needs (site_id, url, fetched_at); event time is cast to TIMESTAMP.
    """
    s = O.with_norm(stream.withColumn("fetched_at", F.col("fetched_at").cast("timestamp")))
    out, keys = f"{root}/claims", ["site_id", "norm_url"]
    if mode == "state":
        if not watermark:
            raise ValueError("mode='state' needs a watermark: it bounds the state")
        claims = s.withWatermark("fetched_at", watermark).dropDuplicatesWithinWatermark(keys) \
            .select(*keys, "url", "fetched_at")
        _run(claims.writeStream.format("parquet").option("path", out)
             .option("checkpointLocation", f"{root}/_ckpt_claims").outputMode("append"))
        return out
    seen = with_arrival(s).groupBy(*keys).agg(
        F.min(F.struct("arrived", "fetched_at", "url")).alias("first"), F.max("arrived").alias("last"))
    claims = seen.filter(F.col("first.arrived") == F.col("last")).select(*keys, "first.url", "first.fetched_at")
    _create(stream.sparkSession, out, claims.schema)
    _run(claims.writeStream.outputMode("update").foreachBatch(lambda batch, epoch: _write(batch, out, epoch))
         .option("checkpointLocation", f"{root}/_ckpt_claims"))
    return out


def stream_extract(stream: DataFrame, root: str, keys: list[str], url_col: str = "url", body_col: str = "body",
                   ctype_col: str | None = "content_type") -> dict[str, str]:
    """Stateless extraction on arrival; each micro-batch appends links, assets and SEO tables."""
    ex = X.extract_pages(stream, url_col=url_col, body_col=body_col, ctype_col=ctype_col)
    paths = {k: f"{root}/{k}" for k in ("links", "assets", "seo")}

    def sink(batch: DataFrame, epoch: int) -> None:
        b = batch.select(*keys, "links", "assets", "seo").persist()
        _write(X.explode_positions(b, keys, "links", ("pos", "link")), paths["links"], epoch)
        _write(X.explode_positions(b, keys, "assets", ("pos", "a")).select(*keys, "pos", "a.url", "a.type"),
               paths["assets"], epoch)
        _write(b.select(*keys, "seo.*"), paths["seo"], epoch)
        b.unpersist()

    _run(ex.writeStream.foreachBatch(sink).option("checkpointLocation", f"{root}/_ckpt_extract"))
    return paths


def stream_broken_links(links_static: DataFrame, probes_stream: DataFrame, root: str) -> str:
    """As probe captures land, emit broken (page, link) pairs exactly once.

    The first HEAD and GET of each URL are kept in the state store by a streaming aggregation (a GET may
    arrive in a later batch than its HEAD); a batch looks up only the URLs that it touches.  The URLs whose
    outcome turned broken in this batch are joined with the page links, which are stored once.  A URL whose
    HEAD failed and whose GET has not come yet is not resolved and emits nothing.  Of several captures of one
    method the first to arrive counts, and in one batch the first by time.
    """
    out = f"{root}/broken"
    spark = links_static.sparkSession
    links = store(links_static, "page-links")
    status = O.resolve_link_probe(with_arrival(probes_stream))
    turned = status.filter(S.is_broken(F.col("status_code"), F.col("error")) & (F.col("decided") == F.col("arrived"))) \
        .drop("decided", "arrived")
    hot = hot_keys(links, R.link_key("exact"))
    _create(spark, out, R.broken_links(links, spark.createDataFrame([], turned.schema), hot=hot).schema)

    def sink(batch: DataFrame, epoch: int) -> None:
        _write(R.broken_links(links, batch, hot=hot), out, epoch)

    _run(turned.writeStream.outputMode("update").foreachBatch(sink).option("checkpointLocation", f"{root}/_ckpt_broken"))
    return out


FRONTIER = "site_id string, norm_url string, depth int"
# A link of a page that came (depth 0 where it is the root's page, else null), or without ``dst`` a message.
STEP = "site_id string, norm_url string, dst string, depth int"


def frontier_rounds(pages_stream: DataFrame, sites: DataFrame, root: str, keys: list[str], partitions: int | None = None) -> str:
    """T4: incremental BFS by messages; returns the frontier's path.

    One stream turns pages into links as they come.  A second keeps in the state store, a URL, its least depth and the
    links of its page (bounded by the page).  It reads those links and its own messages "this URL is at depth d": a URL
    whose depth fell, or whose page came, sends d + 1 along its links while the site's limit allows it; what is
    already known at that depth or less answers nothing.  So a batch touches the URLs that its links and messages name,
    however many were reached before.  Copies of a message are combined before they are written and again before the shuffle.

    Every URL is in the table once for each fall of its depth: min(depth) over it equals the batch BFS.  The roots
    are in it from the start.  All rounds are batches of one query, which keeps its state at hand between them; a run ends
    when a batch sends no message and nothing else has come.  A replayed batch has the time, input and state that it had,
    and overwrites its own rows.

    A round costs a state file and a few tasks for each of ``partitions`` (default: the session's shuffle partitions),
    however few its messages are.  The number is set by the first run on ``root``: give it for all pages that are to come.
    """
    spark = sites.sparkSession
    sites = store(sites.select("site_id", "root_url", "depth"), "sites")    # every batch reads them
    out, found, inbox, key = f"{root}/frontier", f"{root}/links", f"{root}/messages", ["site_id", "norm_url"]
    limits = sites.select("site_id", F.col("depth").alias("limit"))
    seeds = sites.select("site_id", F.coalesce(U.normalize_url("root_url"), F.lit("")).alias("norm_url"), F.lit(0).alias("depth"))
    _write(seeds, out, -1)
    # never written again: an unfinished batch may have to read it
    spark.createDataFrame([], STEP).write.mode("ignore").parquet(_epoch_dir(inbox, -1))

    ex = X.extract_pages(pages_stream, ctype_col=None)
    links = O.with_norm(ex.select(*keys, "url", "links")).select(
        *keys, F.col("norm_url").alias("src"), F.explode_outer("links").alias("link")).filter(F.col("link").isNotNull())
    edges = G.same_host_edges(links, sites).select(
        "site_id", F.col("src").alias("norm_url"), "dst", F.when(F.col("from_root"), F.lit(0)).alias("depth"))
    _run(edges.writeStream.format("parquet").option("path", found).option("checkpointLocation", f"{root}/_ckpt_links"))

    steps = spark.readStream.schema(STEP).parquet(found).unionByName(
        spark.readStream.schema(STEP).option("recursiveFileLookup", "true").parquet(inbox))
    state = with_arrival(steps).groupBy(*key).agg(
        F.min(F.when(F.col("depth").isNotNull(), F.struct("depth", "arrived"))).alias("best"),
        F.collect_set("dst").alias("dsts"),
        F.max(F.struct("arrived", F.col("dst").isNotNull().alias("came"))).alias("last")).filter("best IS NOT NULL")

    def sink(batch: DataFrame, epoch: int) -> None:
        fell = F.col("best.arrived") == F.col("last.arrived")
        b = batch.select(*key, F.col("best.depth").alias("depth"), "dsts", fell.alias("fell"), "last.came").persist()
        _write(b.filter("fell AND depth > 0").select(*key, "depth"), out, epoch)
        onward = with_site(b.filter("(fell OR came) AND size(dsts) > 0"), limits, ["norm_url"]).filter(F.col("limit") > F.col("depth") + 1)
        if not onward.isEmpty():    # else no file: an empty one would be input of another round
            onward = onward.select("site_id", F.explode("dsts").alias("norm_url"), (F.col("depth") + 1).alias("depth")) \
                .groupBy(*key).agg(F.min("depth").alias("depth"))
            _write(onward.select(*key, F.lit(None).cast("string").alias("dst"), "depth"), inbox, epoch)
        b.unpersist()

    with _state_partitions(spark, partitions):
        rounds = state.writeStream.outputMode("update").foreachBatch(sink).option("checkpointLocation", f"{root}/_ckpt_frontier").start()
    try:
        rounds.processAllAvailable()
    finally:
        rounds.stop()
    return out
