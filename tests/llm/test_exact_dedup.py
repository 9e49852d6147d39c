import hashlib
import re
from collections import Counter, defaultdict

import pytest

from sitelens.llm import exact_dedup
from tests.llm import cases


def brute(rows):
    groups = defaultdict(list)
    for doc_id, text, *_ in rows:
        groups[hashlib.sha256(re.sub(r"[\x20\x09-\x0D]", "", text or "").encode()).hexdigest()].append((doc_id, text or ""))
    out = []
    for sha, members in groups.items():
        keep = min(members, key=lambda m: (-len(m[1]), m[0] is None, m[0] or 0))[0]
        out += [(doc_id, keep, len(members), sha) for doc_id, _ in members]
    return Counter(out), len(groups)


def test_odd_documents_against_brute_force(spark):
    got = exact_dedup.decisions(cases.odd_docs(spark)).collect()
    expected, groups = brute(cases.odd_rows())
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == expected
    kept = [r for r in got if r.kept]
    assert len(kept) == groups == len({r.text_sha256 for r in kept})
    assert all(r.doc_id == r.keep_id for r in kept)


def test_drop_copies_keeps_one_row_and_all_columns(spark):
    docs = cases.odd_docs(spark)
    out = exact_dedup.drop_copies(docs)
    assert out.columns == docs.columns
    rows = out.collect()
    assert len(rows) == brute(cases.odd_rows())[1]
    assert {r.digest for r in rows} == {"z"}


def test_empty_table(spark):
    assert exact_dedup.decisions(cases.no_docs(spark)).collect() == []
    assert exact_dedup.drop_copies(cases.no_docs(spark)).collect() == []


def test_index_persists_and_takes_only_new_digests(spark):
    index = exact_dedup.DigestIndex(spark, buckets=3)
    first = spark.createDataFrame([(1, "a b"), (2, "ab"), (3, "c")], "doc_id long, text string")
    second = spark.createDataFrame([(4, "a  b"), (5, "d"), (6, "d")], "doc_id long, text string")
    exact_dedup.decisions(first, index)
    again = exact_dedup.DigestIndex(spark, name=index.name, path=index.path)
    got = {r.doc_id: (r.keep_id, r.kept) for r in exact_dedup.decisions(second, again).collect()}
    assert got == {4: (1, False), 5: (5, True), 6: (5, False)}
    assert again.rows().count() == 3


def test_the_known_side_is_not_shuffled(spark):
    index = exact_dedup.DigestIndex(spark, buckets=4)
    docs = spark.createDataFrame([(k, f"t{k}") for k in range(50)], "doc_id long, text string")
    exact_dedup.decisions(docs, index)
    new = exact_dedup.digest_rows(docs).select("digest").hint("merge")
    plan = new.join(index.rows().select("digest").hint("merge"), "digest", "left_anti")._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and plan.count("Exchange hashpartitioning") == 1


def test_an_index_keeps_its_bucket_count(spark):
    """Opened where another number of shuffle partitions is set, and under another table name."""
    docs = spark.createDataFrame([(k, f"t{k % 700}") for k in range(1000)], "doc_id long, text string")
    index = exact_dedup.DigestIndex(spark, buckets=8)
    exact_dedup.decisions(docs, index)
    again = exact_dedup.DigestIndex(spark, path=index.path)
    assert again.buckets == 8
    got = exact_dedup.decisions(docs, again).collect()
    assert len(got) == 1000 and not any(r.kept for r in got) and index.unbucketed().count() == 700
    with pytest.raises(ValueError):
        exact_dedup.DigestIndex(spark, path=index.path, buckets=4)


def test_a_batch_run_again_gets_its_decisions(spark):
    index = exact_dedup.DigestIndex(spark, buckets=3)
    docs = spark.createDataFrame([(k, f"t{k % 30}") for k in range(50)], "doc_id long, text string").coalesce(1)
    key = lambda r: r.doc_id
    once = sorted(exact_dedup.decisions(docs, index, batch="b1").collect(), key=key)
    assert sorted(exact_dedup.decisions(docs, index, batch="b1").collect(), key=key) == once and sum(r.kept for r in once) == 30
    assert not any(r.kept for r in exact_dedup.decisions(docs, index, batch="b2").collect())


def test_the_longest_of_several_rows_with_one_id_stays(spark):
    docs = spark.createDataFrame([(1, "a b"), (1, "a   b"), (1, "ab"), (2, "a  b")], "doc_id long, text string").repartition(4)
    assert [tuple(r) for r in exact_dedup.drop_copies(docs).collect()] == [(1, "a   b")]
