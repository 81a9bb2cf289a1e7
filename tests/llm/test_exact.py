"""Exact dedup, substring dedup and the n-gram join against their contracts."""

from __future__ import annotations

import hashlib
import re
import uuid

import pytest

from orderlens.llm import blocks, exact_dedup, ngram_join, quality, substring_dedup
from orderlens.llm.components import components
from orderlens.session import shared_dir
from tests.conftest import SMALL
from tests.llm import brute


def index(spark, path=None):
    path = path or f"{shared_dir(spark)}/index-{uuid.uuid4().hex}"
    return exact_dedup.DigestIndex(spark, f"i{uuid.uuid4().hex}", path, 3)


def bare(text):
    return re.sub(r"[\x20\x09-\x0D]", "", text or "")


def test_exact_dedup_of_awkward_rows(spark, documents, awkward):
    docs = documents(awkward, clash=("digest", "keep_id", "length"))
    rows = exact_dedup.dedup(spark, docs, index(spark), "a").collect()
    assert len(rows) == len(awkward)
    groups = {}
    for doc_id, text in awkward:
        groups.setdefault(bare(text), []).append((-len(text or ""), doc_id is None, doc_id or 0, doc_id))
    want = []
    for key, members in groups.items():
        keep = min(members)[3]
        sha = hashlib.sha256(key.encode()).hexdigest()
        want += [(m[3], keep, len(members), k == 0, sha) for k, m in enumerate(sorted(members))]
    order = lambda r: tuple(map(str, r))
    assert sorted(map(tuple, rows), key=order) == sorted(want, key=order)


def test_one_row_of_a_group_stays(spark, documents):
    rows = [(1, "a b"), (1, "a b"), (1, "ab"), (2, "ab"), (None, "z"), (None, "z")]
    kept = exact_dedup.dedup(spark, documents(rows), index(spark), "a").where("kept").collect()
    assert sorted((str(r.doc_id), r.group_size) for r in kept) == [("1", 4), ("None", 2)]


def test_exact_dedup_of_batches(spark, documents):
    first = index(spark)
    exact_dedup.dedup(spark, documents([(1, "a b"), (2, "c")]), first, "one").collect()
    again = exact_dedup.DigestIndex(spark, f"i{uuid.uuid4().hex}", first.path, 3)
    rows = exact_dedup.dedup(spark, documents([(0, "ab"), (3, "d")]), again, "two").collect()
    assert {(r.doc_id, r.keep_id, r.kept) for r in rows} == {(0, 1, False), (3, 3, True)}
    # the same batch once more changes nothing
    exact_dedup.dedup(spark, documents([(0, "ab"), (3, "d")]), again, "two").collect()
    assert again.rows().count() == 3


def test_exact_dedup_of_nothing(spark, documents):
    assert exact_dedup.dedup(spark, documents([]), index(spark), "a").count() == 0


def test_the_index_is_read_in_its_buckets(spark, documents):
    made = index(spark)
    exact_dedup.dedup(spark, documents([(1, "a")]), made, "a")
    assert "SelectedBucketsCount" in made.seen().groupBy("digest").count()._jdf.queryExecution().toString()


@pytest.mark.parametrize("block_bytes", [3_000, 10_000_000])
def test_substring_dedup_of_awkward_rows(documents, awkward, block_bytes):
    once = [r for r in dict.fromkeys(awkward) if r[0] is not None]
    found = substring_dedup.dedup(documents(once, clash=("n_words", "spans")), block_bytes=block_bytes)
    got = {r[0]: tuple(r[1:4]) for r in found.collect()}
    assert got == brute.substring(once)


def test_substring_dedup_counts_only_smaller_ids(documents, awkward):
    rows = substring_dedup.dedup(documents(awkward), with_text=True).collect()
    assert len(rows) == len(awkward)
    twins = [r for r in rows if r.doc_id == 1]
    assert [r.n_removed for r in twins] == [0, 0]
    last = next(r for r in rows if r.doc_id is None)
    assert last.n_removed == 14 and last.kept_text == "" and [tuple(s) for s in last.spans] == [(0, 14)]


def test_substring_dedup_of_nothing(documents):
    assert substring_dedup.dedup(documents([])).count() == 0


@pytest.mark.parametrize("block_bytes", [20_000, 10_000_000])
def test_substring_dedup_of_the_small_table(spark, block_bytes):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    got = {r[0]: tuple(r[1:4]) for r in substring_dedup.dedup(docs, block_bytes=block_bytes).collect()}
    assert got == brute.substring(rows)


@pytest.mark.parametrize("block_bytes", [3_000, 10_000_000])
def test_ngram_join_of_awkward_rows(documents, awkward, block_bytes):
    once = [r for r in dict.fromkeys(awkward) if r[0] is not None]
    found = ngram_join.join(documents(once, clash=("n", "uid", "digest", "tokens")), block_bytes)
    assert {r[0]: tuple(r[1:]) for r in found.collect()} == brute.components(once)


def test_ngram_join_of_repeated_and_null_ids(documents, awkward):
    rows = ngram_join.join(documents(awkward)).collect()
    assert len(rows) == len(awkward)
    assert next(r for r in rows if r.doc_id is None).component_id == 1
    assert {r.component_id for r in rows if r.doc_id == 1} == {1}


def test_ngram_join_of_nothing(documents):
    assert ngram_join.join(documents([])).count() == 0


@pytest.mark.parametrize("block_bytes", [20_000, 10_000_000])
def test_ngram_join_of_the_small_table(spark, block_bytes):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    got = {r[0]: tuple(r[1:]) for r in ngram_join.join(docs, block_bytes).collect()}
    assert got == brute.components(rows)


def test_ngram_join_of_chains_and_limits(documents):
    """Texts that differ by more and more words: links only between neighbours, at the limit."""
    base = [f"t{k}" for k in range(60)]
    rows = []
    for step in range(12):
        words = list(base)
        for k in range(step):
            words[(k * 11) % 60] = f"n{k}"
        rows.append((100 - step, " ".join(words)))
    rows += [(200 + n, " ".join(base[: 60 - n])) for n in (0, 13, 14, 15, 16, 17)]
    rows += [(300 + n, " ".join(f"u{k}" for k in range(n))) for n in (3, 4, 5, 6, 7, 8, 12, 15, 16)]
    got = {r[0]: tuple(r[1:]) for r in ngram_join.join(documents(rows)).collect()}
    assert got == brute.components(rows)


def test_documents_of_far_components_are_not_compared_one_by_one(documents, monkeypatch):
    """Families of near copies that share a passage: pairs of families are looked at, not pairs of documents."""
    import random

    dice = random.Random(4)
    words = lambda n: [f"w{dice.randrange(10**9)}" for _ in range(n)]
    passage, rows = words(40), []
    for family in range(4):
        body = words(200)
        for copy in range(8):
            own = list(body)
            own[dice.randrange(200)] = f"x{family}y{copy}"
            rows.append((10 * family + copy, " ".join(own + passage * (copy < 2))))
    seen, near = [], ngram_join._near_groups

    def counted(groups):
        pairs = near(groups)
        seen.append((groups.count(), pairs.count()))
        return pairs

    monkeypatch.setattr(ngram_join, "_near_groups", counted)
    got = {r[0]: tuple(r[1:]) for r in ngram_join.join(documents(rows)).collect()}
    assert got == brute.components(rows)
    ((groups, pairs),) = seen
    assert groups >= 4 and not pairs


def test_components_of_a_path_and_a_star(spark):
    links = [(k, k + 1) for k in range(20)] + [(100, k) for k in range(101, 140)] + [(7, 7), (1, 0)]
    got = dict(map(tuple, components(spark.createDataFrame(links, "a long, b long")).collect()))
    assert got == {k: 0 for k in range(21)} | {k: 100 for k in range(100, 140)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_hash_codec():
    import numpy as np

    values = np.sort(np.random.default_rng(1).integers(0, 2**64, 1000, dtype=np.uint64))
    assert (blocks.decoded(blocks.encoded(values)) == values).all()
    assert len(blocks.decoded(blocks.encoded(values[:0]))) == 0


def test_a_tree_of_nodes_is_as_wide_as_it_must_be():
    for n in (1, 2, 31, 32, 33, 171, 1024, 1025, 10_000, 20_000_000):
        fan, levels = blocks.tree(n)
        assert 1 <= fan <= blocks.FAN and fan**levels >= n and (levels == 1 or blocks.FAN ** (levels - 1) < n)


def test_exchange_over_many_levels(spark, monkeypatch):
    """Nodes over nodes give what one level of them gives."""
    monkeypatch.setattr(blocks, "FAN", 2)
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = {r[0]: tuple(r[1:4]) for r in substring_dedup.dedup(docs, block_bytes=60_000).collect()}
    assert got == brute.substring(rows)
    got = {r[0]: tuple(r[1:]) for r in ngram_join.join(docs, 60_000).collect()}
    assert got == brute.components(rows)
    known = spark.read.parquet(f"{SMALL}/labels.parquet")
    whole = {r.doc_id: r.log_perplexity for r in quality.perplexities(docs, known).collect()}
    for r in quality.perplexities(docs, known, block_bytes=60_000).collect():
        assert r.log_perplexity == pytest.approx(whole[r.doc_id], rel=1e-6)


def test_blocks_are_cut_by_bytes(documents):
    """Long texts with neighbouring ids do not fall into one block."""
    docs = documents([(k, "word " * (4_000 if k < 20 else 4)) for k in range(400)])
    bounds = blocks.bounds_of(docs, 40_000)
    assert sum(b < 20 for b in bounds) >= 4
