"""Token store and token counts against the tokenizers library."""

from __future__ import annotations

import uuid

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from orderlens.llm import token_counts, token_store, tokens
from orderlens.llm.queries import tokenizer_path
from orderlens.session import shared_dir
from tests.conftest import SMALL
from tests.llm import brute


def folder(spark):
    return f"{shared_dir(spark)}/t-{uuid.uuid4().hex}"


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(max_size=60), max_size=6))
def test_words_encode_as_whole_texts_do(texts):
    import pyarrow as pa
    from tokenizers import Tokenizer

    texts = [*texts, "a <|endoftext|>b<|startoftext|> don't ́x ΣΣ \x1c\x85 y"]
    whole = Tokenizer.from_file(tokenizer_path())
    bounds, ids = tokens.encoder(tokenizer_path()).encode(pa.array(texts, pa.large_string()))
    got = [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:])]
    assert got == [whole.encode(t, add_special_tokens=False).ids for t in texts]


def test_encoding_takes_few_bytes_a_token():
    import tracemalloc

    import pyarrow as pa

    texts = pa.array(["unforgettable misunderstandings 12345 " * 20_000] * 5, pa.large_string())
    words = tokens.WordEncoder(tokenizer_path())
    words.encode(texts)
    tracemalloc.start()
    _, ids = words.encode(texts)
    _, most = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert most < 20 * len(ids)


@pytest.mark.parametrize("block_bytes", [500, 1_000_000])
def test_store_round_trip(spark, block_bytes):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    root = folder(spark)
    token_store.write(docs, root, tokenizer_path(), block_bytes)
    store = token_store.TokenStore(spark, root)
    want = brute.token_digests(rows, tokenizer_path())
    assert {r[0]: tuple(r[1:]) for r in store.digests().collect()} == want
    few = [rows[3][0], rows[17][0]]
    assert {r.doc_id: (r.start, r.n_tokens) for r in store.read(few).collect()} == {k: want[k][:2] for k in few}


def test_store_of_awkward_rows(spark, documents, awkward):
    root = folder(spark)
    token_store.write(documents(awkward, clash=("part", "ids", "seq")), root, tokenizer_path())
    rows = token_store.TokenStore(spark, root).digests().orderBy("start").collect()
    assert [r.doc_id for r in rows] == [None, *sorted(x[0] for x in awkward if x[0] is not None)]
    assert {r.doc_id: r.n_tokens for r in rows}[2] == 1
    starts = [r.start for r in rows] + [rows[-1].start + rows[-1].n_tokens]
    assert [b - a for a, b in zip(starts, starts[1:])] == [r.n_tokens for r in rows]


def test_store_of_nothing(spark, documents):
    root = folder(spark)
    token_store.write(documents([]), root, tokenizer_path())
    assert token_store.TokenStore(spark, root).digests().count() == 0


def test_a_wrong_dictionary_is_refused(spark, documents):
    one, two = folder(spark), folder(spark)
    token_store.write(documents([(1, "some words here")]), one, tokenizer_path())
    token_store.write(documents([(1, "quite another text")]), two, tokenizer_path())
    store = token_store.TokenStore(spark, one)
    store.blocks = token_store.TokenStore(spark, two).blocks
    with pytest.raises(Exception, match="another dictionary"):
        store.digests().collect()


def changes(spark, rows):
    return spark.createDataFrame(rows, "op string, doc_id long, source string, lang string, text string")


def totals(rollup):
    return {(r.source, r.lang): (r.documents, r.tokens) for r in rollup.totals().collect()}


def test_rollup_of_changes(spark):
    rollup = token_counts.TokenRollup(spark, folder(spark), tokenizer_path())
    first = changes(spark, [
        ("insert", 1, "a", "en", "x y z"), ("insert", 2, "a", "en", "x"), ("insert", 3, None, None, None),
        ("insert", 2, "b", "en", "y y"), ("insert", None, "c", "de", "q"),
    ])
    assert rollup.apply("one", first)
    start = {("a", "en"): (2, 4), ("b", "en"): (1, 2), (None, None): (1, 0), ("c", "de"): (1, 1)}
    assert totals(rollup) == start
    assert not rollup.apply("one", first)
    assert totals(rollup) == start
    second = changes(spark, [
        ("delete", 2, None, None, None), ("delete", 2, None, None, None), ("delete", 99, "a", "en", "x"),
        ("revise", 1, "a", "fr", "x y"), ("revise", None, "c", "de", "q q q"), ("insert", 4, "b", "en", "w"),
    ])
    assert rollup.apply("two", second)
    assert totals(rollup) == {("a", "fr"): (1, 2), ("b", "en"): (1, 1), (None, None): (1, 0), ("c", "de"): (1, 3)}
    ledger = rollup.ledger().groupBy("source", "lang").sum("documents", "tokens").collect()
    assert {(r[0], r[1]): (r[2], r[3]) for r in ledger} == totals(rollup)


def test_rollup_without_its_log_row_is_not_counted(spark):
    """A batch that was lost before its commit is done again over the same folders."""
    rollup = token_counts.TokenRollup(spark, folder(spark), tokenizer_path())
    batch = changes(spark, [("insert", 1, "a", "en", "x y z")])
    rollup.apply("one", batch)
    lost = token_counts.TokenRollup(spark, folder(spark), tokenizer_path())
    for part in ("entries", "deltas"):
        spark.read.parquet(f"{rollup.root}/{part}/batch=one").write.parquet(f"{lost.root}/{part}/batch=one")
    assert totals(lost) == {}
    assert lost.apply("one", batch)
    assert totals(lost) == {("a", "en"): (1, 3)}


def test_rollup_of_nothing(spark):
    rollup = token_counts.TokenRollup(spark, folder(spark), tokenizer_path())
    assert rollup.apply("none-yet", changes(spark, []))
    assert totals(rollup) == {}
    with pytest.raises(ValueError):
        rollup.apply("a/b", changes(spark, []))


def test_registered_counts_equal_the_library(spark):
    from tokenizers import Tokenizer

    from orderlens.llm.queries import op7_token_counts

    t = Tokenizer.from_file(tokenizer_path())
    want = {}
    for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect():
        n, total = want.get((r.source, r.lang), (0, 0))
        want[r.source, r.lang] = (n + 1, total + len(t.encode(r.text or "", add_special_tokens=False).ids))
    got = {(r.source, r.lang): (r.documents, r.tokens) for r in op7_token_counts(spark, SMALL).collect()}
    assert got == want


def test_words_are_remembered_without_case_and_the_signs_behind_them():
    import pyarrow as pa
    from tokenizers import Tokenizer

    fresh = tokens.WordEncoder(tokenizer_path())
    texts = ["Word word, WORD... 'word' word's", "word7! word-word, (word)", "", "... , H̱! Ẅ, İ. é, …! ..."]
    bounds, ids = fresh.encode(pa.array(texts, pa.large_string()))
    whole = Tokenizer.from_file(tokenizer_path())
    assert [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:])] == [
        whole.encode(t, add_special_tokens=False).ids for t in texts
    ]
    assert {"Word", "WORD...", "word,"}.isdisjoint(fresh.known)
    assert {"word", ",", "...", "'word", "word's", "word7", "(word", "…!"} <= fresh.known.keys()
    assert fresh.counts(pa.array(["A <|EndOfText|> b.", "b."], pa.large_string())).tolist() == [
        len(whole.encode(t, add_special_tokens=False).ids) for t in ("A <|EndOfText|> b.", "b.")
    ]
