"""Piece encoding and token alignment against the libraries and a brute-force version."""

from __future__ import annotations

import hashlib
from collections import Counter, defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from orderlens.llm import alignment, pieces
from orderlens.llm.queries import op11_token_alignment, op13_sentencepiece, tokenizer_path
from tests.conftest import SMALL

PIECES = tokenizer_path("piece_bpe_32k.model")
BYTES = tokenizer_path("byte_bpe_50k.json")
ODD = "▁ a  b\n\t the<0x41><unk></s> é日本😀 \x00\x85 ﬁ..., <|endoftext|> don't 's ▁▁x "


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(max_size=70) | st.text("ab the\n▁.'é日", max_size=70), max_size=5))
def test_pieces_are_the_library_s(texts):
    encoder = pieces.worker_encoder(PIECES)
    library = encoder.vocabulary.library
    texts = [*texts, ODD, *(f"{t} x{t}" for t in texts)]
    bounds, flat, written = encoder.encode(texts)
    want = library.encode(texts)
    assert [flat[a:b].tolist() for a, b in zip(bounds, bounds[1:])] == want
    assert written == [",".join(map(str, x)) for x in want]
    assert [encoder.vocabulary.encode(t) for t in texts] == want
    assert [encoder.vocabulary.decode(x) for x in want] == library.decode(want)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 31_999) | st.integers(0, 300), max_size=9))
def test_any_ids_decode_as_the_library_decodes_them(ids):
    vocabulary = pieces.worker_encoder(PIECES).vocabulary
    if 0 not in ids:  # the library shows the unknown id by a surface of its own
        assert vocabulary.decode(ids) == vocabulary.library.decode(ids)


def test_long_parts_take_the_heap():
    vocabulary = pieces.worker_encoder(PIECES).vocabulary
    for text in ("the" * 5_000, "=" * 999 + "ab" * 999, "日本語" * 300):
        assert vocabulary.encode(text) == vocabulary.library.encode(text)


def test_a_full_memory_starts_anew(monkeypatch):
    from orderlens.llm import spaced

    monkeypatch.setattr(spaced, "REMEMBERED", 3)
    encoder = pieces.BatchEncoder(PIECES)
    for text in ("one two three four five", "six one two", "seven", "one two six"):
        bounds, flat, _ = encoder.encode([text, text])
        assert flat[: bounds[1]].tolist() == encoder.vocabulary.library.encode(text)


def test_registered_pieces(spark):
    library = pieces.worker_encoder(PIECES).vocabulary.library
    want = {}
    for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect():
        ids = library.encode(r.text or "")
        want[r.doc_id] = (len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids)))
    rows = op13_sentencepiece(spark, SMALL).collect()
    assert {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in rows} == want
    assert all(r.agrees and r.round_trip for r in rows)


def test_awkward_rows_as_pieces(spark, documents, awkward):
    rows = [*awkward, (20, ODD), (21, "=" * 30_000)]
    docs = documents(rows, clash=("ids", "n_tokens", "agrees"))
    got = pieces.encoded(docs, PIECES).collect()
    assert len(got) == len(rows) and all(r.agrees for r in got)
    empty = [r for r in got if r.doc_id in (2, 3)]
    assert {(r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in empty} == {(0, sha(""), sha(""))}
    back = {r.doc_id: r.text for r in pieces.texts_of(pieces.token_ids(docs, PIECES), PIECES).collect()}
    assert back[13] == dict(rows)[13] and back[2] == "" and back[21] == "=" * 30_000
    assert pieces.encoded(documents([]), PIECES).collect() == []
    assert pieces.encoded(docs, PIECES, check=False).where("agrees is not null").count() == 0


def brute_links(rows):
    """The contract word for word: (number of row) -> columns."""
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    a, b = Tokenizer.from_file(BYTES), SentencePieceProcessor(model_file=PIECES)
    a.encode_special_tokens = True
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte = {chr(x): x for x in shown} | {chr(256 + k): x for k, x in enumerate(sorted(set(range(256)) - set(shown)))}

    def bytes_a(i):
        return bytes(byte[c] for c in a.id_to_token(i))

    def bytes_b(i):
        name = b.id_to_piece(i)
        return bytes([int(name[3:5], 16)]) if b.is_byte(i) else name.replace("▁", " ").encode()

    groups, links = {}, {}
    sizes = {}
    for row, text in enumerate(rows):
        groups[row], links[row], sizes[row] = [], Counter(), (0, 0)
        if not text:
            continue
        x, y = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        whole = (" " + text).encode()
        if b"".join(map(bytes_a, x)) != whole or b"".join(map(bytes_b, y)) != whole:
            continue
        sizes[row] = len(x), len(y)
        ends = [], []
        for side, ids, spell in ((0, x, bytes_a), (1, y, bytes_b)):
            at = 0
            for i in ids:
                at += len(spell(i))
                ends[side].append(at)
        for end in sorted({*ends[0]} & {*ends[1]}):
            groups[row].append(([i for i, e in zip(x, ends[0]) if e <= end], [i for i, e in zip(y, ends[1]) if e <= end]))
            x, y = x[len(groups[row][-1][0]) :], y[len(groups[row][-1][1]) :]
            ends = [e for e in ends[0] if e > end], [e for e in ends[1] if e > end]
        for one, two in groups[row]:
            links[row].update((i, j) for i in one for j in two)
    count = Counter(p for row in links for p in links[row])
    most = defaultdict(int)
    for (i, _), n in count.items():
        most[i] = max(most[i], n)
    out = {}
    for row in groups:
        shown = ";".join(f"{','.join(map(str, i))}|{','.join(map(str, j))}" for i, j in groups[row])
        out[row] = (
            *sizes[row], len(groups[row]), sum(links[row].values()),
            sum(n for p, n in links[row].items() if count[p] == most[p[0]]),
            sum(n * count[p] for p, n in links[row].items()), sha(shown) if shown else "",
        )
    return out


def measured(df):
    names = "n_a n_b n_groups n_links n_best count_sum groups_sha256".split()
    return [(r.doc_id, tuple(r[n] for n in names)) for r in df.collect()]


def test_registered_alignment(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    short = [(d, t) for d, t in rows if len(t or "") < 6_000]  # the brute-force cuts are quadratic
    docs = spark.createDataFrame(short, "doc_id long, text string").repartition(3)
    want = brute_links([t for _, t in short])
    got = dict(measured(alignment.links(docs, BYTES, PIECES)))
    assert got == {short[k][0]: v for k, v in want.items()}
    whole = dict(measured(op11_token_alignment(spark, SMALL)))
    assert {d: v[:4] for d, v in whole.items() if d in got} == {d: v[:4] for d, v in got.items()}
    assert len(whole) == len(rows)


@pytest.mark.parametrize("block_bytes", [1, 24_000_000])
def test_awkward_rows_aligned(spark, documents, awkward, monkeypatch, block_bytes):
    monkeypatch.setattr(alignment, "_BLOCK_BYTES", block_bytes)
    texts = [*(t for _, t in awkward if len(t or "") < 10_000), ODD, ODD.replace("▁", ""), "日本😀" * 40, " lead", "trail \n", "it's"]
    rows = [(k if k % 5 else None, t) for k, t in enumerate(texts)]
    docs = documents(rows, clash=("block", "pairs", "at", "pair", "n")).repartition(2)
    want = brute_links(texts)
    got = measured(alignment.links(docs, BYTES, PIECES))
    assert sorted(v for _, v in got) == sorted(want.values())
    assert {d: v for d, v in got if d is not None} == {k: v for k, v in want.items() if k % 5}
    assert measured(alignment.links(documents([]), BYTES, PIECES)) == []
