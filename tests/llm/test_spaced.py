"""Parts of texts: cuts found in bytes against those of the pattern, and one look-up per distinct part."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from orderlens.llm import blocks, pieces, spaced, tokens
from orderlens.llm.queries import tokenizer_path

LETTERS = "ab .\n\t\x1c\x85\xa0     　▁é“»日😀\x00"


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(LETTERS + " " * 8, max_size=14) | st.text(max_size=9), max_size=6))
def test_cuts_in_bytes_are_those_of_the_pattern(texts):
    bounds, parts = spaced.cut(texts)
    found = [x[1:] for x in parts.to_pylist()]
    assert [found[a:b] for a, b in zip(bounds, bounds[1:])] == [spaced._CUT.split(t) if t else [] for t in texts]


def test_a_part_is_looked_up_once_per_batch_and_learnt_once():
    class Counted(dict):
        asked = 0

        def get(self, key):
            self.asked += 1
            return super().get(key)

    learnt, texts = [], ["a b a b", "", "b a  a", "a　b a"]
    parts = spaced.Parts(learnt.extend, learnt.clear)
    parts.known = Counted()
    first = parts.number_all(texts)
    assert parts.known.asked == len(learnt) == 4
    other = spaced.Parts(list, list)
    for a, b in zip(first, other.number(texts)):
        assert a.tolist() == b.tolist()
    assert [x.tolist() for x in parts.number_all(texts)] == [x.tolist() for x in first] and len(learnt) == 4


def test_blocks_drop_what_encoders_of_an_earlier_step_remember():
    path, other = tokenizer_path(), tokenizer_path("piece_bpe_32k.model")
    texts = pa.array(["one two"], pa.large_string())
    words, parts = tokens.encoder(path), pieces.worker_encoder(other)
    ids = words.encode(texts)[1].tolist()
    assert tokens.encoder(path) is words
    asked = blocks.Asked(blocks.questions(0, 0, 1, np.array([3, 9], np.uint64), None))
    assert asked.hashes.tolist() == [3, 9]
    assert tokens.encoder(path) is not words and pieces.worker_encoder(other) is not parts
    assert tokens.encoder(path).encode(texts)[1].tolist() == ids
