import hashlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from footfall.llm import bpe, queries

from .conftest import ROWS

RANKS = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
TOOL = bpe.Encoder(RANKS, public_tokenizers.PATTERN)
OTHER = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})


def split(values, ends):
    return [values[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist())]


@settings(deadline=None, max_examples=150)
@given(st.lists(st.text(st.characters(exclude_categories=["Cs"])) | st.text(" \n\tab'é!7　"), max_size=4))
def test_ids_equal_the_library(texts):
    ids, ends = TOOL.encode(texts)
    assert [i.tolist() for i in split(ids, ends)] == [OTHER.encode_ordinary(t) for t in texts]
    found, stops = TOOL.decode(ids, ends)
    assert [f.tobytes().decode() for f in split(found, stops)] == texts


def test_every_slot_of_the_hash_has_its_key():
    assert sorted(TOOL.table.order.tolist()) == list(range(len(RANKS)))
    assert TOOL.table.find(TOOL.tokens).tolist() == list(range(len(RANKS)))


def test_long_pretokens_and_unknown_ids():
    text = "ab" * 200_000
    assert TOOL.encode([text])[0].tolist() == OTHER.encode_ordinary(text)
    with pytest.raises(ValueError):
        TOOL.decode(np.array([50_256]), np.array([1]))


def test_odd_rows(spark, odd, none):
    shared = bpe.encoder(spark, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    ids = bpe.tokenized(odd, shared)
    found = sorted(((r.doc_id, list(r.ids)) for r in ids.collect()), key=str)
    assert found == sorted(((i, OTHER.encode_ordinary(t or "")) for i, t in ROWS), key=str)
    back = bpe.detokenized(ids, shared).collect()
    assert sorted(((r.doc_id, bytes(r.decoded).decode()) for r in back), key=str) == sorted(
        ((i, t or "") for i, t in ROWS), key=str)
    assert bpe.round_trip(none, shared).count() == 0


def test_query(spark, docs):
    found = {r.doc_id: r for r in queries.op2_bpe(spark, "/root/testdata/sf0.001").collect()}
    for r in docs.collect():
        ids = OTHER.encode_ordinary(r.text or "")
        assert found[r.doc_id].n_tokens == len(ids)
        assert found[r.doc_id].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert found[r.doc_id].decoded_sha256 == hashlib.sha256((r.text or "").encode()).hexdigest()
