import hashlib

import pytest
from tests.llm.conftest import rows_of
from tokenizers import Tokenizer

from candela.llm import bpe
from candela.llm.queries import TOKENIZER


def test_round_trip_equals_the_library(docs, corpus):
    t = Tokenizer.from_file(TOKENIZER)
    want = []
    for i, text in corpus:
        ids = t.encode(text or "", add_special_tokens=False).ids
        out = t.decode(ids, skip_special_tokens=False)
        want.append((i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(out.encode()).hexdigest()))
    assert rows_of(bpe.round_trip(docs, TOKENIZER, block_bytes=4000)) == sorted(want, key=repr)


def test_ids_and_decoding(spark, docs, corpus):
    t = Tokenizer.from_file(TOKENIZER)
    encoded = bpe.encode(docs, TOKENIZER)
    assert rows_of(encoded) == sorted(((i, t.encode(x or "", add_special_tokens=False).ids) for i, x in corpus), key=repr)
    want = sorted(((i, t.decode(t.encode(x or "", add_special_tokens=False).ids, skip_special_tokens=False)) for i, x in corpus), key=repr)
    assert rows_of(bpe.decode(encoded, TOKENIZER)) == want
    odd = spark.createDataFrame([(1, None), (2, []), (3, [320, None, -1, 10**6, 49407]), (None, [320])], "doc_id long, ids array<int>")
    assert rows_of(bpe.decode(odd, TOKENIZER)) == sorted([(1, ""), (2, ""), (3, t.decode([320, 49407], skip_special_tokens=False)), (None, t.decode([320]))], key=repr)


def test_empty_and_decoder(no_docs):
    assert bpe.round_trip(no_docs, TOKENIZER, with_ids=True).collect() == []
    with pytest.raises(ValueError, match="decoder"):
        bpe.pieces_of('{"decoder": {"type": "ByteLevel"}}')
