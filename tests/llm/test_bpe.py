import hashlib
import random

import pytest
import tiktoken

from factloom.llm import bpe


@pytest.fixture(scope="module")
def coders():
    raw, pattern = bpe.public("byte_bpe_50k.tiktoken")
    own = bpe.Coder(raw, pattern)
    return own, tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=own.ranks, special_tokens={}), raw, pattern


def texts():
    rng = random.Random(3)
    alphabet = "abc dEé  \x1c\x1f\x85\n\t\r 0129½٣,.'!日本🙂‍﻿ǅªß'll'S"
    out = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 80))) for _ in range(400)]
    return out + ["a" * 20000, "ab" * 9000 + " x", "\n" * 5000, " " * 3000 + "x", "<|endoftext|>", "", "thanedble ereou " * 300]


def test_equals_the_library(coders):
    own, library, _, _ = coders
    for text in texts():
        packed = own.encode(text)
        assert list(memoryview(packed).cast("I")) == library.encode_ordinary(text)
        assert own.decode(packed) == text.encode()


def test_a_small_memo_changes_nothing(coders, monkeypatch):
    monkeypatch.setattr(bpe, "MEMO", 5)
    _, library, raw, pattern = coders
    own = bpe.Coder(raw, pattern)
    for text in texts()[:60]:
        assert list(memoryview(own.encode(text)).cast("I")) == library.encode_ordinary(text)


def test_query_columns_and_edges(spark, coders):
    _, library, raw, pattern = coders
    rows = [(i, t) for i, t in enumerate(texts()[:50])] + [(None, "x"), (7, None), (7, "same"), (7, "same")]
    df = spark.createDataFrame([(a, b, 1) for a, b in rows], "doc_id bigint, text string, n_tokens int").repartition(2)
    out = bpe.encode(df, raw, pattern, ids=True)
    want = []
    for i, t in rows:
        ids = library.encode_ordinary(t or "")
        packed = b"".join(x.to_bytes(4, "little") for x in ids)
        want.append((i, len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest(), ids))
    assert sorted(map(str, (tuple(r) for r in out.collect()))) == sorted(map(str, want))
    assert all(bytes(r["decoded"]) == library.decode_bytes(r["token_ids"]) for r in bpe.decode(out, raw, pattern).collect())
    assert bpe.encode(df.limit(0), raw, pattern).count() == 0
