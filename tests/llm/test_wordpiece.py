import random

import public_tokenizers

from factloom.llm import wordpiece


def greedy(word, initial, inner):
    n, at = 0, 0
    while at < len(word):
        known = initial if at == 0 else inner
        end = next((e for e in range(len(word), at, -1) if word[at:e] in known), None)
        if end is None:
            return 0
        n, at = n + 1, end
    return n


def test_equals_greedy_longest_match():
    rng = random.Random(2)
    for _ in range(60):
        piece = lambda n: "".join(rng.choice("abc") for _ in range(rng.randint(1, n)))
        initial, inner = {piece(4) for _ in range(8)}, {piece(5) for _ in range(8)}
        own = wordpiece.Automaton(sorted(initial), sorted(inner))
        for _ in range(200):
            word = piece(14)
            assert own.count(word) == greedy(word, initial, inner), (word, initial, inner)


def test_public_vocabulary_and_edges(spark):
    pieces = wordpiece.vocabulary(public_tokenizers.path("piece_bpe_32k.model"))
    initial, inner = map(set, pieces)
    texts = ["The quick brown fox, doesn't jump.", "Œuvre日本 naïve " * 40, "x" * 30000, "", None, " \t\n", "a\x1cb"]
    df = spark.createDataFrame([(1, t, 5) for t in texts] + [(None, "a", 5)], "doc_id bigint, text string, n_words int")
    got = sorted(map(str, (tuple(r) for r in wordpiece.token_counts(df, pieces).collect())))
    want = []
    for i, t in [(1, t) for t in texts] + [(None, "a")]:
        counts = [greedy(w.decode(), initial, inner) for w in (t or "").encode().split()]
        want.append((i, len(counts), sum(counts) + counts.count(0), counts.count(0)))
    assert got == sorted(map(str, want))
    assert wordpiece.token_counts(df.limit(0), pieces).count() == 0
