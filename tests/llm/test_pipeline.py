import re
from collections import Counter

import pytest

import corpus_pipeline
from factloom.llm import jaccard, lines, mixing, toxicity
from tests.llm import test_jaccard, test_lines, test_mixing

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    top = tmp_path_factory.mktemp("stages")
    out = [spark.read.parquet(f"{SF}/documents.parquet")]
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, out[-1], SF).write.parquet(f"{top}/{i}")
        out.append(spark.read.parquet(f"{top}/{i}"))
    return out


def test_columns_and_effects(stages):
    for before, after in zip(stages[:-2], stages[1:-1]):
        assert after.columns == before.columns and after.dtypes == before.dtypes
    assert stages[1].count() < stages[0].count() and stages[3].count() < stages[2].count()


def test_toxic_documents_go(spark, stages):
    model = toxicity.fit(stages[0], spark.read.parquet(f"{SF}/labels.parquet"))
    bad = {r["doc_id"] for r in toxicity.score(stages[0], model).collect() if r["score"] >= 0.7}
    assert {r["doc_id"] for r in stages[1].collect()} == {r["doc_id"] for r in stages[0].collect()} - bad


def test_lines_equal_brute_force(stages):
    rows = [(r["doc_id"], r["text"]) for r in stages[1].collect()]
    want = test_lines.brute(rows, lines.K, lines.LIKE, lines.LEAST_WORDS)
    assert {r["doc_id"]: (r["text"], r["n_chars"]) for r in stages[2].collect()} == {d: (t, len(t)) for d, (t, _) in want.items()}


def test_one_of_each_group_stays(stages):
    rows = [(r["doc_id"], r["text"]) for r in stages[2].collect()]
    keep = {d for d, _, c in test_jaccard.brute(rows, 5, 80) if c == d}
    assert sorted(r["doc_id"] for r in stages[3].collect()) == sorted(keep)


def test_the_mix_is_what_the_targets_say(stages):
    words = lambda t: len(re.findall(mixing.WORD, t))
    sizes, got = Counter(), Counter()
    for r in stages[3].collect():
        sizes[r["source"]] += words(r["text"])
    for r in stages[4].collect():
        got[r["source"]] += words(r["text"])
    for s, t in test_mixing.plain_targets(sizes).items():
        assert abs(got[s] - t) <= max(2, 0.01 * t, 256)


def test_tokens_of_every_row(stages):
    import tiktoken

    from factloom.llm import bpe

    raw, pattern = bpe.public("byte_bpe_50k.tiktoken")
    library = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=bpe.read_ranks(raw), special_tokens={})
    want = Counter((r["doc_id"], r["source"], tuple(library.encode_ordinary(r["text"]))) for r in stages[4].collect())
    assert Counter((r["doc_id"], r["source"], tuple(r["token_ids"])) for r in stages[5].collect()) == want


def test_run_gives_the_last_stage(spark, stages):
    key = lambda df: sorted((r["doc_id"], r["ids_sha256"]) for r in df.collect())
    assert key(corpus_pipeline.run(spark, SF)) == key(stages[-1])


def test_empty_table(spark, stages):
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        assert stage(spark, stages[i].limit(0), SF).count() == 0


def test_joins_take_five_words_and_four_fifths():
    assert (lines.K, lines.LIKE) == (5, 80) and (jaccard.K, jaccard.LIKE) == (4, 85)
