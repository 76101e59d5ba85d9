import random

import numpy as np

from factloom.llm import toxicity

BAD = ["idiot", "scumbag", "worthless", "moronic", "pathetic"]


def corpus(seed, n):
    rng = random.Random(seed)
    words = ["".join(rng.choice("aeioutnrsl") for _ in range(rng.randint(2, 8))) for _ in range(400)]
    texts, labels = [], []
    for i in range(n):
        text = [rng.choice(words) for _ in range(rng.choice([8, 40, 200, 900]))]
        labels.append(int(i % 5 == 0))
        if labels[-1]:
            for _ in range(rng.randint(2, 4)):
                text.insert(rng.randrange(len(text)), rng.choice(BAD))
        texts.append(" ".join(text))
    return texts, labels


def scored(model, texts):
    raw = [(t or "").encode() for t in texts]
    return toxicity.scores(model, np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum([len(r) for r in raw])]))


def test_held_out_accuracy_and_misspellings():
    model = toxicity.train(*corpus(1, 500))
    texts, labels = corpus(2, 300)
    said = scored(model, texts) >= toxicity.THRESHOLD
    right = np.array(labels) == 1
    assert (said & right).sum() >= 0.9 * right.sum() and (said & ~right).sum() <= 0.05 * (~right).sum()
    plain, bad = "tane rino sel utane orin sel " * 4, "tane rino sel utane scumbagg orin sel worthlesss rino " * 2
    assert scored(model, [bad])[0] > scored(model, [plain])[0]


def test_training_is_repeatable():
    a, b = (toxicity.train(*corpus(1, 120)) for _ in range(2))
    assert np.array_equal(a.weight, b.weight) and a.scale == b.scale


def test_edges(spark):
    assert toxicity.train([], []) is None and toxicity.train(["a"], [1]) is None
    texts, labels = corpus(3, 200)
    docs = spark.createDataFrame([(i, t, 0.5) for i, t in enumerate(texts)] + [(900, None, 0.1), (901, "", 0.1), (901, "", 0.1), (None, "x", 0.1), (902, "idiot " * 20000, 0.2)], "doc_id bigint, text string, score double")
    marks = spark.createDataFrame([(i, y) for i, y in enumerate(labels)] + [(None, 1), (3, None), (3, 0), (5000, 1)], "doc_id bigint, toxic int")
    model = toxicity.fit(docs, marks)
    got = toxicity.score(docs, model).collect()
    assert len(got) == 205 and all(0 <= r["score"] <= 1 for r in got)
    assert [r["score"] < 0.5 for r in got if r["doc_id"] in (900, 901)] == [True] * 3
    assert toxicity.clean(docs, model).columns == docs.columns
    assert toxicity.score(docs.limit(0), model).count() == 0
    assert {r["score"] for r in toxicity.score(docs, toxicity.fit(docs, marks.limit(0))).collect()} == {0.0}


def test_scores_do_not_depend_on_neighbours():
    model = toxicity.train(*corpus(1, 120))
    texts, _ = corpus(4, 40)
    assert np.allclose(scored(model, texts), [scored(model, [t])[0] for t in texts])


def test_a_long_text_does_not_end_the_sample(spark):
    docs = spark.range(40).selectExpr("id as doc_id", "repeat(concat('word', id, ' '), if(id % 4 = 0, 5000, 3)) as text")
    marks = spark.range(40).selectExpr("id as doc_id", "cast(id % 2 as int) as toxic")
    texts, labels = toxicity.sample(docs, marks, 100, 20_000, "true")
    assert len(texts) == 40 and sum(labels) == 20 and max(map(len, texts)) == 200
