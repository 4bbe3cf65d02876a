import random

import numpy as np
import pytest
from corpus_fixtures import edge_docs, no_docs  # noqa: F401  (fixtures)
from regpanel.llm import op1_toxicity, op6_quality, queries

CASES = [(op1_toxicity.score_toxicity, op1_toxicity.Toxicity, op1_toxicity.drop_toxic), (op6_quality.score_quality, op6_quality.Quality, op6_quality.keep_good)]


def corpus(seed, n):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abdefgilmnorstu") for _ in range(rng.randint(2, 8))) for _ in range(3000)]
    return rng, [[rng.choice(words) for _ in range(rng.randint(30, 150))] for _ in range(n)]


def test_toxicity_learns_planted_words_and_leaves_clean_text_alone():
    rng, docs = corpus(1, 600)
    sample = []
    for i, d in enumerate(docs):
        if i % 4 == 0:
            for _ in range(rng.randint(1, 4)):
                d[rng.randrange(len(d))] = rng.choice(["qwyzzard", "qwyzzling", "kreemble,", "Vorpax"])
        sample.append((" ".join(d), int(i % 4 == 0)))
    model = op1_toxicity.fit(sorted(sample[:400]))
    s = model.scores([t for t, _ in sample[400:]], op1_toxicity.WordCodes())
    y = np.array([y for _, y in sample[400:]])
    assert ((s >= 0.5) == (y == 1)).mean() > 0.97
    # A stem that stands for a family of words tells unseen members too.
    assert model.scores(["plain words and a qwyzzotic one among them"], op1_toxicity.WordCodes())[0] >= 0.5


def test_toxicity_reads_the_whole_text():
    rng, docs = corpus(2, 400)
    sample = [(" ".join(d + ["blatherskite"] * (i % 2)), i % 2) for i, d in enumerate(docs)]
    model = op1_toxicity.fit(sorted(sample))
    far = " ".join(w for d in docs[:400:2] for w in d) * 10
    assert model.scores([far, far + " blatherskite"], op1_toxicity.WordCodes()).round().tolist() == [0.0, 1.0]


def test_quality_tells_repetition_and_symbols():
    rng, docs = corpus(3, 600)
    sample = []
    for i, d in enumerate(docs):
        if i % 3 == 0:
            d = [w for w in d[:10] for _ in range(12)] if i % 2 else [w + rng.choice(["$$$", "###", "%%%"]) for w in d]
        sample.append((" ".join(d), int(i % 3 != 0)))
    model = op6_quality.fit(sorted(sample[:400]))
    s = model.scores([t for t, _ in sample[400:]], op6_quality.RowCache())
    assert ((s >= 0.5) == np.array([y == 1 for _, y in sample[400:]])).mean() > 0.97


def test_temperature_and_chunks():
    cache = op6_quality.RowCache()
    vectors = op6_quality.index_vectors()
    text = " ".join(f"w{i % 977}" for i in range(op6_quality.CHUNK_TOKENS + 500))
    whole = op6_quality.pooled(text, vectors, cache)
    rows = op6_quality.token_rows(text, cache)
    assert np.allclose(whole[:op6_quality.DIM], vectors[rows].mean(axis=0), atol=1e-4)
    agree = (vectors[rows[1:]] * vectors[rows[:-1]]).sum() / len(rows)
    assert abs(whole[op6_quality.DIM] - agree) < 1e-3


@pytest.mark.parametrize("score, model, keep", CASES)
def test_edge_rows(edge_docs, no_docs, score, model, keep):
    unfitted = model()
    out = score(edge_docs, unfitted).collect()
    assert len(out) == edge_docs.count() and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in out)
    assert score(no_docs, unfitted).collect() == []
    assert keep(edge_docs, unfitted).columns == edge_docs.columns and keep(edge_docs, unfitted).count() == edge_docs.count()
    assert [r.held_out for r in out if r.doc_id is None] == [False]


def test_empty_text_is_scored_with_a_fitted_model(edge_docs):
    rng, docs = corpus(4, 80)
    m1 = op1_toxicity.fit([(" ".join(d + ["zounderkite"] * (i % 2)), i % 2) for i, d in enumerate(docs)])
    m6 = op6_quality.fit([(" ".join([d[0]] * 50 if i % 2 else d), 1 - i % 2) for i, d in enumerate(docs)], epochs=5)
    for score, m in ((op1_toxicity.score_toxicity, m1), (op6_quality.score_quality, m6)):
        got = score(edge_docs, m).collect()
        assert len(got) == edge_docs.count() and len({r.score for r in got if r.doc_id in (2, 3)}) == 1


@pytest.mark.parametrize("name, label, folds, fold", [("op1_toxicity", "toxic", 5, 0), ("op6_quality", "quality", 3, 1)])
def test_held_out_accuracy(spark, name, label, folds, fold):
    import zlib
    sf_dir = "/root/testdata/sf0.01"
    got = queries.QUERIES[name](spark, sf_dir).toPandas()
    assert (got.held_out == [zlib.crc32(str(i).encode()) % folds == fold for i in got.doc_id]).all()
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").toPandas()
    both = got[got.held_out].merge(labels, on="doc_id")
    assert len(both) > 50 and (both.predicted == both[label]).mean() > 0.95


def test_a_long_text_may_have_what_chance_gives():
    assert [op1_toxicity.needed(0.002, n) for n in (0, 1, 9, 40, 400)] == [1, 1, 1, 2, 4]
    assert op1_toxicity.needed(0.0, 1e9) == 1 and 1060 < op1_toxicity.needed(0.001, 1e6) < 1080
    for mean in (0.3, 7.0, 80.0):
        draws = np.random.default_rng(1).poisson(mean, 200_000)
        assert (draws >= op1_toxicity.needed(mean, 1)).mean() <= 0.022


def test_clean_texts_of_any_length_are_left_alone():
    # One ordinary text in twenty holds a telling word: a long text that is made of them is no toxic one.
    rng, docs = corpus(6, 1600)
    sample = []
    for i, d in enumerate(docs):
        for _ in range(3 if i % 4 == 0 else int(i % 20 == 1)):
            d[rng.randrange(len(d))] = rng.choice(["qwyzzard", "kreemble", "vorpax", "mimblewick"])
        sample.append((" ".join(d), int(i % 4 == 0)))
    model = op1_toxicity.fit(sorted(sample[:1000]))
    assert model.rate > 0
    clean, toxic = ([t for t, y in sample[1000:] if y == k] for k in (0, 1))
    codes = op1_toxicity.WordCodes()
    joined = [" ".join(rng.sample(clean, 50)) for _ in range(40)]
    assert (model.scores(joined, codes) >= 0.5).mean() <= 0.05
    assert (model.scores([" ".join(rng.sample(toxic, 20)) for _ in range(20)], codes) >= 0.5).all()


def test_a_sample_is_bounded_before_it_is_collected(spark):
    from regpanel.llm.common import labelled_sample
    docs = spark.createDataFrame([(7 if i % 3 == 0 else i, f"text {i} " + "x" * 100, "clash") for i in range(900)], "doc_id long, text string, _y string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(900)] + [(7, 1), (7, None), (None, 1)], "doc_id long, toxic int")
    take = lambda **more: labelled_sample(docs, labels, "toxic", folds=5, held_fold=0, **more)
    every = take(per_class=5000)
    # A third of the rows share one key, which is one text.
    assert sum(int(t.split()[1]) % 3 == 0 for t, _ in every) <= 1
    some = take(per_class=20)
    assert len(some) <= 40 and set(some) <= set(every) and some == labelled_sample(docs.repartition(7), labels.repartition(3), "toxic", folds=5, held_fold=0, per_class=20)
    assert sum(len(t) for t, y in take(per_class=5000, most_bytes=1500) if y) <= 1500
    assert len(take(per_class=5000, most_bytes=10)) == 2


def test_pooling_against_a_loop_over_tokens():
    rng, docs = corpus(8, 3)
    vectors, cache = op6_quality.index_vectors(), op6_quality.RowCache()
    for d in [*docs, ["one"], []]:
        v = [vectors[r] for r in op6_quality.token_rows(" ".join(d), cache)]
        n, dim = max(len(v), 1), op6_quality.DIM
        mean = [sum(float(x[i]) for x in v) / n for i in range(dim)]
        agree = [sum(sum(float(a) * float(b) for a, b in zip(x, y)) for x, y in zip(v, v[lag:])) / n for lag in op6_quality.LAGS]
        spread = [(sum((float(x[i]) - m) ** 2 for x in v) / n) ** 0.5 for i, m in enumerate(mean)]
        assert np.allclose(op6_quality.pooled(" ".join(d), vectors, cache), mean + agree + spread, atol=1e-6)
