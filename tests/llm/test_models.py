"""Language, quality and toxicity: held-out accuracy on the tables, and awkward rows."""

from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from candlehouse.llm import language, quality, toxicity
from candlehouse.llm.common import held_out
from candlehouse.llm.queries import QUERIES
from llm.frames import DOCS, awkward, with_clashes

MIDDLE = "/root/testdata/sf0.1"


def joined(spark, name):
    labels = spark.read.parquet(f"{MIDDLE}/labels.parquet").drop_duplicates(["doc_id"])
    docs = spark.read.parquet(f"{MIDDLE}/documents.parquet").select("doc_id", "lang")
    return QUERIES[name](spark, MIDDLE).join(docs, "doc_id").join(labels, "doc_id", "left").toPandas()


def test_language_on_held_out_documents(spark):
    d = joined(spark, "op6_language_mixture")
    apart = d[d.held_out]
    assert len(d) == 10_000 and 2000 < len(apart) < 3000
    assert (apart.lang_pred == apart.lang).mean() > 0.995
    assert d.score.between(0, 1).all()


@pytest.mark.parametrize("name,label,hits,alarms", [("op2_pu_quality", "quality", 0.99, 0.05), ("op8_toxicity_fm", "toxic", 0.92, 0.005)])
def test_classifiers_on_held_out_documents(spark, name, label, hits, alarms):
    d = joined(spark, name)
    apart = d[d.held_out & d[label].notna()]
    assert apart.predicted[apart[label] == 1].mean() > hits
    assert apart.predicted[apart[label] == 0].mean() < alarms
    assert d.score.between(0, 1).all()


def test_models_never_read_held_out_labels_nor_other_columns(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    apart = held_out(F.col("doc_id"), 5, 0)
    for column, module in (("quality", quality), ("toxic", toxicity)):
        turned = labels.withColumn(column, F.when(apart, 1 - F.col(column)).otherwise(F.col(column)))
        blank = docs.withColumns({"lang": F.lit("x"), "source": F.lit("y"), "n_chars": F.lit(0)})
        a, b = (module.score(x, module.fit(x, y, ~apart), ["doc_id"]).orderBy("doc_id").toPandas().score
                for x, y in ((docs, labels), (blank, turned)))
        assert np.array_equal(a, b)
    apart = held_out(F.col("doc_id"), 4, 2)
    other = docs.withColumn("lang", F.when(apart, F.lit("xx")).otherwise(F.col("lang"))).withColumn("source", F.lit("y"))
    a, b = (language.identify(x, language.fit(x, ~apart), ["doc_id"]).orderBy("doc_id").toPandas() for x in (docs, other))
    assert a.lang_pred.equals(b.lang_pred) and np.allclose(a.score, b.score)


def test_mixture_of_two_languages(spark):
    docs = spark.read.parquet(f"{MIDDLE}/documents.parquet")
    model = language.fit(docs, F.lit(True))
    en, de = (next(r.text for r in docs.where(f"lang = '{x}' and n_chars between 2000 and 3000").orderBy("doc_id").limit(5).collect()) for x in ("en", "de"))
    both = spark.createDataFrame([(1, en[:1500] + " " + de[:1500]), (2, en)], "doc_id bigint, text string")
    one, two = language.identify(both, model).orderBy("doc_id").collect()
    assert set(one.mixture) == {"en", "de"} and 0.3 < one.mixture["en"] < 0.7
    assert two.mixture == {"en": 1.0} and two.score == 1.0


def brute_em(counts, p, steps):
    pi = np.full(len(p), 1 / len(p))
    for _ in range(steps):
        share = pi[:, None] * p
        share = share / share.sum(axis=0)
        pi = (share * counts).sum(axis=1) / counts.sum()
    return pi


def test_proportions_against_plain_em():
    rng = np.random.default_rng(1)
    table = {n: rng.integers(0, 50, 64).astype(float) for n in "abc"}
    model = language.Model.from_counts(table, 64)
    counts = rng.integers(0, 5, (7, 64)).astype(np.float32)
    got, _ = model.proportions(counts, np.ones((7, 3), dtype=np.float32))
    for row, c in zip(got, counts, strict=True):
        assert np.allclose(row, brute_em(c, model.p, language.STEPS), atol=1e-4)


def test_language_set_against_all_sets():
    """The chosen set against the best of all subsets by likelihood less penalty, for one, two and three planted languages."""
    rng = np.random.default_rng(7)
    table = {n: rng.gamma(0.3, 40, 96) for n in "abcde"}
    model = language.Model.from_counts(table, 96)
    planted = [s for size in (1, 2, 3) for s in combinations(range(5), size)]
    counts = np.array([rng.multinomial(900, np.mean(model.p[list(s)], axis=0)) for s in planted], dtype=np.float32)
    chosen = model.infer(counts)
    for s, c, pi in zip(planted, counts, chosen, strict=True):
        cost = language.PENALTY * np.log2(2 + c.sum())

        def net(some, c=c, cost=cost):
            own = brute_em(c, model.p[list(some)], language.STEPS)
            return (c * np.log(own @ model.p[list(some)])).sum() - (len(some) - 1) * cost

        best = max((some for size in range(1, language.MOST + 1) for some in combinations(range(5), size)), key=net)
        assert tuple(np.flatnonzero(pi > 0)) == best == s
        assert np.allclose(pi[list(best)], brute_em(c, model.p[list(best)], language.STEPS), atol=1e-3)


def test_machine_equals_the_written_out_sum():
    rng = np.random.default_rng(2)
    m = toxicity.Machine(np.arange(6, dtype=np.uint64), 0.3, rng.normal(size=6), rng.normal(size=(6, 4)))
    x = np.array([0.5, 0, 1.2, 0, 2.0, 0.7])
    used = np.flatnonzero(x)
    plain = 0.3 + m.w @ x + sum(m.v[i] @ m.v[j] * x[i] * x[j] for i in range(6) for j in range(i + 1, 6))
    assert np.isclose(m.logits(np.zeros(len(used), int), used, x[used], 1)[0], plain)


def test_machine_learns_what_matters_only_together():
    rng = np.random.default_rng(3)
    texts, labels = [], []
    for _ in range(1500):
        a, b = (rng.random(2) < 0.5).tolist()
        texts.append(" ".join([f"f{k}" for k in rng.integers(0, 30, 20)] + ["insult"] * a + ["group"] * b))
        labels.append(int(a and b))
    m = toxicity.learn(texts, labels)
    got = m.score(["insult group f1 f2 f3 f4 f5 f6 f7 f8 f9 f10 f11 f12 f13 f14 f15 f16 f17 f18", "insult f1 f2 f3 f4 f5 f6 f7 f8 f9 f10 f11 f12 f13 f14 f15 f16 f17 f18 f19",
                   "group f1 f2 f3 f4 f5 f6 f7 f8 f9 f10 f11 f12 f13 f14 f15 f16 f17 f18 f19"])
    assert got[0] > 0.5 > max(got[1], got[2])


def test_machine_learns_pairs_of_equal_marginals_and_rare_terms():
    rng = np.random.default_rng(5)
    filler = lambda: [f"f{k}" for k in rng.integers(0, 30, 18)]
    texts, labels = [], []
    for i in range(1600):  # both words are in half of each class; toxic is who has both or none
        toxic, a = i % 2, (i // 2) % 2
        texts.append(" ".join(filler() + ["left"] * a + ["right"] * (a if toxic else 1 - a)))
        labels.append(toxic)
    both, left, right = toxicity.learn(texts, labels).score([" ".join([*filler(), *extra]) for extra in (["left", "right"], ["left"], ["right"])])
    assert both > 0.5 > max(left, right)
    texts, labels = [" ".join(filler()) for _ in range(2000)], [0] * 2000
    for i in range(300):  # most toxic documents have a common insult, 12 a rare one
        texts.append(" ".join([*filler(), "insult" if i >= 12 else "slur"]))
        labels.append(1)
    rare, none = toxicity.learn(texts, labels).score([" ".join([*filler(), "slur"]), " ".join(filler())])
    assert rare > 0.5 > none


def test_a_cap_does_not_move_the_decision(spark):
    rng = np.random.default_rng(6)
    docs, labels = [], []
    for i in range(3000):  # of documents with the mild word every fourth is toxic, of the rest every twentieth
        mild = i % 3 == 0
        docs.append((i, " ".join([f"f{k}" for k in rng.integers(0, 30, 18)] + ["mild"] * mild)))
        labels.append((i, int(rng.random() < (0.25 if mild else 0.05))))
    docs, labels = spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(labels, "doc_id bigint, toxic int")
    texts = [" ".join([f"f{k}" for k in rng.integers(0, 30, 18)] + ["mild"] * (i % 2)) for i in range(400)]
    whole, capped = (toxicity.fit(docs, labels, F.lit(True), per_class).score(texts) for per_class in (3000, 250))
    assert (whole >= 0.5).mean() < 0.05 and (capped >= 0.5).mean() < 0.05
    assert abs(whole.mean() - capped.mean()) < 0.05


def test_class_prior():
    rng = np.random.default_rng(4)
    p = rng.normal(2, 1, (3000, 3))
    for share in (0.3, 0.8):
        n = int(3000 * share)
        u = np.concatenate([rng.normal(2, 1, (n, 3)), rng.normal(-2, 1, (3000 - n, 3))])
        assert abs(quality.class_prior(p, rng.permutation(u)) - share) < 0.06


def test_awkward_documents(spark):
    docs = with_clashes(spark.createDataFrame(awkward(), DOCS))
    labels = spark.createDataFrame([(i, i % 2, i % 2) for i in range(12)] + [(None, 1, 1), (3, None, None), (4, 1, 1), (4, 1, 1), (999, 0, 1)],
                                   "doc_id bigint, quality int, toxic int")
    model = language.fit(docs, F.lit(True))
    found = language.identify(docs, model)
    assert set(found.columns) == {*docs.columns, "lang_pred", "score", "mixture"}
    by_id = {r.doc_id: r for r in found.where("doc_id is not null").collect()}
    assert found.count() == docs.count()
    for i in (100, 101, 102, 105):
        assert (by_id[i].lang_pred, by_id[i].score, by_id[i].mixture) == ("und", 0.0, {})
    assert by_id[110].lang_pred == "fr" and by_id[106].lang_pred == "en" and by_id[106].value == "mine:value"
    for module, column in ((quality, "quality"), (toxicity, "toxic")):
        scored = module.score(docs, module.fit(docs, labels, F.lit(True)))
        assert scored.columns == [c for c in docs.columns if c != "score"] + ["score"]
        rows = scored.collect()
        assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
        empty = {r.score for r in rows if not r.text}
        assert len(empty) == 1


def test_no_documents_and_no_labels(spark):
    docs = spark.createDataFrame(awkward(), DOCS)
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert language.identify(docs.limit(0), language.fit(docs.limit(0), F.lit(True))).collect() == []
    assert {r.lang_pred for r in language.identify(docs, language.fit(docs.limit(0), F.lit(True))).collect()} == {"und"}
    for module in (quality, toxicity):
        model = module.fit(docs, labels, F.lit(True))
        assert len({r.score for r in module.score(docs, model, ["doc_id"]).collect()}) == 1
        assert module.score(docs.limit(0), model).collect() == []


@pytest.mark.parametrize("prior,shift", [(0.3, 0.0), (0.9, -3.0), (None, 0.0)])
def test_slopes_are_those_of_the_non_negative_risk(prior, shift):
    """Against the risk written out, differentiated by small steps; the second case has a negative estimate."""
    rng = np.random.default_rng(2)
    fp, fu = rng.normal(1, 2, 7), rng.normal(shift, 0.5, 9)

    def loss(z):
        return np.log1p(np.exp(-z))

    def goal(fp, fu):
        if prior is None:
            return loss(fp).mean() + loss(-fu).mean()
        negative = loss(-fu).mean() - prior * loss(-fp).mean()
        return prior * loss(fp).mean() + negative if negative >= 0 else -negative

    if prior:
        assert quality.negative_risk(fp, fu, prior) == pytest.approx(loss(-fu).mean() - prior * loss(-fp).mean())
        assert (quality.negative_risk(fp, fu, prior) < 0) == (prior == 0.9)
    z, h = np.concatenate([fp, fu]), 1e-6
    plain = [(goal(*np.split(z + h * e, [7])) - goal(*np.split(z - h * e, [7]))) / (2 * h) for e in np.eye(16)]
    assert quality.slopes(fp, fu, prior) == pytest.approx(plain, abs=1e-6)


def test_sample_of_the_toxicity_machine_is_bounded_in_terms(spark):
    """Long texts count by their terms: fewer documents are learned from, and they stand for the rest of their class."""
    rng = np.random.default_rng(3)
    texts = [" ".join(f"w{x}" for x in rng.integers(0, 3000, 400)) + (" slur" if i % 4 == 0 else "") for i in range(80)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(90)], "doc_id bigint, toxic int")
    seen = []
    keep = toxicity.learn_terms
    try:
        toxicity.learn_terms = lambda sample, y, stands: seen.append((sum(len(t) for t, _ in sample), list(y), stands)) or keep(sample, y, stands)
        toxicity.fit(docs, labels, F.lit(True), class_terms=9000)
    finally:
        toxicity.learn_terms = keep
    (terms, y, stands), = seen
    assert terms <= 2 * 9000 and 2 <= len(y) < 80
    assert stands == (60 / y.count(0), 20 / y.count(1))  # labels without a document count for nothing
