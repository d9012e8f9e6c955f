"""Registration, SQL counterparts, and the pipeline."""

import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from candlehouse.llm.oracle import ORACLE
from candlehouse.llm.queries import QUERIES
from compare import connect, difference
from llm.frames import DOCS, awkward, sentence, with_clashes

FOLDER = "/root/testdata/sf0.01"


def test_one_query_for_each_operator_and_the_pipeline():
    assert sorted(int(q[2:].split("_")[0]) for q in QUERIES) == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, name):
    assert difference(QUERIES[name](spark, FOLDER), connect(FOLDER), ORACLE[name]) is None


def test_stages_on_awkward_documents(spark, tmp_path):
    import random

    rng = random.Random(9)
    items = [(1, sentence(rng, 40, 3000))]
    rows = awkward() + [(700, items[0][1] + " " + sentence(rng, 30), None, None, None)]
    docs = with_clashes(spark.createDataFrame(rows, DOCS))
    labels = spark.createDataFrame([(i, 1, 0) for i in range(12)], "doc_id bigint, quality int, toxic int")
    for name, df in (("documents", docs), ("labels", labels), ("benchmark", spark.createDataFrame(items, "item_id bigint, text string"))):
        df.write.parquet(f"{tmp_path}/{name}.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == [n for n, _ in corpus_pipeline.STAGES] and 4 <= len(stages) <= 5
    ids = lambda df: sorted((r.doc_id if r.doc_id is not None else -1) for r in df.select("doc_id").collect())
    everything = ids(docs)
    kept = stages["language_id"](spark, docs, str(tmp_path))
    assert kept.columns == docs.columns and set(everything) - set(ids(kept)) == {100, 101, 102, 105}
    assert {r.score for r in kept.collect()} == {"mine:score"}
    calm = stages["toxicity"](spark, docs, str(tmp_path))
    assert calm.columns == docs.columns and ids(calm) == everything
    once = stages["minhash_near_dedup"](spark, docs, str(tmp_path))
    assert once.columns == docs.columns
    assert ids(once) == sorted([-1, -1, *(set(everything) - {108, 109, -1})])
    clean = stages["benchmark_decontamination"](spark, docs, str(tmp_path))
    assert clean.columns == docs.columns and set(everything) - set(ids(clean)) == {700}
    packed = stages["best_fit_packing"](spark, docs, str(tmp_path))
    assert packed.where("piece = 0").count() == len(rows)
    for stage in stages.values():
        assert stage(spark, docs.limit(0), str(tmp_path)).collect() == []


def test_pipeline_against_plain_python(spark):
    """Each stage over the table: what it drops is what a plain reading of its rule drops."""
    from candlehouse.llm import language, toxicity  # noqa: F401
    from llm.test_decontamination import brute as leaks
    from llm.test_neardup import brute as near

    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    by_id = dict(rows)
    stages = dict(corpus_pipeline.STAGES)
    ids = lambda df: {r.doc_id for r in df.select("doc_id").collect()}
    assert ids(stages["language_id"](spark, docs, FOLDER)) == {i for i, t in rows if t and any(map(str.isalpha, t))}
    toxic = dict(duckdb.sql(f"select doc_id, toxic from '{FOLDER}/labels.parquet'").fetchall())
    calm = ids(stages["toxicity"](spark, docs, FOLDER))
    known = [i for i in by_id if i in toxic]
    assert sum(i in calm for i in known if toxic[i] == 0) >= 0.99 * sum(toxic[i] == 0 for i in known)
    assert sum(i not in calm for i in known if toxic[i] == 1) >= 0.5 * sum(toxic[i] == 1 for i in known)  # few examples to learn from here
    folder = "/root/testdata/sf0.001"  # the plain ways below take time with the square of the rows
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    assert ids(stages["minhash_near_dedup"](spark, docs, folder)) == {i for _, i, _, c in near(rows, 5, 80) if i == c}
    items = duckdb.sql(f"select item_id, text from '{folder}/benchmark.parquet'").fetchall()
    part = rows[::20] + [r for r in rows if any(t in r[1] for _, t in items)]
    clean = ids(stages["benchmark_decontamination"](spark, docs, folder))
    leaking = {i for i, _ in leaks(part, items)}
    assert {i for i, _ in part} - clean == leaking and leaking


def test_whole_pipeline(spark):
    found = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert found.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    assert found.count() > 0


def test_no_text_is_lost_where_an_id_repeats(spark):
    import random

    rng = random.Random(4)
    a, b, c, d = (sentence(rng, 60) for _ in range(4))
    stage = dict(corpus_pipeline.STAGES)["minhash_near_dedup"]

    def kept(rows):
        return sorted((r.doc_id, r.text) for r in stage(spark, spark.createDataFrame([(*r, "en", "s", 1) for r in rows], DOCS), "").collect())

    assert kept([(3, a), (5, a), (5, b), (7, c)]) == sorted([(3, a), (5, b), (7, c)])
    assert kept([(3, a), (3, b), (3, b), (4, d)]) == sorted([(3, a), (3, b), (4, d)])
    assert [i for i, _ in kept([(3, a), (3, a + " and more"), (9, b), (9, "")])] == [3, 9, 9]


def test_a_leak_in_a_row_without_an_id_goes(spark, tmp_path):
    import random

    rng = random.Random(6)
    item = sentence(rng, 40, 3000)
    spark.createDataFrame([(1, item)], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    rows = [(None, f"see {item} there"), (None, sentence(rng, 50)), (None, None), (1, sentence(rng, 50)), (2, item)]
    docs = spark.createDataFrame([(*r, "en", "s", 1) for r in rows], DOCS)
    clean = dict(corpus_pipeline.STAGES)["benchmark_decontamination"](spark, docs, str(tmp_path))
    assert clean.columns == docs.columns and sorted(str(r.text) for r in clean.collect()) == sorted(str(rows[i][1]) for i in (1, 2, 3))
