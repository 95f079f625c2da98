import random
import re
from collections import Counter

import pytest

import corpus_pipeline
from thermocal.llm import ngram_join, toxicity
from thermocal.llm.mixing import mix

from .conftest import WORDS
from .test_decontaminate import brute as contaminated
from .test_ngram_join import brute as groups


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    rng = random.Random(5)
    prose = lambda n: " ".join(rng.choice(WORDS) for _ in range(n))
    items = [(i, prose(25)) for i in range(5)]
    rows, labels = [], []
    for i in range(400):
        toxic = i % 5 == 0
        text = prose(rng.randrange(10, 80)) + (" grumxing grumxed vilepo" if toxic else "")
        rows.append((i, text, "en", f"s{i % 4}", len(text)))
        labels.append((i, 1, int(toxic)))
    for i in range(60):  # exact and near copies, and benchmark passages
        base = rows[7 * i + 1][1] if i < 50 else prose(20) + " " + items[i % 5][1] + " " + prose(10)
        text = base if i % 2 else base.replace(" ", "  ", 1) if i < 50 else base
        rows.append((1000 + i, text, "en", None if i % 9 == 0 else "s1", len(text)))
    rows += [(2000, None, None, None, None), (2001, "", "en", "s1", 0), (None, prose(30), "en", "s2", 1), rows[3], rows[3]]
    path = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{path}/benchmark.parquet")
    return path, rows, items, dict((i, t) for i, _, t in labels)


def test_stages_against_brute_force(spark, tables):
    path, rows, items, labels = tables
    docs = spark.read.parquet(f"{path}/documents.parquet")
    (_, tox), (_, near), (_, clean), (_, mixed), (_, sharded) = corpus_pipeline.STAGES
    key = lambda r: (r["doc_id"], r["text"])

    kept = tox(spark, docs, path)
    assert kept.columns == docs.columns
    one = kept.collect()
    bad = re.compile("grumx|vilep")
    assert Counter(map(key, one)) == Counter((r[0], r[1]) for r in rows if not bad.search(r[1] or ""))

    kept = near(spark, kept, path)
    assert kept.columns == docs.columns
    two = kept.collect()
    plain = sorted(((r["doc_id"], r["text"]) for r in one), key=lambda r: (r[0] is None, r[0] or 0))
    _, roots = groups(plain, 5, 4, 5)
    want = Counter({plain[k]: 1 for k in set(roots)})
    assert Counter(map(key, two)) == want

    kept = clean(spark, kept, path)
    three = kept.collect()
    assert Counter(map(key, three)) == Counter(map(key, (r for r in two if contaminated(r["text"], items)[1] == 0)))
    assert len(three) < len(two)

    kept = mixed(spark, kept, path)
    four = kept.collect()
    copies = {r["id"]: r["copies"] for r in mix(spark.createDataFrame(three, docs.schema)).collect()}
    assert Counter(r["doc_id"] for r in four) == Counter({k: v for k, v in copies.items() if v})

    five = sharded(spark, spark.createDataFrame(four, docs.schema), path).collect()
    assert Counter(map(key, five)) == Counter(map(key, four))
    assert {r["shard"] for r in five} <= set(range(40))


def test_run_is_the_stages_in_turn(spark, tables):
    path, *_ = tables
    got = corpus_pipeline.run(spark, path)
    assert got.columns == ["doc_id", "text", "lang", "source", "n_chars", "shard", "slot"]
    first = sorted(((r["doc_id"], r["shard"], r["slot"]) for r in got.collect()), key=str)
    assert first == sorted(((r["doc_id"], r["shard"], r["slot"]) for r in corpus_pipeline.run(spark, path).collect()), key=str)
    assert corpus_pipeline.ORACLE_SQL is None and ngram_join and toxicity


def test_empty_documents(spark, tables, tmp_path):
    path, *_ = tables
    empty = spark.read.parquet(f"{path}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, path).collect() == [], name


@pytest.mark.parametrize("labels", [[], [(1, 1, None), (2, 1, 7)], [(i, 1, 1) for i in range(40)]])
def test_labels_that_teach_nothing_drop_no_document(spark, tables, tmp_path, labels):
    path, rows, *_ = tables
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.read.parquet(f"{path}/documents.parquet")
    kept = corpus_pipeline.drop_toxic(spark, docs, str(tmp_path))
    assert kept.columns == docs.columns and kept.count() == len(rows)


def test_one_document_of_each_group_whatever_its_ids(spark, make_docs, prose):
    a, b, c = prose(40), prose(40), prose(40)
    rows = [(None, a), (None, a + " end"), (None, a.replace(" ", "  ", 1)), (None, a), (None, b),   # two groups without an id
            (7, c), (7, c + " end"), (8, c), (9, ""), (None, None), (None, "")]
    kept = corpus_pipeline.one_of_each_group(spark, make_docs(rows, ["g", "h", "root"]).repartition(3), "")
    assert kept.columns == [*make_docs(rows).columns, "g", "h", "root"]
    got = Counter((r["doc_id"], r["text"]) for r in kept.collect())
    group = lambda t: next((k for k, x in enumerate((a, b, c)) if t and t.split()[:9] == x.split()[:9]), t)
    assert Counter((i, group(t)) for i, t in got) == Counter([(None, 0), (None, 1), (7, 2), (9, ""), (None, None), (None, "")])
    assert set(got.values()) == {1} and got == Counter(
        (r["doc_id"], r["text"]) for r in corpus_pipeline.one_of_each_group(spark, make_docs(rows[::-1]), "").collect())
