import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import __spark_entry__ as E
from thermocal.llm.byte_bpe import ByteBPE, RankQueue, Vocabulary, encode_documents, engine_classes, read_ranks

from .conftest import edge_rows

P = pytest.importorskip("public_tokenizers")
tiktoken = pytest.importorskip("tiktoken")
PATH = P.path("byte_bpe_multi_50k.tiktoken")
ALL = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=read_ranks(PATH), special_tokens={})


@pytest.fixture(scope="module")
def vocabulary():
    ranks = read_ranks(PATH)
    return Vocabulary(ranks, P.PATTERN, *engine_classes(ranks), memory=50)


def ids(vocabulary, text):
    got, starts = vocabulary.encode(["filler text", text, None])
    assert len(starts) == 4 and starts[0] == 0 and starts[2] == starts[3] == len(got)
    return got[starts[1]:].tolist()


def back(vocabulary, ids):
    data, ends = vocabulary.decode(np.array(ids, np.int32), np.array([0, 0, len(ids)]))
    assert ends.tolist() == [0, 0, len(data)]
    return data.tobytes()


@settings(max_examples=200, deadline=None)
@given(text=st.text(max_size=80) | st.text(alphabet="ab 's\n\t1é漢", max_size=200))
def test_ids_are_the_librarys(vocabulary, library, text):
    got = ids(vocabulary, text)
    assert got == library.encode_ordinary(text)
    assert back(vocabulary, got) == text.encode()


@settings(max_examples=100, deadline=None)
@given(pieces=st.lists(st.binary(min_size=1, max_size=40) | st.text(alphabet="aab ", min_size=1, max_size=60).map(str.encode), min_size=1, max_size=30))
def test_one_queue_for_many_pre_tokens(vocabulary, library, pieces):
    flat, starts = vocabulary.merge_all(pieces)
    for p, a, b in zip(pieces, starts, starts[1:]):
        assert flat[a:b].tolist() == vocabulary.merge(p) == library._core_bpe.encode_single_piece(p)


def test_every_character_is_cut_alike(vocabulary, library):
    assert ids(vocabulary, ALL) == library.encode_ordinary(ALL)
    mixed = "".join(random.Random(2).choice(ALL) + " a"[k % 2] for k in range(20_000))
    assert ids(vocabulary, mixed) == library.encode_ordinary(mixed)


@pytest.mark.parametrize("text", ["a" * 70_000, " " * 30_000 + "x", "\n" * 9_999, "ab" * 20_000,
                                  "".join(random.Random(3).choice("aab") for _ in range(40_000)),
                                  "".join(random.Random(4).choice("ACGT") for _ in range(1_200_000))])
def test_very_long_pre_tokens(vocabulary, library, text):
    assert ids(vocabulary, text) == library.encode_ordinary(text)


def test_text_longer_than_a_run(vocabulary, library):
    text = " ".join(random.Random(5).choice(["one", "Two,", "drei3"]) for _ in range(300_000))
    assert ids(vocabulary, text) == library.encode_ordinary(text)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 70_000), st.integers(0, 50)) | st.none(), max_size=120))
def test_queue_gives_the_least_rank_then_the_leftmost(steps):
    queue, held = RankQueue(70_001), []
    for s in steps:
        if s is None:
            assert queue.pop() == (min(held) if held else None)
            if held:
                held.remove(min(held))
        else:
            queue.push(*s)
            held.append(s)
    while held:
        assert queue.pop() == min(held)
        held.remove(min(held))
    assert queue.pop() is None


def test_documents(spark, make_docs, prose, library):
    docs = make_docs(edge_rows(prose(20_000)) + [(70 + k, prose(300) + "x" * 90 * k) for k in range(9)], ["i", "h", "decoded"])
    got = encode_documents(docs, PATH, P.PATTERN, decoded="bytes")
    got = got.withColumn("back", ByteBPE(spark, PATH, P.PATTERN).decode("ids")).collect()
    assert len(got) == docs.count() and got[0]["decoded"] == "x"
    for r in got:
        assert r["ids"] == library.encode_ordinary(r["text"] or "") and bytes(r["back"]) == bytes(r["bytes"]) == (r["text"] or "").encode()
    with pytest.raises(ValueError):
        encode_documents(docs, PATH, P.PATTERN, out="h")


def test_groups_and_learning_order(library, monkeypatch):
    from thermocal.llm import byte_bpe
    monkeypatch.setattr(byte_bpe, "GROUP", 7)
    monkeypatch.setattr(byte_bpe, "SYMBOLS", 90)
    ranks = read_ranks(PATH)
    v = Vocabulary(ranks, P.PATTERN, *engine_classes(ranks), memory=30)
    rng = random.Random(6)
    for _ in range(20):
        texts = [rng.choice([None, "", " ".join("".join(rng.choice("abcé1") for _ in range(rng.choice([1, 5, 200]))) for _ in range(rng.randrange(12)))])
                 for _ in range(15)]
        got, starts = v.encode(texts)
        assert [got[a:b].tolist() for a, b in zip(starts, starts[1:])] == [library.encode_ordinary(t or "") for t in texts]
        data, ends = v.decode(got, starts)
        assert [data[a:b].tobytes() for a, b in zip(ends, ends[1:])] == [(t or "").encode() for t in texts]


def test_null_ids_and_empty_table(spark, make_docs):
    codec = ByteBPE(spark, PATH, P.PATTERN)
    rows = spark.createDataFrame([([],), (None,)], "ids array<int>").select(codec.decode("ids").alias("b")).collect()
    assert [r["b"] for r in rows] == [b"", None]
    assert encode_documents(make_docs([]), PATH, P.PATTERN).collect() == []
    for bad in ([50_256], [-1], [None]):
        with pytest.raises(Exception, match="an id is"):
            spark.createDataFrame([(bad,)], "ids array<int>").select(codec.decode("ids")).collect()


def test_query_against_the_library(spark, sf_small, library):
    sha = lambda b: hashlib.sha256(b).hexdigest()
    want = set()
    for r in spark.read.parquet(f"{sf_small}/documents.parquet").select("doc_id", F.coalesce("text", F.lit("")).alias("text")).collect():
        t = library.encode_ordinary(r["text"])
        want.add((r["doc_id"], len(t), sha(",".join(map(str, t)).encode()), sha(r["text"].encode())))
    got = E.queries()["op11_byte_bpe"](spark, sf_small)
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert set(map(tuple, got.collect())) == want
