import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from thermocal.llm import elias_fano
from thermocal.llm.common import scratch
from thermocal.llm.token_files import Encoder, Shard, read_token_files, write_token_files

from .conftest import edge_rows

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("word_bpe_49k.json")


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 1 << 45), max_size=700))
def test_elias_fano_round_trip(values):
    values = sorted(values)
    data = elias_fano.encode(np.array(values, np.uint64))
    ef = elias_fano.EliasFano(data)
    assert [ef.select(i) for i in range(len(ef))] == values == list(ef)


def test_elias_fano_space():
    n = 100_000
    ends = np.cumsum(np.random.default_rng(0).integers(1, 2000, n))
    bits = 8 * len(elias_fano.encode(ends)) / n
    assert bits < 2 + np.log2(ends[-1] / n) + 0.5


def whole(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids + [1]


def test_files_hold_what_the_tokenizer_returns(spark, make_docs, prose):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(PATH)
    rows = edge_rows(prose(20_000)) + [(10 + i, prose(30)) for i in range(40)] + [
        (60, "It's I'LL x.y,z. --- a1b22 <|endoftext|> <|startoftext|>x é     ﬁ Σας İ 'S don't.,"), (61, "a\x00b\x1cc\u0085d")]
    folder = scratch(spark, "t")
    manifest = write_token_files(make_docs(rows, ["i", "h", "t"]).repartition(5), folder, PATH)
    got = read_token_files(spark, folder, manifest).orderBy("start").collect()
    want = sorted(((r[0] if r[0] is not None else -1 << 70, zlib.crc32(np.array(whole(tok, r[1]), "<u4").tobytes()), len(whole(tok, r[1]))) for r in rows))
    assert sorted((g["doc_id"] if g["doc_id"] is not None else -1 << 70, g["ids_crc32"], g["n_tokens"]) for g in got) == want
    ids = [g["doc_id"] if g["doc_id"] is not None else -1 << 70 for g in got]
    assert ids == sorted(ids)
    assert [g["start"] for g in got] == list(np.cumsum([0] + [g["n_tokens"] for g in got])[:-1])
    m = max(manifest, key=lambda m: m["docs"])
    s = Shard(folder, m["shard"], m["width"])
    for i, (doc, start, ids) in enumerate(s):
        assert s.bounds(i) == (start, start + len(ids)) and s.doc_id(i) == doc and list(s.tokens(i)) == list(ids)


def test_bounded_memory_of_pieces(prose):
    from tokenizers import Tokenizer
    tok, enc = Tokenizer.from_file(PATH), Encoder(PATH, memory=20)
    for _ in range(5):
        t = prose(60)
        assert list(np.frombuffer(enc.encode(t.encode(), np.dtype("<u2")), "<u2")) == tok.encode(t, add_special_tokens=False).ids


def test_empty_table(spark, make_docs):
    folder = scratch(spark, "t")
    assert write_token_files(make_docs([]), folder, PATH) == []
    assert read_token_files(spark, folder, []).collect() == []
