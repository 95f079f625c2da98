import re

from .conftest import edge_rows
from thermocal.llm.decontaminate import decontaminate

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute(text, items, window=10):
    words = WORD.findall((text or "").translate(LOWER))
    hit, ids = set(), set()
    for item, t in items:
        w = WORD.findall((t or "").translate(LOWER))
        wins = [w[i:i + window] for i in range(max(1, len(w) - window + 1))] if w else []
        for win in wins:
            for i in range(len(words) - len(win) + 1):
                if words[i:i + len(win)] == win:
                    hit |= set(range(i, i + len(win)))
                    if item is not None:
                        ids.add(item)
    return len(words), len(hit), sorted(ids)


def run(spark, docs, items, **kw):
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    return [r["decontamination"] for r in decontaminate(docs, bench, **kw).collect()]


def test_against_brute_force(spark, make_docs, prose):
    items = [(i, prose(n)) for i, n in enumerate([30, 25, 4, 1, 12, 10, 9])] + [(7, None), (8, "..."), (None, "Only A Nameless Item"), (0, prose(14))]
    texts = [prose(40) + " " + items[0][1].upper() + " " + prose(5), "x " + items[2][1].replace(" ", " -- ") + "\ny",
             items[1][1] + " " + items[1][1], prose(300), "só a nameless ITEM: only a nameless item", items[4][1][3:]]
    rows = [(100 + i, t) for i, t in enumerate(texts)] + edge_rows(prose(30_000) + " " + items[0][1])
    want = [brute(r[1], items) for r in rows]
    for kw in ({}, {"block_bytes": 60}):  # one block, and many
        got = run(spark, make_docs(rows, ["n_hit", "decontamination"]), items, **kw)
        assert sorted((g["n_words"], g["n_hit"], g["items"]) for g in got) == sorted(want)
    assert sum(w[1] > 0 for w in want) >= 5


def test_spans_map_to_the_original(spark, make_docs):
    text = "É — Alpha,  BETA\n🙂 gamma! delta"
    got = run(spark, make_docs([(1, text)]), [(1, "alpha beta 🙂 gamma")])[0]
    assert [text[s["start"]:s["end"]] for s in got["spans"]] == ["Alpha,  BETA\n🙂 gamma"]


def test_empty_tables(spark, make_docs):
    assert run(spark, make_docs([]), [(1, "a b")]) == []
    assert run(spark, make_docs([(1, "a b")]), [])[0]["n_words"] == 2
