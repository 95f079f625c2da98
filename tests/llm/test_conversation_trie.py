import hashlib
import math
import random
import re
import zlib
from collections import defaultdict

import pytest

import __spark_entry__ as E
from thermocal.llm import conversation_trie as ct

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_force(rows):
    """Every prefix of every rebuilt conversation in a dictionary."""
    turns = defaultdict(list)
    for c, t, role, text in rows:
        if c is not None:
            turns[c].append((t is not None, t or 0, role or "", text or ""))
    turns = {c: [x[2:] for x in sorted(v, key=lambda x: x[:2])] for c, v in turns.items()}
    rebuilt = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 4
        rebuilt[c] = tuple(turns.get(c - int(math.fmod(c, 20)), [])[:h] + own[h:])
    members, below = defaultdict(list), defaultdict(list)
    for c, s in rebuilt.items():
        for d in range(len(s) + 1):
            members[s[:d]].append(c)
    for s in members:
        if s:
            below[s[:-1]].append(s)
    out, leaves, saved = [], {}, {}
    for s in sorted(members, key=len, reverse=True):
        leaves[s] = sum(leaves[k] for k in below[s]) or 1
        saved[s] = (len(members[s]) - 1) * (len(WORD.findall(s[-1][1])) if s else 0) + sum(saved[k] for k in below[s])
        ends = ",".join(map(str, sorted(c for c in members[s] if rebuilt[c] == s)))
        out.append((min(members[s]), len(s), min(members[s[:-1]]) if s else None, len(members[s]), len(below[s]), leaves[s], saved[s],
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def nodes(df):
    return sorted(map(tuple, df.collect()), key=str)


def made(spark, rows, **kw):
    return nodes(ct.trie(ct.with_shared_heads(ct.sequences(spark.createDataFrame(rows, SCHEMA))), **kw))


def random_rows(seed, n, texts=("a", "b c", "d e f", "", None)):
    rng = random.Random(seed)
    return [(c, t, rng.choice(["user", "assistant", None]) if rng.random() < .1 else "user", rng.choice(texts))
            for c in rng.sample(range(-n, 3 * n), n) for t in rng.sample([None, *range(9)], rng.randrange(1, 7))]


@pytest.mark.parametrize("shard_turns, fan", [(200_000, 16), (40, 2), (7, 3), (1, 2)])
def test_against_brute_force(spark, shard_turns, fan):
    rows = random_rows(1, 120)
    assert made(spark, rows, shard_turns=shard_turns, fan=fan) == brute_force(rows)


def test_deep_conversations_and_hot_sequences(spark):
    long = [(7, t, "user", f"w{t % 3}") for t in range(3000)] + [(47, t, "user", f"w{t % 3}") for t in range(2990)]
    copies = [(c, t, "user", f"same {t}") for c in range(100, 5300, 2) for t in range(2)]
    rows = long + copies + random_rows(2, 40)
    rows = list({(r[0], r[1]): r for r in rows}.values())
    want = brute_force(rows)
    assert made(spark, rows) == want
    assert made(spark, rows, shard_turns=1500, fan=2) == want


def test_defined_results(spark):
    rows = [(None, 0, "user", "no conversation"), (3, None, None, "null turn first"), (3, 0, "user", None), (20, 1, "user", " \t"), (21, 0, "ab", "c"),
            (22, 0, "a", "bc"), (23, 5, "user", "x y"), (23, 5, "user", "x y"), (-41, 0, "user", "x y"), (-40, 0, "user", "q"), (41, 2, "", "")]
    assert made(spark, rows) == brute_force(rows)
    assert made(spark, []) == []
    assert made(spark, [(None, 0, "user", "x")]) == []


def test_ties_do_not_depend_on_row_order(spark):
    rows = [(1, 0, "user", t) for t in ("b", "a", "c")] + [(2, 0, "user", t) for t in ("c", "b", "a")]
    a = nodes(ct.trie(ct.sequences(spark.createDataFrame(rows, SCHEMA))))
    assert a == nodes(ct.trie(ct.sequences(spark.createDataFrame(rows[::-1], SCHEMA).repartition(4))))
    assert max(r[1] for r in a) == 3 and a[0][3] == 2


def test_turnless_conversations_are_members_of_the_root(spark):
    c = next(c for c in range(21, 40) if zlib.crc32(str(c).encode()) % 4 >= 1)
    got = made(spark, [(c, 0, "user", "dropped, and no conversation 20 to take from")])
    assert got == [(c, 0, None, 1, 0, 1, 0, hashlib.sha256(str(c).encode()).hexdigest())]


def test_clashing_columns(spark):
    rows = random_rows(3, 30)
    df = spark.createDataFrame(rows, SCHEMA)
    for c in ("conv", "turns", "h", "w", "seq", "key", "n", "low", "base", "head"):
        df = df.selectExpr("*", f"'x' AS `{c}`")
    assert nodes(ct.trie(ct.with_shared_heads(ct.sequences(df)))) == brute_force(rows)


def test_median_order_balances_siblings():
    assert sorted(ct.medians(100)) == list(range(100))
    tree = ct.Tree()
    for i in ct.medians(1023):
        tree.insert([i], [1], 1, i, i)

    def height(node):
        return 0 if not node else 1 + max(height(tree.less[node]), height(tree.more[node]))
    assert height(tree.down[0]) == 10


def test_query_against_brute_force(spark, sf_small):
    rows = list(map(tuple, spark.read.parquet(f"{sf_small}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()))
    assert nodes(E.queries()["op12_conversation_trie"](spark, sf_small)) == brute_force(rows)
