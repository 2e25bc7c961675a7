import hashlib
import random
from collections import defaultdict

import pytest

from guichet.llm import conversation_trie


def brute_force(conversations):
    """Every prefix of every conversation (a list of (role, text)) spelled out."""
    members, ends = defaultdict(list), defaultdict(list)
    for conv, turns in conversations.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(conv)
        ends[tuple(turns)].append(conv)
    out = []
    for node, convs in members.items():
        below = [x for x in members if x[: len(node)] == node]
        children = [x for x in below if len(x) == len(node) + 1]
        leaves = sum(not any(len(y) == len(x) + 1 and y[: len(x)] == x for y in below) for x in below)
        saved = sum((len(members[x]) - 1) * (len(x[-1][1]) if x else 0) for x in below)
        up = min(members[node[:-1]]) if node else None
        spelled = ",".join(map(str, sorted(ends[node]))) if node in ends else ""
        out.append((min(convs), len(node), up, len(convs), len(children), leaves, saved, hashlib.sha256(spelled.encode()).hexdigest()))
    return sorted(out, key=repr)


def rows_of(df):
    columns = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def table(spark, conversations, extra=()):
    rows = [(c, t, role, text) for c, turns in conversations.items() for t, (role, text) in enumerate(turns)]
    random.Random(1).shuffle(rows)
    return spark.createDataFrame([*rows, *extra], "conv_id long, turn long, role string, text string").repartition(3)


def some(seed, n, copies=0):
    r = random.Random(seed)
    words = ["", "a", "bb", "ccc", "\U0001f600é"]
    out = {r.randrange(10**9): [(r.choice("ua"), r.choice(words)) for _ in range(min(r.randrange(9), r.randrange(9)) + 1)] for _ in range(n)}
    same = [("u", "a"), ("a", "bb")]
    return out | {10**9 + i: list(same) for i in range(copies)}


@pytest.mark.parametrize("parts", [1, 2, 7, 40])
def test_equals_brute_force(spark, parts):
    conversations = some(parts, 60, copies=25)
    got = conversation_trie.prefix_trie(conversation_trie.ordered_turns(table(spark, conversations)), parts=parts, block=4)
    assert rows_of(got) == brute_force(conversations)


def forest(seqs, parts):
    """The nodes of sequences dealt to ``parts`` runs, shared ones added up in plain Python."""
    digests = {s: b"".join(hashlib.md5(repr(t).encode()).digest() for t in s) for s in seqs}
    order = sorted(seqs, key=digests.__getitem__)
    cuts = sorted(random.Random(parts).sample(range(1, len(order)), min(parts, len(order)) - 1))
    runs = [order[a:b] for a, b in zip([0, *cuts], [*cuts, len(order)], strict=True)]
    rows = []
    for i, run in enumerate(runs):
        before = digests[runs[i - 1][-1]] if i else None
        after = digests[runs[i + 1][0]] if i + 1 < len(runs) else None
        f = conversation_trie._Forest([digests[s] for s in run], [[len(t[1]) for t in s] for s in run], [seqs[s][0] for s in run], [seqs[s][1] for s in run], ["e" for _ in run], before, after)
        rows += zip(*f.out, strict=True)
    return rows


def test_forests_add_up():
    r = random.Random(9)
    for trial in range(150):
        conversations = some(trial, r.randrange(2, 30), copies=r.randrange(4))
        seqs = {}
        for c, turns in conversations.items():
            low, n = seqs.get(tuple(turns), (c, 0))
            seqs[tuple(turns)] = (min(low, c), n + 1)
        rows = forest(seqs, r.randrange(1, 8))
        shared = defaultdict(list)
        for row in rows:
            if row[0] is not None:
                shared[row[0]].append(row)
        convs = {k: min(x[2] for x in v) for k, v in shared.items()}
        got = [(x[2], x[3], convs[x[1]] if x[4] is None and x[1] else x[4], *x[5:9]) for x in rows if x[0] is None]
        got += [(convs[k], v[0][3], convs.get(v[0][1]), *(sum(x[i] for x in v) for i in (5, 6, 7, 8))) for k, v in shared.items()]
        assert sorted(got, key=repr) == sorted((x[:7] for x in brute_force(conversations)), key=repr)


def test_odd_rows(spark):
    rows = [(None, 0, "u", "x"), (1, None, "u", "first"), (1, 0, None, None), (1, 0, None, None), (2, None, "u", "first"), (2, 5, "", ""), (3, 1, "u", "long " * 50_000), (-7, 1, "u", "long " * 50_000)]
    df = spark.createDataFrame([(*r, "clash", 0) for r in rows], "conv_id long, turn long, role string, text string, turns string, key int")
    want = {1: [("u", "first"), ("", ""), ("", "")], 2: [("u", "first"), ("", "")], 3: [("u", "long " * 50_000)], -7: [("u", "long " * 50_000)]}
    assert rows_of(conversation_trie.prefix_trie(conversation_trie.ordered_turns(df))) == brute_force(want)
    assert conversation_trie.prefix_trie(conversation_trie.ordered_turns(df.limit(0))).count() == 0


def test_without_turns(spark):
    df = spark.createDataFrame([(4, []), (9, [])], "conv_id long, turns array<struct<digest:string,points:int>>")
    assert rows_of(conversation_trie.prefix_trie(df)) == brute_force({4: [], 9: []})


def test_turns_on_the_same_number_are_in_the_order_of_digests(spark):
    df = spark.createDataFrame([(1, 0, "u", x) for x in "abcdef"], "conv_id long, turn long, role string, text string")
    digests = [t["digest"] for t in conversation_trie.ordered_turns(df.repartition(5)).first()["turns"]]
    assert digests == sorted(digests)
