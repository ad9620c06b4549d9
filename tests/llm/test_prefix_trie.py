"""The prefix trie against its definition, on small conversations with every odd case."""

import collections
import hashlib
import random
import zlib

import pytest

from sparkfold.llm.prefix_trie import build_trie, conversation_trie, rebuild

SCHEMA = "conv_id long, turn int, role string, text string, path string, skel int"


def brute_trie(rows):
    convs = collections.defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            convs[c].append((turn is not None, turn or 0, role or "", hashlib.md5((text or "").encode()).digest(), text or ""))
    turns = {c: [(t[2], t[4]) for t in sorted(v)] for c, v in convs.items()}
    whole = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (c % 100 if c >= 0 else -(-c % 100))
        whole[c] = turns.get(base, [])[:h] + own[h:]
    members = collections.defaultdict(list)
    for c, path in whole.items():
        for d in range(len(path) + 1):
            members[tuple(path[:d])].append(c)
    kids = collections.Counter(p[:-1] for p in members if p)
    out = []
    for p, who in members.items():
        below = [q for q in members if q[:len(p)] == p]
        ends = ",".join(str(c) for c in sorted(c for c in who if len(whole[c]) == len(p)))
        out.append((min(who), len(p), min(members[p[:-1]]) if p else None, len(who), kids[p], sum(not kids[q] for q in below),
                    sum((len(members[q]) - 1) * len(q[-1][1]) for q in below if q), hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def result(df):
    assert df.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted(map(tuple, df.collect()), key=repr)


def conversations(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)


def test_odd_rows(spark):
    rows = [(0, 0, "system", "é" * 5), (0, 1, "user", None), (0, 2, None, "b"), (1, None, "user", "first"), (1, 0, "user", "then"),
            (1, 0, "assistant", "tie"), (1, 0, "assistant", "tie"), (5, 1, "user", ""), (None, 0, "user", "x"), (205, 0, "user", "no base"),
            (-3, 0, "user", "below"), (9, 0, "user", "long " * 30000)]
    assert result(conversation_trie(conversations(spark, rows))) == brute_trie(rows)


@pytest.mark.parametrize("seed", [1, 2])
def test_random_and_hot(spark, seed):
    rng = random.Random(seed)
    rows = []
    for c in range(260):
        hot = rng.random() < 0.4
        for t in range(rng.randrange(0, 7)):
            rows.append((c, t, "user" if t % 2 else "assistant", "same" if hot or t == 0 and rng.random() < 0.7 else rng.choice("abc")))
    assert result(conversation_trie(conversations(spark, rows))) == brute_trie(rows)


def test_many_equal_paths(spark):
    """Numbers that end at one node are hashed in order across chunks and shards."""
    paths = spark.range(0, 20000).selectExpr("id AS conv_id", "unhex(md5('t')) AS path", "array(3) AS chars")
    got = {r.depth: r for r in build_trie(paths).collect()}
    assert len(got) == 2 and (got[1].n_convs, got[1].saved_tokens, got[0].n_leaves) == (20000, 19999 * 3, 1)
    assert got[1].ends_sha256 == hashlib.sha256(",".join(map(str, range(20000))).encode()).hexdigest()
    assert got[0].ends_sha256 == hashlib.sha256(b"").hexdigest()


def test_no_rows(spark):
    assert result(conversation_trie(conversations(spark, []))) == []
    assert rebuild(conversations(spark, [(None, 1, "user", "x")])).count() == 0
