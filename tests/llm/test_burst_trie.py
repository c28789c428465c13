"""Nodes of the conversation trie against a dictionary of prefixes."""

import hashlib
import math
import random
import zlib
from collections import defaultdict

import pytest

from skillgauge.llm import burst_trie as B

SCHEMA = "conv_id long, turn long, role string, text string"


def own_turns(rows):
    out = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            out[c].append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [t[2:] for t in sorted(own)] for c, own in out.items()}


def replanted(own):
    h = lambda c: zlib.crc32(str(c).encode()) % 6
    return {c: own.get(c - int(math.fmod(c, 100)), [])[: h(c)] + t[h(c) :] for c, t in own.items()}


def nodes(conversations):
    members = defaultdict(list)
    for c, seq in conversations.items():
        for d in range(len(seq) + 1):
            members[tuple(seq[:d])].append(c)
    children = defaultdict(list)
    for p in members:
        if p:
            children[p[:-1]].append(p)

    def sums(p):
        below = [sums(k) for k in children[p]]
        own = (len(members[p]) - 1) * len(p[-1][1]) if p else 0
        return sum(b[0] for b in below) or 1, own + sum(b[1] for b in below)

    for p, own in members.items():
        ends = ",".join(str(c) for c in sorted(own) if len(conversations[c]) == len(p))
        yield min(own), len(p), min(members[p[:-1]]) if p else None, len(own), len(children[p]), *sums(p), hashlib.sha256(ends.encode()).hexdigest()


def talk(seed, n=260):
    rng = random.Random(seed)
    rows = []
    for c in range(n):
        for turn in range(rng.randint(1, 7)):
            rows.append((c, turn, rng.choice(["user", "assistant", None]), rng.choice(["hi", "no", "", None, "é漢 text", f"own {c}"])))
    for c in range(300, 420):  # the same conversation, and the same first turns
        rows += [(c, 0, "user", "hello"), (c, 1, "assistant", "yes"), *[(c, 2, "user", f"q{c}")][: c % 3]]
    rows += [(500, None, "a", "late"), (500, None, "a", "early"), (500, -1, None, None), (500, 2, "b", "x"), (500, 2, "b", "x"), (500, 2, "a", "x")]
    rows += [(None, 0, "user", "nobody's"), (-7, 0, "user", "below"), (100, 3, "user", "𝒳 astral"),
             *[(c, 0, "user", "whose first turns are another's, who has none") for c in range(1201, 1205)]]
    rng.shuffle(rows)
    return rows


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA + ", turns int, head string")


@pytest.mark.parametrize("limit", [1, 5, 40, 1000])
def test_nodes_equal_prefixes(spark, limit):
    rows = talk(limit)
    got = B.trie_nodes(B.sequences(table(spark, rows)), limit=limit)
    got = sorted((tuple(r)[:7] + (r.ends.hex(),) for r in got.collect()), key=str)
    assert got == sorted(nodes(own_turns(rows)), key=str)


def test_query(spark, tmp_path):
    rows = talk(9)
    folder = str(tmp_path / "t")
    table(spark, rows).write.parquet(f"{folder}/conversations.parquet")
    got = sorted(map(tuple, B.op13_burst_trie(spark, folder).collect()), key=str)
    want = sorted(nodes(replanted(own_turns(rows))), key=str)
    assert got == want
    assert any(r[1] == 0 and r[7] != hashlib.sha256(b"").hexdigest() for r in got)  # turnless conversations


def test_ids_in_several_chunks(spark):
    ids = [-5000, -1, 0, 3, 4095, 4096, 9000, 9001, 10**15]
    frame = spark.createDataFrame([(c, 0, "user", "same") for c in ids], SCHEMA)
    own = {r.depth: r for r in B.trie_nodes(B.sequences(frame)).collect()}
    assert own[1].ends.hex() == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
    assert (own[0].n_convs, own[1].saved_tokens, own[0].saved_tokens, own[1].parent_conv_id) == (len(ids), 32, 32, -5000)


def test_empty_table(spark):
    assert B.trie_nodes(B.sequences(spark.createDataFrame([], SCHEMA))).collect() == []
