"""The trie of conversation prefixes against a brute-force trie and the SQL twin."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import duckdb
import pytest

from farebox.llm import prefix_trie as pt
from verify import differences

SCHEMA = "conv_id long, turn long, role string, text string"
NAMES = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def digest(role, text):
    return hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()


def brute(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            own[conv].append(((turn is not None, turn or 0), digest(role, text), role, text))
    own = {c: [t[2:] for t in sorted(turns)] for c, turns in own.items()}
    rebuilt = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (abs(c) % 20) * (1 if c >= 0 else -1)
        rebuilt[c] = own.get(base, [])[:h] + turns[h:]
    members = defaultdict(set)
    for c, turns in rebuilt.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].add(c)
    out = []
    for node, convs in members.items():
        below = [v for v in members if v[: len(node)] == node]
        ends = sorted(c for c in convs if len(rebuilt[c]) == len(node))
        out.append((
            min(convs), len(node), min(members[node[:-1]]) if node else None, len(convs),
            sum(len(v) == len(node) + 1 for v in below),
            sum(all(w[: len(v)] != v or w == v for w in members) for v in below),
            sum((len(members[v]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", v[-1][1])) for v in below if v),
            hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest(),
        ))
    return sorted(out, key=lambda r: (r[1], r[0]))


def built(spark, rows, width=4, parts=5):
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS node", "'x' AS prior", "2 AS block", "3 AS depth").repartition(parts)
    got = pt.prefix_trie(df, width)
    assert got.columns == NAMES
    return sorted((tuple(r) for r in got.collect()), key=lambda r: (r[1], r[0]))


def drawn(seed, convs=90, turns=11, texts=2):
    rng = random.Random(seed)
    ids = rng.sample(range(-60, 400), convs)
    return [(c, i, rng.choice(["user", "assistant"]) if rng.random() < 0.2 else "user", rng.choice(["a", "b c", "d e f"][:texts]))
            for c in ids for i in range(rng.randint(1, turns))]


@pytest.mark.parametrize("width", [1, 3, 4])
def test_matches_brute_force(spark, width):
    rows = drawn(width)
    assert built(spark, rows, width) == brute(rows)


def test_nulls_ties_repeats_and_odd_texts(spark):
    rows = drawn(9, convs=30)
    rows += [(500, None, "user", "first"), (500, 1, None, None), (500, 1, "", ""), (500, 1, "user", "x"), (500, 1, "user", "x")]
    rows += [(501, 0, "us", "er a"), (502, 0, "user", " a"), (503, 0, "user", "\x0b\x1f    é\n"), (504, 0, None, None)]
    rows += [(None, 0, "user", "no conversation"), (None, None, None, None), (505, 3, "user", "long " * 50_000)]
    rows += [(520 + i, t, "user", "same") for i in range(40) for t in range(3)]
    assert built(spark, rows, parts=7) == brute(rows)


def test_a_conversation_without_turns_is_a_member_of_the_root(spark):
    alone = next(c for c in range(21, 40) if zlib.crc32(str(c).encode()) % 4 == 3)
    rows = [(alone, 0, "user", "goes"), (alone, 1, "user", "too"), (77, 0, "user", "x")]
    assert built(spark, rows) == brute(rows)
    assert built(spark, rows[:2]) == [(alone, 0, None, 1, 0, 1, 0, hashlib.sha256(str(alone).encode()).hexdigest())]


def test_empty_table(spark):
    assert pt.prefix_trie(spark.createDataFrame([], SCHEMA)).collect() == []


def test_long_conversations_and_hot_nodes(spark, monkeypatch):
    monkeypatch.setattr(pt, "HOT_SHARE", 8)
    monkeypatch.setattr(pt, "CHUNK", 3)
    rows = [(c, t, "user", "hot") for c in range(0, 60) for t in range(2)]
    rows += [(c, 2, "user", f"own {c}") for c in range(0, 40)]
    rows += [(1000 + c, t, "user", f"{t % 7}") for c in range(3) for t in range(150 - c)]
    assert built(spark, rows) == brute(rows)


def test_sql_twin_agrees(spark):
    rows = drawn(5) + [(7000, None, None, "é x"), (7000, 2, "user", None), (None, 1, "user", "y")]
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", rows)
    problem, n = differences(pt.prefix_trie(spark.createDataFrame(rows, SCHEMA)), con, pt.SQL)
    assert problem is None and n > 100, problem
