"""The prefix trie against a plain one in memory."""

import hashlib
import random
import zlib

import duckdb
import pytest

from skyledger.llm import prefix_trie as trie

TABLE = "conv_id long, turn long, role string, text string"


def digest(role, text):
    return hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()


def plain(rows):
    turns = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            turns.setdefault(conv, []).append((turn is not None, turn or 0, digest(role or "", text or ""), role or "", text or ""))
    own = {c: [t[3:] for t in sorted(ts)] for c, ts in turns.items()}
    rebuilt = {}
    for c, mine in own.items():
        h, base = zlib.crc32(str(c).encode()) % 9, c - (abs(c) % 5) * (1 if c >= 0 else -1)
        rebuilt[c] = tuple(own.get(base, [])[:h] + mine[h:])
    members = {}
    for c, path in rebuilt.items():
        for d in range(len(path) + 1):
            members.setdefault(path[:d], []).append(c)
    children, leaves, saved = dict.fromkeys(members, 0), dict.fromkeys(members, 0), dict.fromkeys(members, 0)
    for node in members:
        if node:
            children[node[:-1]] += 1
    for node in members:
        for d in range(len(node) + 1):
            leaves[node[:d]] += children[node] == 0
            saved[node[:d]] += (len(members[node]) - 1) * len(node[-1][1].encode()) if node else 0
    return sorted((
        min(cs), len(node), min(members[node[:-1]]) if node else None, len(cs), children[node], leaves[node], saved[node],
        hashlib.sha256(",".join(str(c) for c in sorted(cs) if rebuilt[c] == node).encode()).hexdigest()) for node, cs in members.items())


def check(spark, rows, **options):
    found = trie.prefix_trie(spark.createDataFrame(rows, TABLE).repartition(5), **options).collect()
    assert sorted(map(tuple, found)) == plain(rows)


def family_rows(seed, convs=60, texts=3, longest=14):
    draw = random.Random(seed)
    return [(c, t, draw.choice(["user", "bot"]) if t else "user", f"é{draw.randrange(texts)}") for c in range(convs) for t in range(draw.randint(1, longest))]


@pytest.mark.parametrize("band", [2, 3, 16])
def test_shared_first_turns_equal_plain_trie(spark, band):
    check(spark, family_rows(1), band=band)


def test_long_conversations_cross_bands_and_parts(spark):
    """Copies of one long conversation with different ends: most rows have the same first turns."""
    same = [(5 * c, t, "user", f"t{t}" if t < 70 + c else f"{c}") for c in range(6) for t in range(90)]
    check(spark, same, band=4)


def test_ids_of_many_equal_conversations_are_joined_in_blocks(spark):
    rows = [(5 * c, 0, "user", "hello") for c in range(300)] + [(5 * c + 5000, 0, "user", f"x{c % 7}") for c in range(40)]
    check(spark, rows, block_bits=3)


def test_odd_rows(spark, clashing):
    rows = [
        (None, 1, "user", "lost"), (0, None, None, None), (0, None, "user", "a"), (0, 2, "user", ""), (0, 2, "user", ""), (0, 2, "user", "b"), (1, 0, "user", "a"),
        (2, None, None, "x" * 100_000), (-3, 1, "u", "n"), (-3, 2, "u", "é"), (-5, -1, "u", "base"), (9223372036854775807, 1, "u", "z"), (7, 5, "u", "absent base"),
    ] + [(3, t, "user", "a") for t in range(12)] + [(10, t, "user", "a") for t in range(3)] + [(c, 0, "u", "a") for c in range(11, 15)]
    check(spark, rows)
    wide = clashing(spark.createDataFrame(rows, TABLE), "depth", "x", "Turn")
    assert sorted(map(tuple, trie.prefix_trie(wide).collect())) == plain(rows)


def test_empty_table(spark):
    assert trie.prefix_trie(spark.createDataFrame([], TABLE)).collect() == []
    assert trie.prefix_trie(spark.createDataFrame([(None, 1, "u", "a")], TABLE)).collect() == []


def test_sql_equals_plain_trie():
    rows = family_rows(2, longest=6) + [(0, None, None, None), (77, 3, None, "a"), (77, 3, None, "a")]
    db = duckdb.connect()
    db.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    db.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", rows)
    assert sorted(db.sql(trie.TRIE_SQL).fetchall()) == plain(rows)
