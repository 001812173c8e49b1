"""The prefix trie against brute force: many blocks, hot prefixes, prefixes of others, empty sequences."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import oracle_sql, queries
from compare import differences, duck
from veracast.llm import prefix_trie
from veracast.llm.prefix_trie import Forest, begins, common_steps

STEPS = "conv_id long, turns array<struct<digest: binary, tokens: long>>, depth string"


def _digest(word):
    return hashlib.sha256(word.encode()).digest()[:16]


def _brute(members):
    """Rows of the trie from all prefixes of all members' (word, tokens) sequences."""
    nodes = {}
    for i, seq in members.items():
        for d in range(len(seq) + 1):
            nodes.setdefault(tuple(w for w, _ in seq[:d]), []).append(i)
    tokens = {tuple(w for w, _ in seq[:d]): seq[d - 1][1] for seq in members.values() for d in range(1, len(seq) + 1)}
    rows = []
    for p, ids in nodes.items():
        under = [q for q in nodes if q[: len(p)] == p]
        kids = [q for q in under if len(q) == len(p) + 1]
        leaves = [q for q in under if not any(len(r) > len(q) and r[: len(q)] == q for r in under)]
        ends = ",".join(str(i) for i in sorted(ids) if len(members[i]) == len(p))
        rows.append(
            (min(ids), len(p), min(nodes[p[:-1]]) if p else None, len(ids), len(kids), len(leaves),
             sum((len(nodes[q]) - 1) * tokens.get(q, 0) for q in under), hashlib.sha256(ends.encode()).hexdigest())
        )
    return sorted(rows, key=str)


def _found(spark, members, **options):
    rows = [(i, [(_digest(w), n) for w, n in seq], "clash") for i, seq in members.items()]
    df = spark.createDataFrame(rows, STEPS).repartition(3)
    got = prefix_trie.prefix_trie(df, **options)
    names = "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256".split()
    return sorted((tuple(r[c] for c in names) for r in got.collect()), key=str)


def _random(seed, n, words, most):
    draw = random.Random(seed)
    tokens = {w: draw.randrange(1, 9) for w in words}
    out = {}
    for i in range(n):
        seq = [draw.choice(words) for _ in range(draw.randrange(most + 1))]
        out[draw.randrange(-50, 10**12)] = [(w, tokens[w]) for w in seq]
    return out


@pytest.mark.parametrize("seed, words, most", [(1, "ab", 5), (2, "abcdefgh", 3), (3, "a", 9)])
def test_as_brute_force_in_many_blocks(spark, seed, words, most):
    members = _random(seed, 150, words, most)
    assert _found(spark, members, block_bytes=300) == _brute(members)


def test_hot_prefix_and_long_sequence(spark):
    hot = [("h", 2)] * 3
    members = {i: [*hot, (f"w{i % 40}", 1), ("z", 3)][: 2 + i % 4] for i in range(200)}
    members |= {1000 + i: hot for i in range(80)}
    members[5000] = [*hot, *[("long", 1)] * 2000]
    assert _found(spark, members, block_bytes=2000) == _brute(members)


def test_no_members_no_steps(spark):
    assert _found(spark, {}) == []
    assert _found(spark, {4: [], 9: []}) == _brute({4: [], 9: []})
    rows = spark.createDataFrame([(None, [], "x"), (3, None, "x")], STEPS)
    assert [tuple(r)[:4] for r in prefix_trie.prefix_trie(rows).collect()] == [(3, 0, None, 1)]


def test_blocks_cut_anywhere():
    """All ways of cutting a few sorted sequences into blocks add up to the uncut trie."""
    for seed in range(40):
        members = _random(seed, 12, "ab", 4)
        by_key = {}
        for i, seq in members.items():
            by_key.setdefault(b"".join(_digest(w) for w, _ in seq), []).append((i, [n for _, n in seq]))
        keys = sorted(by_key)
        rows = [
            (k, by_key[k][0][1], min(i for i, _ in by_key[k]), len(by_key[k]),
             hashlib.sha256(",".join(map(str, sorted(i for i, _ in by_key[k]))).encode()).hexdigest())
            for k in keys
        ]
        draw = random.Random(seed)
        cuts = sorted(draw.sample(range(1, len(rows)), min(len(rows) - 1, draw.randrange(0, 6))))
        blocks = [rows[a:b] for a, b in zip([0, *cuts], [*cuts, len(rows)])]
        intra = [common_steps(b[0][0], b[-1][0]) for b in blocks]
        bounds = [common_steps(a[-1][0], b[0][0]) for a, b in zip(blocks, blocks[1:])]
        merged, whole = {}, []
        for part, (block, place) in enumerate(zip(blocks, begins(intra, bounds))):
            columns = prefix_trie.block_nodes(*map(list, zip(*block)), part, *place)
            for depth, start, conv, up, up_start, n, kids, leaves, saved, ends in zip(*[c.to_pylist() for c in columns]):
                if start is None:
                    whole.append((depth, conv, up, up_start, n, kids, leaves, saved))
                    continue
                old = merged.get((depth, start), (conv, up_start, 0, 0, 0, 0))
                assert old[1] == up_start
                merged[depth, start] = (
                    min(old[0], conv), up_start, old[2] + n, old[3] + kids, old[4] + leaves, old[5] + saved,
                )
        got = [
            (conv, d, up if s is None else merged[d - 1, s][0], n, kids, leaves, saved)
            for d, conv, up, s, n, kids, leaves, saved in whole
        ] + [
            (conv, d, None if s is None else merged[d - 1, s][0], n, kids, leaves, saved)
            for (d, _), (conv, s, n, kids, leaves, saved) in merged.items()
        ]
        assert sorted(got, key=str) == [r[:7] for r in _brute(members)], seed


def test_forest_merges_equal_depths_into_one_node():
    forest = Forest([5, 5, 5, 5], [2, 2, 1])
    assert forest.depth[4:] == [2, 1]
    assert forest.parent == [4, 4, 4, 5, 5, -1]
    assert (forest.first[4], forest.last[4], forest.first[5], forest.last[5]) == (0, 2, 0, 3)
    # A sequence that is the beginning of its neighbour is that node itself.
    assert Forest([1, 3, 3], [1, 2]).parent == [-1, 3, 3, 0]


def test_turns(spark):
    rows = [
        (1, 2, "user", "a  b\tc"), (1, None, None, None), (1, 1, "user", "x"), (None, 1, "user", "lost"),
        (2, 1, "us", "erx"), (3, 1, "user", "x"),
    ]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r["conv_id"]: r["turns"] for r in prefix_trie.turns_of(df).collect()}
    assert [t["tokens"] for t in got[1]] == [0, 1, 3]
    assert got[1][1] == got[3][0] != got[2][0]


def test_rebuilt_conversations(spark, tmp_path):
    """Against the rule, in a table with absent first conversations and short ones."""
    import zlib

    rows = [(c, t, "user", f"{c} {t}") for c in (0, 3, 7, 13, 25, 26, 33, 47, -3) for t in range(1 + abs(c) % 4)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    df.write.parquet(str(tmp_path / "conversations.parquet"))
    own = {}
    for c, t, _, text in rows:
        own.setdefault(c, []).append((text, 2))
    members = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        members[c] = own.get(c - (abs(c) % 20 if c > 0 else -(abs(c) % 20)), [])[:h] + turns[h:]
    got = queries()["op12_prefix_trie"](spark, str(tmp_path))
    names = "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256".split()
    assert sorted((tuple(r[c] for c in names) for r in got.collect()), key=str) == _brute(members)
    assert got.where(F.col("depth") == 0).count() == 1


def test_matches_duckdb(spark):
    small = "/root/testdata/sf0.001"
    assert differences(queries()["op12_prefix_trie"](spark, small), duck(small), oracle_sql()["op12_prefix_trie"]) == []
