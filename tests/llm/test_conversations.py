"""Prefix trie and structure repair of conversations against brute force, on small tables and on edge rows."""

import hashlib
import heapq
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from vigil.llm import structure, trie

CONVS = "conv_id long, turn long, role string, text string, extra int, words int, path string, code int"
LONG = " ".join(f"w{i}" for i in range(20000))


def frame(spark, rows, schema=CONVS):
    return spark.createDataFrame([(*r, 1, 2, "x", 3) for r in rows], schema)


def family(seed, n, most=7):
    """Conversations that share starts of all lengths, some whole."""
    rng = random.Random(seed)
    made = []
    for c in range(n):
        start = rng.choice(made)[: rng.randint(0, most)] if made and rng.random() < 0.8 else []
        made.append(start + [("user" if k % 2 == 0 else "assistant", f"t{rng.randint(0, 3)} word{rng.randint(0, 2)}") for k in range(len(start), rng.randint(len(start), most))])
    return made


def brute_nodes(paths):
    """conv_id -> turns (role, text); the contract's columns by prefix."""
    members = defaultdict(list)
    for c, turns in paths.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    out = []
    for key, cs in members.items():
        below = [k for k in members if k[: len(key)] == key]
        childless = [k for k in below if not any(len(x) == len(k) + 1 and x[: len(k)] == k for x in members)]
        ends = ",".join(str(c) for c in sorted(cs) if len(paths[c]) == len(key))
        out.append((min(cs), len(key), min(members[key[:-1]]) if key else None, len(cs), sum(len(k) == len(key) + 1 for k in below), len(childless),
                    sum((len(members[k]) - 1) * len(k[-1][1].split()) for k in below if k), hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize("shards", [1, 3, 40])
def test_trie_equals_brute_force_at_any_number_of_shards(spark, shards):
    made = dict(enumerate(family(1, 90)))
    made |= {200 + i: made[5] or made[6] for i in range(60)}  # a hot path over many shards
    rows = [(c, k, *t) for c, turns in made.items() for k, t in enumerate(turns)]
    got = trie.trie(trie.paths(frame(spark, rows)), shards).collect()
    assert sorted(map(tuple, got)) == brute_nodes({c: t for c, t in made.items() if t})


def test_trie_with_a_small_skeleton_and_pieces_of_member_lists(spark, monkeypatch):
    monkeypatch.setattr(trie, "SKELETON", 16)  # splitters of two turns at most
    monkeypatch.setattr(trie, "ENDS_BYTES", 16)
    made = {c: t for c, t in enumerate(family(2, 120)) if t}
    made |= {500 + i: made[min(made)][:1] for i in range(50)}
    rows = [(c, k, *t) for c, turns in made.items() for k, t in enumerate(turns)]
    assert sorted(map(tuple, trie.trie(trie.paths(frame(spark, rows)), 8).collect())) == brute_nodes(made)


def test_rebuilt_paths_take_heads(spark):
    made = {c: t for c, t in enumerate(family(3, 70)) if t and c != 20}
    made[45] = made[45][:1] or [("user", "a")]
    rows = [(c, k, *t) for c, turns in made.items() for k, t in enumerate(turns)]
    want = {}
    for c, turns in made.items():
        h = zlib.crc32(str(c).encode()) % 4
        want[c] = made.get(c - c % 20, [])[:h] + turns[h:]
    assert sorted(map(tuple, trie.trie(trie.rebuilt_paths(frame(spark, rows))).collect())) == brute_nodes(want)


def test_trie_edge_rows(spark):
    rows = [(1, None, None, None), (1, 0, "user", LONG), (2, None, "", ""), (2, 0, "user", LONG), (2, 0, "user", LONG), (None, 0, "user", "x"), (3, 0, "user", "")]
    got = sorted(map(tuple, trie.trie(trie.paths(frame(spark, rows))).collect()))
    made = {1: [("", ""), ("user", LONG)], 2: [("", ""), ("user", LONG), ("user", LONG)], 3: [("user", "")]}
    assert got == brute_nodes(made)
    assert trie.trie(trie.rebuilt_paths(frame(spark, []))).collect() == []
    want = {c: t[zlib.crc32(str(c).encode()) % 4:] for c, t in made.items()}  # conversation 0 is absent
    assert sorted(map(tuple, trie.trie(trie.rebuilt_paths(frame(spark, rows))).collect())) == brute_nodes(want)


def cheapest(codes):
    """Cost and audit by a search over (cost, audit) in order."""
    heap, seen = [(0, "", 0, 0)], set()
    while True:
        cost, audit, i, q = heapq.heappop(heap)
        if (i, q) in seen:
            continue
        seen.add((i, q))
        if i == len(codes) and q in (0, 3):
            return cost, audit
        to = 3 if q == 2 else 2
        heapq.heappush(heap, (cost + 3, audit + "I", i, to))
        if i < len(codes):
            fault, initial = divmod(codes[i], 4)
            heapq.heappush(heap, (cost + 4, audit + "D", i + 1, q))
            if fault not in (1, 2):
                rest = 3 * (fault == 3)
                if initial == 1 and q == 0:
                    heapq.heappush(heap, (cost + rest, audit + "K", i + 1, 1))
                heapq.heappush(heap, (cost + rest, audit + "K", i + 1, to) if initial == to else (cost + rest + 3, audit + "R", i + 1, to))


def test_edits_are_the_cheapest_and_ascii_least():
    rng = random.Random(4)
    for _ in range(4000):
        codes = bytes(rng.choice([0, 1, 2, 3, 2, 3, 2, 3, 5, 6, 7, 10, 11, 13, 14, 15]) for _ in range(rng.randint(0, 18)))
        assert structure.edits(codes) == cheapest(codes)


SPACE = " \t\n\x0b\x0c\r"


def brute_repair(rows):
    """(turn, role, text) rows of a conversation after damage: the contract's columns."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, hashlib.md5(f"{len(r[1])}:{r[1]}{r[2]}".encode()).hexdigest()))
    seen, codes = set(), []
    for _, role, text in rows:
        visible = text.strip(SPACE)
        fault = 1 if not visible else 2 if (role, text) in seen else 3 if visible[-1] not in ".!?" else 0
        seen.add((role, text))
        codes.append(4 * fault + {"s": 1, "u": 2, "a": 3}.get(role[:1], 0))
    cost, audit = cheapest(codes)
    out, state, i = [], 0, 0
    for x in audit:
        if x == "D":
            i += 1
            continue
        to = 1 if x == "K" and state == 0 and rows[i][1][:1] == "s" else 3 if state == 2 else 2
        name = {1: "system", 2: "user", 3: "assistant"}[to]
        out.append(f"{name}:" if x == "I" else f"{rows[i][1] if x == 'K' else name}:{rows[i][2]}")
        state, i = to, i + (x != "I")
    turns = [t for t, _, _ in rows if t is not None]
    pairs = [(a[1][:1], b[1][:1]) for a, b in zip(rows, rows[1:])]
    faults = [c // 4 for c in codes]
    return (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, faults.count(1), faults.count(2), faults.count(3),
            sum(p not in (("s", "u"), ("u", "a"), ("a", "u")) for p in pairs), cost, audit, hashlib.sha256("\n".join(out).encode()).hexdigest())


def test_repair_equals_brute_force(spark, tmp_path):
    rng = random.Random(5)
    rows = []
    for c in [None, *range(150)]:
        for k in range(rng.randint(1, 14)):
            turn = None if rng.random() < 0.05 else k if rng.random() < 0.9 else rng.randint(0, 9)
            rows.append((c, turn, rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None]),
                         rng.choice(["Yes.", "No!", "what", "a. b", "Really?\n", "", " \n", None, "x" * 50, LONG + "."])))
    frame(spark, rows).write.parquet(f"{tmp_path}/conversations.parquet")
    got = {r.conv_id: tuple(r)[1:] for r in structure.query(spark, str(tmp_path)).collect()}
    damaged = defaultdict(list, {c: [] for c, *_ in rows})
    for c, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        k = zlib.crc32(f"{' ' if c is None else c}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if k == 1 else "".join(x for x in text if x not in ".!?") if k == 2 else text
        damaged[c] += [(turn, "user" if k == 4 else role, text)] * (0 if k == 0 else 2 if k == 3 else 1)
    assert got == {c: brute_repair(r) for c, r in damaged.items()}


def test_repaired_turns_and_empty_tables(spark, tmp_path):
    rows = frame(spark, [(1, 0, "user", "Hi."), (1, 1, "user", "Hi."), (1, 2, "tool", "Found it."), (2, 0, "assistant", "Done.")]).withColumn("dropped", F.lit(False))
    found = structure.audits(rows)
    assert [(r.conv_id, r.duplicate, r.cost, r.audit) for r in found.orderBy("conv_id").collect()] == [(1, 1, 7, "KDR"), (2, 0, 3, "IK")]
    got = [tuple(r) for r in structure.repaired(rows, found).orderBy("conv_id", "place").collect()]
    assert got == [(1, 0, "user", "Hi."), (1, 1, "assistant", "Found it."), (2, 0, "user", ""), (2, 1, "assistant", "Done.")]
    frame(spark, []).write.parquet(f"{tmp_path}/conversations.parquet")
    assert structure.query(spark, str(tmp_path)).collect() == []


def test_a_conversation_of_many_rows(spark):
    rng = random.Random(6)
    codes = bytes(rng.choice([2, 3, 2, 3, 14, 6, 0]) for _ in range(3000))
    cost, audit = structure.edits(codes)
    assert len(audit) - audit.count("I") == 3000 and 0 < cost < 4 * 3000
    assert structure.edits(codes[:30]) == cheapest(codes[:30])
