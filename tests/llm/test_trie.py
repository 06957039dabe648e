"""The prefix trie against a brute-force one: long conversations, copies, nulls, ties, absent bases, clashing columns."""

import hashlib
import random
import re
import zlib

import pytest

from tidemark.llm import trie


def rebuilt(rows):
    """{conv_id: [(role, text)]} by the same rules, one conversation after another."""
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn, role or "", text or ""))
    digest = lambda r, t: hashlib.sha256(f"{len(r)}:{r}:{t}".encode()).digest()[:16]
    for turns in own.values():
        turns.sort(key=lambda x: (x[0] is not None, x[0] or 0, digest(x[1], x[2])))
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (abs(c) % 20) * (1 if c >= 0 else -1)
        out[c] = [x[1:] for x in own.get(base, [])[:h] + turns[h:]]
    return out


def brute(rows):
    convs = rebuilt(rows)
    members, ends = {}, {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
        ends.setdefault(tuple(turns), []).append(c)
    words = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t))
    children = {}
    for p in members:
        if p:
            children.setdefault(p[:-1], []).append(p)
    leaves, saved = dict.fromkeys(members, 0), dict.fromkeys(members, 0)
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += p not in children
            saved[p[:d]] += (len(m) - 1) * words(p[-1][1]) if p else 0
    return sorted((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(children.get(p, [])), leaves[p], saved[p],
                   hashlib.sha256(",".join(map(str, sorted(ends.get(p, [])))).encode()).hexdigest()) for p, m in members.items())


def found(spark, rows, width=trie.WIDTH, extra=()):
    schema = "conv_id long, turn long, role string, text string" + "".join(f", {c} string" for c in extra)
    out = trie.trie(spark.createDataFrame([(*r, *("x",) * len(extra)) for r in rows], schema), width)
    assert out.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted(map(tuple, out.collect()))


def _rows(seed, convs, longest):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(-60, 200), convs) + [1000, 1003]:
        n = rng.choice([1, 2, 3, 5, longest, rng.randint(0, longest)])
        for t in range(n):
            rows.append((c, t, rng.choice(["user", "assistant", None]), rng.choice(["hi", "hi there", "", None, "a  b\tc"])))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("width, longest", [(2, 19), (8, 12)])
def test_trie_matches_brute_force(spark, width, longest):
    rows = _rows(3 + width, 30, longest)
    rows += [(7, None, "user", "first"), (7, 1, "user", "b"), (7, 1, "user", "a"), (7, 1, "user", "a"), (None, 0, "user", "of nobody")]
    assert found(spark, rows, width, ("key", "path", "t1")) == brute(rows)


def test_copies_of_a_long_conversation(spark):
    rows = [(c, t, "user", f"w{t % 3}") for c in range(2000, 2060) for t in range(21)]
    rows += [(c, 0, "user", "alone") for c in range(40)] + [(55555, 0, "user", "x")]
    assert found(spark, rows, 4) == brute(rows)


def test_ends_of_more_ids_than_a_chunk(spark, monkeypatch):
    monkeypatch.setattr(trie, "CHUNK", 7)
    rows = [(20 * c, 0, "user", "same") for c in range(40)]
    assert found(spark, rows) == brute(rows)


def test_no_conversations(spark):
    assert found(spark, []) == [] and found(spark, [(None, 1, "user", "x")]) == []
