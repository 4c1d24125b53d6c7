import hashlib
import random
import zlib

import pytest

from marketgrain.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, depth long, words int, kind string"


def name(role, text):
    role, text = role or "", text or ""
    return hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()


def brute(rows):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append(((turn is not None, turn or 0, name(role, text)), (role or "", text or "")))
    own = {c: [t for _, t in sorted(turns)] for c, turns in own.items()}
    members, ends = {}, {}
    for c, turns in own.items():
        base, h = c - int(c / 20) * 20 if c < 0 else c % 20, zlib.crc32(str(c).encode()) % 4
        whole = own.get(c - base, [])[:h] + turns[h:]
        for d in range(len(whole) + 1):
            members.setdefault(tuple(whole[:d]), []).append(c)
        ends.setdefault(tuple(whole), []).append(c)
    out = []
    for node, convs in members.items():
        under = [n for n in members if n[:len(node)] == node]
        kids = [n for n in under if len(n) == len(node) + 1]
        leaves = sum(not any(m[:len(n)] == n and len(m) > len(n) for m in members) for n in under)
        saved = sum((len(members[n]) - 1) * len(n[-1][1].encode().split()) for n in under if n)
        text = ",".join(map(str, sorted(ends.get(node, []))))
        out.append((min(convs), len(node), str(min(members[node[:-1]]) if node else None), len(convs), len(kids), leaves, saved,
                    hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out)


def found(df):
    return sorted((r[0], r[1], str(r[2]), *r[3:]) for r in df.collect())


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, "k") for r in rows], SCHEMA)


def conversations(seed, convs, deep):
    draw = random.Random(seed)
    turns = [("user", "hi"), ("user", "hi there  you"), ("bot", "a b c"), (None, None), ("", ""), ("u", "ser hi"), ("bot", "é\x0b日")]
    rows = []
    for c in range(-45, convs - 45):
        common = c % 3 == 0
        for k in range(2 if common else draw.randrange(1, deep)):
            rows.append((c, draw.choice([None, k, k, 1]), *(turns[k] if common else draw.choice(turns))))
    rows += [(None, 1, "user", "lost"), (7, 7, "user", "long " * 3000), (7, 7, "user", "long " * 3000)]
    draw.shuffle(rows)
    return rows


@pytest.mark.parametrize("cells,least,final", [(1 << 20, 16, 1 << 20), (12, 3, 1 << 20), (12, 3, 24), (40, 4, 60)])
def test_trie_equals_brute_force(spark, monkeypatch, cells, least, final):
    """Also with blocks of few rows, and with several rounds of paths."""
    monkeypatch.setattr(prefix_trie, "CELLS", cells)
    monkeypatch.setattr(prefix_trie, "LEAST_ROWS", least)
    rows = conversations(cells, 130, 6)
    with prefix_trie.scratch(spark):
        got = found(prefix_trie.trie(prefix_trie.rebuilt(frame(spark, rows)), final))
    assert got == brute(rows)


def test_odd_tables(spark):
    assert prefix_trie.prefix_trie(frame(spark, [])).collect() == []
    assert prefix_trie.prefix_trie(frame(spark, [(None, 1, "a", "b")])).collect() == []
    # only the first conversation of its twenty lends, so a short one without it has no turns
    rows = [(c, 0, "user", "only") for c in range(41, 60)]
    assert found(prefix_trie.prefix_trie(frame(spark, rows))) == brute(rows)
