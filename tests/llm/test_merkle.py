import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from llm_helpers import ODD, documents

from marketgrain.llm import merkle


def digest(text):
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()


def leaf(values):
    return digest("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def climb(leaves):
    """All levels of a tree, the leaves first."""
    levels = [leaves]
    while len(levels[-1]) > 1:
        levels.append([digest("".join(levels[-1][k:k + 2])) for k in range(0, len(levels[-1]), 2)])
    return levels


def steps(levels, at):
    out = []
    for level in levels[:-1]:
        run = at ^ 1
        out.append((run < at, level[run]) if run < len(level) else None)
        at //= 2
    return out


def fold(start, path):
    for step in path:
        start = digest(start if step is None else step[1] + start if step[0] else start + step[1])
    return start


def brute(rows):
    """Rows are (doc_id, text, lang, source, n_chars)."""
    groups = defaultdict(list)
    for i, text, lang, source, n in rows:
        changed = None if i is None or zlib.crc32(str(i).encode()) % 7 else leaf(
            (i, source, lang, None if n is None else n + 1, text))
        groups[lang].append(((i is not None, i or 0, leaf((i, source, lang, n, text))), i, changed))
    order = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for lang in order:
        groups[lang].sort(key=lambda x: x[0])
        trees[lang] = climb([x[0][2] for x in groups[lang]])
    top = climb([trees[lang][-1][0] for lang in order])
    root, out = top[-1][0] if order else None, []
    for at_top, lang in enumerate(order):
        for at, (key, i, changed) in enumerate(groups[lang]):
            path = steps(trees[lang], at) + steps(top, at_top)
            folded = fold(changed or key[2], path)
            out.append((str(i), key[2], trees[lang][-1][0], root, digest("".join(s[1] for s in path if s)), folded, folded == root))
    return sorted(out)


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, hash string, height int, root string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, "y") for r in rows], SCHEMA)


def found(df):
    return sorted((str(r[0]), *r[1:]) for r in df.collect())


@pytest.mark.parametrize("levels", [1, 2, 8])
def test_manifest_equals_brute_force(spark, monkeypatch, levels):
    monkeypatch.setattr(merkle, "LEVELS", levels)
    draw = random.Random(levels)
    langs = [None, "", "de", "en", "en", "en", "é", "z", "😀"]
    rows = [(k, f"text {k}", draw.choice(langs), None if k % 5 == 0 else "s", None if k % 11 == 0 else k) for k in range(60)]
    rows += [(i, t, "odd", "s", 7) for i, t in ODD] + [(70, "same", "en", "s", 1)] * 3 + [(None, None, None, None, None)] * 2
    rows += [(80, "alone", "one", "s", 2), (2**62, "x", "en", "s", 2**63 - 1)]
    assert found(merkle.verify(frame(spark, rows))) == brute(rows)


def test_empty_and_single(spark):
    assert merkle.verify(frame(spark, [])).collect() == []
    rows = [(5, None, None, "s", 3)]
    assert found(merkle.verify(frame(spark, rows))) == brute(rows)


def test_any_changed_row_fails_and_only_that(spark):
    rows = [(k, "t", "en", "s", 1) for k in range(40)]
    verified = {r.doc_id: r.verified for r in merkle.verify(frame(spark, rows)).collect()}
    assert verified == {k: zlib.crc32(str(k).encode()) % 7 != 0 for k in range(40)}
