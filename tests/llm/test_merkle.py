import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from basketry.llm import merkle as M

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row):
    return digest("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def tree(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([digest("".join(last[i:i + 3])) for i in range(0, len(last), 3)])
    return levels


def steps(levels, at):
    for nodes in levels[:-1]:
        first = at // 3 * 3
        yield "".join(nodes[first:at]), "".join(nodes[at + 1:first + 3])
        at //= 3


def brute(rows, changed):
    """The rows of the manifest; ``changed`` maps a row to the row as met later."""
    sources = {}
    for r in rows:
        sources.setdefault(r[1], []).append(r)
    order = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in order:
        sources[s].sort(key=lambda r: (r[0] is not None, r[0] if r[0] is not None else 0, leaf(r)))
        trees[s] = tree([leaf(r) for r in sources[s]])
    top = tree([trees[s][-1][0] for s in order])
    out = []
    for place, s in enumerate(order):
        for at, r in enumerate(sources[s]):
            way = [*steps(trees[s], at), *steps(top, place)]
            value = leaf(changed(r))
            for a, b in way:
                value = digest(a + value + b)
            out.append((r[0], leaf(r), trees[s][-1][0], top[-1][0], digest("".join(a + b for a, b in way)),
                        value, value == top[-1][0]))
    return sorted(out, key=str)


def check(spark, rows, schema=SCHEMA, **kw):
    docs = spark.createDataFrame(rows, schema).repartition(3)
    found = {"text": F.translate("text", "\n", "")}
    got = sorted((tuple(r) for r in M.merkle_manifest(docs, found, **kw).collect()), key=str)
    want = brute([tuple(r[:5]) for r in rows],
                 lambda r: (*r[:4], r[4] and r[4].replace("\n", "")))
    assert got == want


def test_states_give_the_standard_digests():
    rng = np.random.default_rng(0)
    raw = rng.integers(0, 256, (5000, 32)).astype(np.uint8)
    state = np.repeat(M.START[None], len(raw), axis=0)
    for _ in range(2):
        state = M.compress(state, M.hex_block(raw))
    got = M.finish(state, np.full(len(raw), 2))
    for i in (0, 1, 4095, 4096, 4999):
        assert got[i].tobytes().hex() == digest(raw[i].tobytes().hex() * 2)


@pytest.mark.parametrize("levels", [1, 2, 6])
def test_matches_brute_force(spark, levels):
    rng = np.random.default_rng(1)
    sizes = {"hot": 130, "nine": 9, "ten": 10, "one": 1, "two": 2, "é": 4, "": 3, None: 5, "e": 1}
    rows, n = [], 0
    for s, size in sizes.items():
        for _ in range(size):
            rows.append((n, s, None if n % 7 == 0 else "en", None if n % 5 == 0 else n,
                         None if n % 11 == 0 else "a\nb" if rng.random() < 0.5 else f"té{n}"))
            n += 1
    rows += [rows[3], rows[3], (None, "hot", "en", 1, "x"), (None, None, None, None, None)]
    check(spark, rows, levels=levels)


def test_one_leaf_and_empty_table(spark):
    check(spark, [(1, "s", "en", 3, "a\nb")])
    assert M.merkle_manifest(spark.createDataFrame([], SCHEMA)).count() == 0


def test_text_ids_and_clashing_columns(spark):
    rows = [(f"id{i}", "s" if i % 3 else None, "en", i, f"t\n{i}", 1, "z", 2) for i in range(40)]
    check(spark, rows, "doc_id string, source string, lang string, n_chars long, text string, "
                       "key int, digest string, idx int")


def test_very_long_text(spark):
    check(spark, [(1, "s", "en", 1, "long text\n" * 300_000), (2, "s", "en", 1, "x")])


def test_only_what_is_right_of_a_leaf_is_hashed_again():
    """A parent's kept states are those of its children to the left."""
    rng = np.random.default_rng(2)
    leaves = rng.integers(0, 256, (3, 32)).astype(np.uint8)
    top, [(_, _, kept)] = M.grow(leaves, np.array([3]), np.array([1]))
    state = M.compress(kept[:, 2], M.hex_block(leaves[2:]))
    assert M.finish(state, np.array([3])).tobytes() == top.tobytes()
