import numpy as np
import xxhash

from basketry.llm import simhash as S
from basketry.llm.components import connected_components


def slow_fingerprint(text, k=4):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    n = max(1, len(words) - k + 1)
    hs = [xxhash.xxh64_intdigest(b" ".join(words[i:i + k]), 42) for i in range(n)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def slow_components(rows):
    fp = [slow_fingerprint(t) for _, t in rows]
    comp = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if (fp[i] ^ fp[j]).bit_count() <= 4 and comp[i] != comp[j]:
                old, new = comp[i], comp[j]
                comp = [new if c == old else c for c in comp]
    least = {}
    for (d, _), c in zip(rows, comp):
        least[c] = min(least.get(c, d), d)
    return [(d, f"{f:016x}", least[c]) for (d, _), f, c in zip(rows, fp, comp)]


def test_fingerprint_matches_definition():
    for t in (None, "", "  \n", "One", "a b c", "A b C d", "the cat " * 50, "ünï Ä b c d e\x0bf"):
        assert S.fingerprint(t, 4) == slow_fingerprint(t)


def test_components_match_brute_force(spark):
    rng = np.random.default_rng(1)
    base = [" ".join(rng.choice(["ab", "cd", "ef", "gh", "ij"], 60)) for _ in range(12)]
    rows = [(i, b) for i, b in enumerate(base)]
    rows += [(100 + i, " ".join(base[i % 12].split()[:59] + ["zz"])) for i in range(24)]
    rows += [(200, None), (201, ""), (202, "\t"), (203, base[0]), (204, base[0].upper())]
    df = spark.createDataFrame([(d, t, "x") for d, t in rows], "doc_id long, text string, fp string")
    got = S.simhash_components(df).collect()
    assert sorted((r.doc_id, r.fingerprint, r.component_id) for r in got) == sorted(
        slow_components(rows))
    kept = [r for r in got if r.kept]
    assert len(kept) == len({r.component_id for r in got})
    assert all(r.doc_id == r.component_id for r in kept)


def test_all_pairs_found_with_small_cells(spark):
    rng = np.random.default_rng(2)
    centre = rng.integers(0, 2**63, 30, dtype=np.uint64)
    flips = [int(c) ^ sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 6), False))
             for c in centre for _ in range(20)]
    fp = np.unique(np.array(flips, dtype=np.uint64))
    want = {tuple(sorted((int(np.int64(a.view(np.int64))), int(b.view(np.int64)))))
            for i, a in enumerate(fp) for b in fp[:i] if np.bitwise_count(a ^ b) <= 4}
    df = spark.createDataFrame([(int(x),) for x in fp.view(np.int64)], "fp long")
    for per_cell in (4, 60, 10_000):
        got = [tuple(sorted((r.a, r.b))) for r in S.near_pairs(df, 4, per_cell=per_cell).collect()]
        assert len(got) == len(set(got)) and set(got) == want


def test_components_of_chain_star_and_loops(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(30)] + [(7, 7), (500, 501)]
    df = spark.createDataFrame(edges, "x long, y long")
    got = {r.node: r.root for r in connected_components(df).collect()}
    want = {i: 0 for i in range(1, 41)} | {100 + i: 100 for i in range(1, 30)} | {501: 500}
    assert got == want


def test_empty_table_and_null_ids(spark):
    schema = "doc_id long, text string"
    assert S.simhash_components(spark.createDataFrame([], schema)).count() == 0
    got = S.simhash_components(spark.createDataFrame([(None, "a b c d e"), (None, "a b c d e"), (3, "a b c d e")], schema)).collect()
    assert {r.component_id for r in got} == {3} and sum(r.kept for r in got) == 1
