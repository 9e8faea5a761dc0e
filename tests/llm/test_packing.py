from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from basketry.llm import packing as P


def slow_pack(sizes, costs):
    """The same rule without counts or sorted structures."""
    order = sorted(range(len(sizes)), key=lambda i: (-sizes[i], i))
    bins, where = [], {}
    for at, i in enumerate(order):
        size = sizes[i]
        fit = [(room, b) for b, (room, _) in enumerate(bins) if room >= size]
        if fit:
            b = min(fit)[1]
        else:
            rest = [sizes[j] for j in order[at + 1:]]

            def price(c):
                used = size
                for s in rest:
                    if used + s <= c:
                        used += s
                return costs[c] / used
            c = min((c for c in costs if c >= size), key=lambda c: (price(c), c))
            b = len(bins)
            bins.append((c, 0))
        bins[b] = (bins[b][0] - size, bins[b][1] + size)
        where[i] = b
    return [where[i] for i in range(len(sizes))], [
        (min((c for c in costs if c >= u), key=lambda c: (costs[c], c)), u) for _, u in bins]


@pytest.mark.parametrize("seed", range(12))
def test_block_matches_plain_version(seed):
    rng = np.random.default_rng(seed)
    sizes = rng.integers(1, 41, rng.integers(0, 60))
    costs = P.bin_costs((10, 25, 40), float(rng.integers(0, 12)))
    where, offset, bins = P.pack_block(sizes, costs)
    assert (where.tolist(), bins) == slow_pack(sizes.tolist(), costs)


def test_every_token_once_and_bins_are_tight(spark):
    rng = np.random.default_rng(3)
    rows = [(i, int(n), "x") for i, n in enumerate(rng.integers(0, 300, 500))]
    rows += [(900, 5000, "x"), (901, None, "x"), (None, 7, "x"), (None, 7, "x"), (902, 100, "x")]
    df = spark.createDataFrame(rows, "doc_id long, n long, bin_id string")
    got = P.best_fit_pack(df, F.col("n"), lengths=(100, 150, 400), overhead=4, block=64).collect()
    total, bins = defaultdict(int), defaultdict(list)
    for r in got:
        total[r.doc_id] += r.n_tokens
        bins[r.bin_id].append(r)
    want = defaultdict(int)
    for d, n, _ in rows:
        if n:
            want[d] += n
    assert dict(total) == dict(want)
    assert sorted((r.piece, r.first_token, r.n_tokens) for r in got if r.doc_id == 900)[:2] == [
        (0, 0, 400), (1, 400, 400)]
    for b in bins.values():
        spans = sorted((r.bin_offset, r.bin_offset + r.n_tokens) for r in b)
        assert spans[0][0] == 0 and all(x[1] == y[0] for x, y in zip(spans, spans[1:]))
        assert spans[-1][1] == b[0].bin_used <= b[0].bin_capacity
        assert b[0].bin_capacity == min(c for c in (100, 150, 400) if c >= b[0].bin_used)
    waste = 1 - sum(total.values()) / sum(b[0].bin_capacity for b in bins.values())
    assert waste < 0.05


def test_tokens_of_texts(spark):
    df = spark.createDataFrame([(None,), ("",), (" a\tb\x0bc ",)], "text string")
    assert [r[0] for r in df.select(P.word_tokens(F.col("text"))).collect()] == [1, 1, 4]


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, n long")
    assert P.best_fit_pack(df, F.col("n")).count() == 0


def test_text_ids_and_clashing_columns(spark):
    df = spark.createDataFrame([("a", "one two", 1, "x"), ("b", "three", 2, "y"), (None, None, 3, "z")],
                               "doc_id string, text string, slot int, bin_id string")
    got = P.best_fit_pack(df, P.word_tokens(F.col("text"))).collect()
    assert sorted(((r.doc_id, r.n_tokens) for r in got), key=str) == [("a", 3), ("b", 2), (None, 1)]
