"""Skewed input: one customer holds a third of all rows. Results must equal a
plain pandas computation (correctness of the skew-safe plan shapes)."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest

from basketry.operators import aggregates as A
from basketry.operators import windows as Wn


@pytest.fixture(scope="module")
def skewed(spark):
    rng = np.random.default_rng(11)
    n = 3000
    cust = np.where(np.arange(n) < n // 3, 1, rng.integers(2, 200, n))
    days = rng.integers(0, 120, n)
    pdf = pd.DataFrame({
        "customer_id": cust.astype("int64"),
        "transaction_id": np.arange(n, dtype="int64"),
        "transaction_date": [dt.date(2021, 1, 1) + dt.timedelta(days=int(d)) for d in days],
        "product_category": rng.choice(["A", "B", "C", "D"], n),
        "quantity": rng.integers(1, 10, n).astype(float),
        "total_sales": rng.integers(100, 10000, n) / 100.0,
    })
    return pdf, spark.createDataFrame(pdf).repartition(7)


def test_days_between_under_skew(skewed):
    pdf, df = skewed
    got = {r.transaction_id: r.days_between_purchases for r in Wn.days_between_purchases(df).collect()}
    p = pdf.sort_values(["customer_id", "transaction_date", "transaction_id"])
    first = ~p.duplicated(["customer_id", "transaction_date"])
    dd = p[first].copy()
    dd["prev"] = dd.groupby("customer_id")["transaction_date"].shift(1)
    gap = {t: (0 if pd.isna(pv) else (d - pv).days)
           for t, d, pv in zip(dd.transaction_id, dd.transaction_date, dd.prev)}
    want = {t: gap.get(t, 0) for t in p.transaction_id}
    assert got == want


def test_variety_and_rfm_under_skew(skewed):
    pdf, df = skewed
    v = {r.transaction_id: r.product_variety for r in A.category_variety(df).collect()}
    nun = pdf.groupby("customer_id")["product_category"].nunique()
    assert v == {t: nun[c] for t, c in zip(pdf.transaction_id, pdf.customer_id)}
    r = {x.customer_id: x for x in A.rfm(df).collect()}
    g = pdf.groupby("customer_id")
    assert r[1].frequency == g.size()[1] == 1000
    assert r[1].monetary == pytest.approx(g["total_sales"].sum()[1])
    assert r[1].recency == (pdf.transaction_date.max() - g["transaction_date"].max()[1]).days


def test_frequency_encoding_under_skew(skewed):
    pdf, df = skewed
    got = {r.transaction_id: r.customer_id_freq
           for r in A.frequency_encode(df, "customer_id").collect()}
    share = pdf.customer_id.map(pdf.customer_id.value_counts(normalize=True))
    assert got[0] == pytest.approx(1 / 3)
    for t, s in zip(pdf.transaction_id, share):
        assert got[t] == pytest.approx(s)
