"""Random lines with gaps, returns, ties and a hot group against plain Python."""

import datetime as dt
import random
from collections import defaultdict
from decimal import ROUND_HALF_UP

import pytest

from frames import D, bronze
from tillworks.operators import customer_marts as CM
from tillworks.operators import sales_marts as SM
from tillworks.operators import silver as S

CENT = D("0.01")


def lines(seed, n=600):
    r = random.Random(seed)
    codes = ["A1", "B2", "POST", "M", "C2", "z9", "GONE"]
    texts = {c: [None] if c == "GONE" else [f"{c} x", f"{c} X", None] for c in codes}
    out = []
    for i in range(n):
        code = "A1" if i % 3 == 0 else r.choice(codes)  # a third of all lines
        out.append((
            str(r.randrange(n // 4)), code, r.choice(texts[code]), r.randrange(-3, 8),
            dt.datetime(2010, 11, 1) + dt.timedelta(hours=r.randrange(24 * 100)),
            r.choice([0, 0.5, 1.25, 3.1, 999.99]), r.choice([None, "", "x", "7.0", "12.0", "12", "30.5"]),
            r.choice(["UK", "France", None]),
        ))
    return out


def customer(text):
    try:
        return int((text or "").split(".")[0])
    except ValueError:
        return -1


def python_fact(data):
    names = defaultdict(set)
    for _, code, text, *_ in data:
        if text is not None:
            names[code].add(text)
    ids = {c: i + 1 for i, c in enumerate(sorted(names))}
    groups = defaultdict(list)
    for row in data:
        inv, code, _, q, at, price, cust, country = row
        if q > 0 and price >= 0 and country is not None and code in ids:
            groups[at.date(), ids[code], country].append((inv, q, D(str(price)), customer(cust)))
    fact = {}
    for (d, p, c), g in groups.items():
        mean = sum(x[2] for x in g) / len(g)
        fact[d.year * 10000 + d.month * 100 + d.day, p, c] = (
            max(x[3] for x in g), len({x[0] for x in g}), sum(x[1] for x in g),
            sum(x[1] * x[2] for x in g).quantize(CENT), mean.quantize(D("0.000001"), ROUND_HALF_UP),
        )
    return ids, {c: min(t) for c, t in names.items()}, fact


@pytest.mark.parametrize("seed", [1, 2])
def test_silver_and_marts(spark, seed):
    data = lines(seed)
    frame = bronze(spark, data)
    dates, products = S.dim_date(frame), S.dim_product(frame).cache()
    fact = S.fact_sales_daily(frame, dates, products).cache()
    ids, names, want = python_fact(data)

    assert {r["stock_code"]: (r["product_id"], r["description"]) for r in products.collect()} == {
        c: (i, names[c]) for c, i in ids.items()
    }
    assert {tuple(r)[:3]: tuple(r)[3:8] for r in fact.collect()} == want

    months = defaultdict(list)
    for (day, p, c), v in want.items():
        months[day // 10000, day // 100 % 100].append((p, c, *v))
    got = {(r["year"], r["month"]): r for r in SM.sales_monthly(fact, dates).collect()}
    assert set(got) == set(months)
    for key, g in months.items():
        revenue, tx = sum(x[5] for x in g), sum(x[3] for x in g)
        assert got[key]["total_revenue"] == revenue
        assert got[key]["unique_customers"] == len({x[2] for x in g} - {-1})
        assert got[key]["avg_revenue_per_transaction"] == (revenue / tx).quantize(CENT, ROUND_HALF_UP)

    buyers = defaultdict(list)
    for (day, p, c), v in want.items():
        if v[0] != -1:
            buyers[v[0]].append((dt.date(day // 10000, day // 100 % 100, day % 100), p, c, *v[1:]))
    clv = CM.customer_lifetime_value(fact, dates, products, "2011-03-01")
    got = {r["customer_id"]: r for r in clv.collect()}
    assert set(got) == set(buyers)
    code_of = {i: c for c, i in ids.items()}
    for who, g in buyers.items():
        r, days = got[who], {x[0] for x in g}
        spend = defaultdict(D)
        for x in g:
            spend[x[2]] += x[5]
        assert r["country"] == min(spend, key=lambda c: (-spend[c], c))
        assert r["total_purchase_days"] == len(days)
        assert r["total_product_purchases"] == len({(x[0], x[1]) for x in g})
        assert r["unique_products_purchased"] == len({x[1] for x in g})
        labels = {"POST": "Postage", "M": "Manual", "C2": "Carriage"}
        assert r["unique_categories_purchased"] == len({labels.get(code_of[x[1]], "General") for x in g})
        assert r["total_lifetime_value"] == sum(x[5] for x in g)
        assert r["customer_lifespan_days"] == (max(days) - min(days)).days
        assert abs(r["avg_daily_revenue"] - sum(x[5] for x in g) / len(g)) < D("1e-9")

    affinity = CM.customer_product_affinity(fact, products, dates, "2011-03-01")
    got = {(r["customer_id"], r["product_id"]): r for r in affinity.collect()}
    for who, g in buyers.items():
        per = defaultdict(list)
        for x in g:
            per[x[1]].append(x)
        sums = {p: sum(x[5] for x in xs) for p, xs in per.items()}
        times = {p: len({x[0] for x in xs}) for p, xs in per.items()}
        by_sum = sorted(per, key=lambda p: (-sums[p], p))
        by_times = sorted(per, key=lambda p: (-times[p], p))
        for p in per:
            r = got[who, p]
            assert (r["total_product_revenue"], r["times_purchased"]) == (sums[p], times[p])
            assert r["product_rank_by_revenue"] == by_sum.index(p) + 1
            assert r["product_rank_by_frequency"] == by_times.index(p) + 1
    assert len(got) == sum(len({x[1] for x in g}) for g in buyers.values())


def test_monthly_activity(spark):
    data = lines(3)
    frame = bronze(spark, data)
    dates, products = S.dim_date(frame), S.dim_product(frame)
    fact = S.fact_sales_daily(frame, dates, products).cache()
    _, _, want = python_fact(data)
    groups = defaultdict(list)
    for (day, p, c), v in want.items():
        if v[0] != -1:
            groups[v[0], c, day // 10000, day // 100 % 100].append((day, p, *v[1:]))
    got = {tuple(r)[:4]: r for r in CM.customer_monthly_activity(fact, dates).collect()}
    assert set(got) == set(groups)
    previous = {}
    for who, country, year, month in sorted(groups, key=lambda k: (k[0], k[2], k[3], k[1])):
        g, r = groups[who, country, year, month], got[who, country, year, month]
        revenue = sum(x[4] for x in g)
        assert (r["purchase_days_in_month"], r["unique_products"]) == (
            len({x[0] for x in g}), len({x[1] for x in g})
        )
        assert r["monthly_revenue"] == revenue
        before, tenure = previous.get(who, (None, 0))
        assert r["prev_month_revenue"] == before and r["customer_tenure_months"] == tenure + 1
        assert r["is_first_month"] == (tenure == 0)
        previous[who] = (revenue, tenure + 1)


