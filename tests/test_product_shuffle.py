"""The product dimension shuffles lines once for its figures; hot products are dealt out."""

from conftest import NOON, line, lines_frame

from tillspark.operators import star


def test_hot_products_and_lines_without_a_code(spark, folder):
    made = [line(str(n % 40), "HOT", "A" if n % 3 else "B", float(n), price=1.25 + n) for n in range(200)]
    made += [line(str(n % 4), f"P{n % 5}", None, 2.0, price=None if n % 2 else 0.5) for n in range(20)]
    made += [line("1", None), line("1", None, price=2.0), line("2", None), line(None, "P1")]
    lines_frame(spark, made).write.parquet(f"{folder}/lines")
    clean = spark.read.parquet(f"{folder}/lines")
    want = {}
    for invoice, stock, _, quantity, _, price, *_ in made:
        at = want.setdefault(stock, [set(), 0.0, 0.0, []])
        at[0] |= {invoice} - {None}
        at[1] += quantity
        if price is not None:
            at[2] += quantity * price
            at[3].append(price)
    for slots in (2, 2_000):
        found = {r["stock_code"]: r for r in star.dim_product(clean, slots).collect()}
        assert found.keys() == want.keys()
        for code, (invoices, units, revenue, prices) in want.items():
            row = found[code]
            assert (row["n_invoices"], row["units_sold"]) == (len(invoices), units)
            assert abs((row["revenue"] or 0) - revenue) < 1e-6
            assert (row["avg_unit_price"] is None) == (not prices)
            if prices:
                assert abs(row["avg_unit_price"] - sum(prices) / len(prices)) < 1e-6
    assert found["HOT"]["description"] == "A" and NOON


def test_figures_are_not_shuffled_by_product_and_invoice(spark):
    clean = lines_frame(spark, [line("1", "A"), line("2", "B")])
    plan = star.dim_product(clean)._jdf.queryExecution().executedPlan().toString()
    moves = [at for at in plan.splitlines() if "Exchange hashpartitioning" in at]
    # Only invoices of hot products are, which are filtered before.
    assert sum("stock_code" in at and "invoice_no" in at for at in moves) == 0
