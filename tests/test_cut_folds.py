"""All report cuts: one shuffle of lines by invoice, hot invoices folded before they move."""

from datetime import datetime

from pyspark.sql import functions as F

from tillspark.operators import measures


def _model(spark, folder):
    day = datetime(2020, 1, 5)
    made = [(str(n % 9) if n % 5 else "HOT", day, n % 7 + 1 if n % 8 else -1, n % 4 + 1, n % 3 + 1, n, 1.5, n * 1.5)
            for n in range(300)] + [(None, day, 1, 1, 1, 2, 1.0, 2.0)]
    spark.createDataFrame(
        made, "InvoiceNo string, Date timestamp_ntz, ProductKey long, CustomerKey long, CountryKey long, "
        "Quantity long, UnitPrice double, Revenue double"
    ).write.parquet(f"{folder}/fact")
    dim = lambda key, n, col: spark.range(1, n).select(
        F.col("id").alias(key), F.concat(F.lit("m"), F.col("id") % 3).alias(col))
    return {
        "fact_sales": spark.read.parquet(f"{folder}/fact"), "dim_product": dim("ProductKey", 9, "PriceBand"),
        "dim_customer": dim("CustomerKey", 6, "CustomerSegment"), "dim_country": dim("CountryKey", 5, "Region"),
        "dim_date": spark.sql("select timestamp_ntz'2020-01-05' as Date, '2020-01' as YearMonth"),
    }


def test_cuts_equal_the_measures_of_each(spark, folder):
    model = _model(spark, folder)
    cuts = ("YearMonth", "Region", "CustomerSegment", "PriceBand")
    found = measures.report_cuts(model, *cuts)
    plan = found._jdf.queryExecution().executedPlan().toString()
    # Of customers and products only: the sums and orders met all cuts before they moved.
    assert plan.count("Expand") <= 2
    got = {(r["cut"], r["member"]): r for r in found.collect()}
    want = {}
    for cut in cuts:
        want |= {(cut, r[cut]): r for r in measures.sales_by(model, cut).collect()}
    want["", None] = measures.sales_by(model).first()
    assert got.keys() == want.keys()
    for at, row in want.items():
        assert all(got[at][c] == row[c] for c in ("revenue", "units_sold", "orders", "sales_lines", "customers", "products_sold"))
