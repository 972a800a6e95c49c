"""Flat sales file to star schema and back, on a hand-made file."""

from datetime import date
from decimal import Decimal

import pytest
from conftest import rows
from pyspark.sql import functions as F

from saleswh.plans import reports, star
from saleswh.schemas import SCHEMAS
from saleswh.sources import read_sales_csv
from saleswh.storage import new_path

HEADER = ",".join(SCHEMAS["sales_file"].names) + ",STATUS"


def line(no, line_no, qty, price, day, year, month, product, plain, customer, state="", territory="EMEA", size="Small"):
    sales = Decimal(price) * qty
    code, prod_line, msrp = product
    return ",".join(
        str(v)
        for v in (
            no, qty, price, line_no, sales, f"{month}/{day}/{year} 0:00", (month - 1) // 3 + 1, month, year,
            prod_line, msrp, code, customer, "555-1", '"1, Main St"', "", "Lyon", state, "", plain, territory,
            "Meyer", "Zoé", size, "Shipped",
        )
    )


CAR, VAN, BUS = ("S10", "Cars", 95), ("S20", "Vans", 60), ("S30", "Cars", "120.50")
LINES = [
    line(1, 1, 10, "50.25", 24, 2003, 2, CAR, "France", "Café Rouge"),
    line(1, 2, 5, "20.00", 24, 2003, 2, VAN, "France", "Café Rouge"),
    line(2, 1, 20, "80.00", 7, 2004, 5, CAR, "France", "Café Rouge", size="Medium"),
    line(3, 1, 8, "60.00", 7, 2004, 5, BUS, "USA", "Auto Inc", state="NY", territory="NA"),
    line(4, 1, 24, "20.00", 1, 2005, 1, BUS, "USA", "Auto Inc", state="NY", territory="NA"),
    line(5, 1, 1, "480.00", 3, 2005, 1, VAN, "Japan", "Tokyo Toys", territory="Japan"),
]


@pytest.fixture(scope="module")
def flat(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("sales") / "sales.csv"
    path.write_bytes("\n".join([HEADER, *LINES]).encode("latin-1"))
    return read_sales_csv(spark, str(path))


@pytest.fixture(scope="module")
def built(spark, flat):
    return star.run_star_etl(flat, new_path(spark, "test-star"))


def test_sales_file(flat):
    assert flat.schema == SCHEMAS["sales_file"]
    assert rows(flat.select("CUSTOMERNAME").distinct()) == [("Auto Inc",), ("Café Rouge",), ("Tokyo Toys",)]
    assert rows(flat.select("TERRITORY").distinct()) == [("EMEA",), ("Japan",), (None,)]
    assert rows(flat.select(F.to_date("ORDERDATE")).distinct())[0] == (date(2003, 2, 24),)
    assert flat.filter("ADDRESSLINE1 = '1, Main St' AND POSTALCODE IS NULL").count() == len(LINES)


def test_missing_tokens_are_a_choice(spark, tmp_path):
    path = tmp_path / "sales.csv"
    path.write_bytes("\n".join([HEADER, *LINES]).encode("latin-1"))
    kept = read_sales_csv(spark, str(path), missing=[""])
    assert kept.filter("TERRITORY = 'NA'").count() == 2


def test_malformed_number_is_an_error(spark, tmp_path):
    path = tmp_path / "sales.csv"
    path.write_text("\n".join([HEADER, LINES[0].replace("50.25", "cheap")]))
    with pytest.raises(Exception, match="CAST_INVALID_INPUT|cheap"):
        read_sales_csv(spark, str(path)).collect()


def test_dimensions(built):
    assert rows(built.product) == [
        (1, "S10", "Cars", Decimal("95.00")),
        (2, "S20", "Vans", Decimal("60.00")),
        (3, "S30", "Cars", Decimal("120.50")),
    ]
    assert built.customer.schema.names == SCHEMAS["dim_customer"].names
    assert rows(built.customer.select("customer_key", "customer_name", "state", "territory")) == [
        (1, "Auto Inc", "NY", None),
        (2, "Café Rouge", None, "EMEA"),
        (3, "Tokyo Toys", None, "Japan"),
    ]
    assert built.date.schema.names == SCHEMAS["dim_date"].names
    first = built.date.filter("date_key = 1").collect()[0]
    assert tuple(first) == (1, date(2003, 2, 24), 1, 2, 2003, "February", 24, "Monday")


def test_every_flat_row_finds_its_keys(built):
    """Null state, territory and postal code still match their dimension row."""
    assert built.fact.schema.names == SCHEMAS["fact_sales"].names
    assert built.fact.count() == len(LINES)
    assert rows(built.fact.select("order_number", "order_line_number", "product_key", "customer_key", "date_key"))[:3] == [
        (1, 1, 1, 2, 1), (1, 2, 2, 2, 1), (2, 1, 1, 2, 2)
    ]


def test_round_trip(flat, built):
    wide = built.flat()
    assert len(wide.columns) == 20
    want = flat.select("ORDERNUMBER", "SALES", "PRODUCTCODE", "CUSTOMERNAME", F.to_date("ORDERDATE"), "STATE")
    got = wide.select("order_number", "sales", "product_code", "customer_name", "order_date", "state")
    assert rows(got) == rows(want)
    assert [r.order_date.year for r in star.sorted_flat(built).collect()] == [2003, 2003, 2004, 2004, 2005, 2005]


def test_narrow_flat_equals_wide_flat(built, spark):
    """Leaving dimensions out of the join changes no row, also with null keys in the fact."""
    odd = built.fact.limit(1).withColumn("customer_key", F.lit(None).cast("bigint"))
    loose = star.Star(built.fact.unionByName(odd), built.product, built.customer, built.date)
    for cols in (["sales"], ["product_line", "sales"], ["country", "year_id"], ["month_name", "msrp"]):
        assert rows(loose.flat(cols)) == rows(loose.flat().select(*cols))


def test_reports_agree_on_star_and_flat(built):
    wide = built.flat()
    for a, b in (
        (reports.revenue_by_country(built), reports.revenue_by_country_flat(wide)),
        (reports.top_product_lines(built), reports.top_product_lines_flat(wide)),
        (reports.monthly_sales(built), reports.monthly_sales_flat(wide)),
    ):
        assert [tuple(r) for r in a.collect()] == [tuple(r) for r in b.collect()]
    totals = [(r.country, float(r.total_sales)) for r in reports.revenue_by_country(built).collect()]
    assert totals == [("France", 2202.5), ("USA", 960.0), ("Japan", 480.0)]
    months = [tuple(r)[:3] for r in reports.monthly_sales(built).collect()]
    assert months == [(2003, 2, "February"), (2004, 5, "May"), (2005, 1, "January")]


def test_views_answer_sql(spark, built):
    reports.register_views(spark, built)
    got = spark.sql("SELECT YEAR_ID, MONTH_ID, SUM(SALES) AS s FROM sales_data GROUP BY YEAR_ID, MONTH_ID")
    assert got.count() == 3
    joined = spark.sql(
        "SELECT c.country, SUM(f.sales) AS s FROM fact_sales f JOIN dim_customer c "
        "ON f.customer_key = c.customer_key GROUP BY c.country"
    )
    assert joined.count() == 3


def _shuffled(df) -> int:
    """Bytes that the exchanges of a finished query have written."""
    df.write.format("noop").mode("overwrite").save()
    total, todo = 0, [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            todo.append(node.executedPlan())
        elif "QueryStage" in name:
            todo.append(node.plan())
        else:
            if name == "Exchange":
                total += node.metrics().apply("dataSize").value()
            todo += [node.children().apply(i) for i in range(node.children().size())]
    return total


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", -1)
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def _by_natural_keys(flat, built):
    """The plain way: three joins on all natural columns."""
    out = flat.withColumn("ORDERDATE", F.to_date("ORDERDATE"))
    for dim, columns, key in (
        (built.date, star.DATE_COLUMNS, "date_key"), (built.product, star.PRODUCT_COLUMNS, "product_key"), (built.customer, star.CUSTOMER_COLUMNS, "customer_key")
    ):
        side = dim.select(F.col(key), *[F.col(c).alias(f"_d_{c}") for c in columns.values()])
        same = [out[src].eqNullSafe(F.col(f"_d_{c}")) for src, c in columns.items()]
        out = out.join(side, same).drop(*[f"_d_{c}" for c in columns.values()])
    return out.select(*[F.col(src).alias(dst) for src, dst in star.FACT_COLUMNS.items()])


@pytest.fixture(scope="module")
def many(spark, flat, built):
    """The hand-made rows often, one customer with most of them."""
    times = F.when(F.col("CUSTOMERNAME") == "Café Rouge", 900).otherwise(200)
    return flat.withColumn("_n", F.explode(F.sequence(F.lit(1), times))).drop("_n").repartition(4)


@pytest.mark.parametrize("covered", [False, True])
def test_lookup_by_hash(spark, many, built, covered, no_broadcast):
    got = star.build_fact(many, built.product, built.customer, built.date, covered)
    assert rows(got) == rows(_by_natural_keys(many, built))


def test_hashes_shuffle_less_than_half(spark, many, built, no_broadcast):
    lean = star.build_fact(many, built.product, built.customer, built.date, covered=True)
    assert _shuffled(lean) * 2 <= _shuffled(_by_natural_keys(many, built))


@pytest.mark.parametrize("covered", [False, True])
@pytest.mark.parametrize("hashes", [1, 2])
def test_equal_hashes_are_told_apart(monkeypatch, many, built, covered, hashes):
    """All natural keys share one hash, or two."""
    plain = star.tuple_hash
    monkeypatch.setattr(star, "tuple_hash", lambda columns: F.pmod(plain(columns), F.lit(hashes)))
    got = star.build_fact(many, built.product, built.customer, built.date, covered)
    assert rows(got) == rows(_by_natural_keys(many, built))


def test_unknown_natural_keys_are_dropped(flat, built):
    odd = flat.withColumn("PRODUCTCODE", F.when(F.col("ORDERNUMBER") == 3, F.lit("S99")).otherwise(F.col("PRODUCTCODE")))
    assert star.build_fact(odd, built.product, built.customer, built.date).count() == len(LINES) - 1


def test_fact_lies_by_month(spark, built):
    """A filter on the dates reaches the folders of the fact, and the rows are those of the fact without layout."""
    from saleswh.plans import bi

    chosen = bi.filter_sales(built.flat(["order_date", "sales"]), "2004-01-01", "2005-01-02")
    plan = chosen._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan and "place_year" in plan and "place_month" in plan
    assert rows(chosen.select("sales")) == [(Decimal("1600.00"),), (Decimal("480.00"),), (Decimal("480.00"),)]
    bare = star.Star(built.fact, built.product, built.customer, built.date)
    assert rows(built.flat()) == rows(bare.flat())
    assert "Join" not in built.flat(["order_number"]).filter("order_number > 0").select("order_number")._jdf.queryExecution().optimizedPlan().toString()


def test_rows_without_a_date_have_a_place(spark, flat):
    odd = flat.withColumns({c: F.when(F.col("ORDERNUMBER") > 2, F.col(c)) for c in ("ORDERDATE", "YEAR_ID", "MONTH_ID")})
    star_of_odd = star.run_star_etl(odd, new_path(spark, "odd-star"))
    assert star_of_odd.flat(["sales", "order_date"]).count() == len(LINES)
    assert star_of_odd.violations == {"dim_date.order_date:null": 2}  # two quarters


def test_violations_come_with_the_write(spark, flat):
    odd = flat.withColumns({
        "SALES": F.when(F.col("ORDERNUMBER") == 1, -F.col("SALES")).otherwise(F.col("SALES")),
        "CITY": F.when(F.col("ORDERNUMBER") == 5, F.repeat(F.lit("x"), 51)).otherwise(F.col("CITY")),
        "PRODUCTCODE": F.when(F.col("ORDERNUMBER") > 1, F.col("PRODUCTCODE")),
    })
    got = star.run_star_etl(odd, new_path(spark, "violations"), by_month=False)
    assert got.violations == {"dim_product.product_code:null": 2, "dim_customer.city:length>50": 1, "fact_sales.sales:value<0": 2}
    assert got.placed is None and got.fact.count() == len(LINES)
