"""The CSV report: column look-up, missing columns, empty tables, values that are no number."""

import pytest

from tallyhouse.plans import csv_report as report
from tallyhouse.sources.uploads import DAMAGED, damaged_rows, find_column, find_roles, read_sales_csv

HEADER = "date,status,SKU,Courier Status,Qty,currency,AMOUNT,fulfilled-by"
ROWS = [
    "04-30-22,Shipped,A,Shipped,2,INR,100.5,Easy Ship",
    "04-30-22,Cancelled,B,,0,,,",
    "05-01-22,Shipped,B,Unshipped,5,INR,200,",
    "05-01-22,Shipped,C,Shipped,5,USD,50,Easy Ship",
]


@pytest.fixture
def table(spark, tmp_path):
    def load(header=HEADER, rows=ROWS, **options):
        path = tmp_path / "sales.csv"
        path.write_text("\n".join([header, *rows]) + "\n")
        return read_sales_csv(spark, str(path), **options)

    return load


def rows(df):
    return sorted((tuple(row) for row in df.collect()), key=repr)


def figures(df):
    found = {}
    for row in df.where("metric IS NOT NULL").collect():
        found.setdefault((row.section, row.metric), {})[row.key] = row.value
    return found


def test_first_candidate_wins_ignoring_case():
    columns = ["sales", "AMOUNT", "Amount due"]
    assert find_column(columns, ["Amount", "Sales"]) == "AMOUNT"
    assert find_column(["Sales", "Revenue"], ["Amount", "Sales", "Revenue"]) == "Sales"
    assert find_column(["Amount due"], ["Amount"]) is None
    assert find_roles(["QUANTITY", "qty"])["quantity"] == "qty"


def test_overview_divides_by_all_rows(table):
    assert rows(report.csv_sales_overview(table())) == [(350.5, 350.5 / 4)]


def test_sections(table):
    df = table()
    assert rows(report.csv_daily_sales(df)) == [("04-30-22", 100.5), ("05-01-22", 250.0)]
    assert report.csv_top_skus(df, limit=2).collect() == [("B", 5.0, 200.0), ("C", 5.0, 50.0)]
    assert rows(report.csv_fulfillment(df)) == [("Easy Ship", 2), (None, 2)]
    assert rows(report.csv_courier_status(df)) == [("Shipped", 2), ("Unshipped", 1), (None, 1)]
    assert rows(report.csv_order_status(df)) == [("Cancelled", 1), ("Shipped", 3)]
    assert rows(report.csv_quantity(df)) == [(12.0, 3.0)]
    assert rows(report.csv_currency(df)) == [("INR", 300.5), ("USD", 50.0), (None, None)]
    ((gross, cost, margin),) = rows(report.csv_financials(df))
    assert (gross, cost) == (350.5, 600.0)
    assert margin == pytest.approx((350.5 - 600) / 350.5 * 100)


def test_report_agrees_with_its_sections(table):
    found = figures(report.csv_report(table()))
    assert found[1, "total_sales"] == {None: 350.5}
    assert found[2, "total_sales"] == {"04-30-22": 100.5, "05-01-22": 250.0}
    assert found[3, "total_quantity"] == {"B": 5.0, "C": 5.0, "A": 2.0}
    assert found[4, "fulfillment_rows"] == {"Easy Ship": 2, None: 2}
    assert found[5, "courier_status_rows"] == {"Shipped": 2, "Unshipped": 1, None: 1}
    assert found[5, "order_status_rows"] == {"Cancelled": 1, "Shipped": 3}
    assert found[7, "average_quantity"] == {None: 3.0}
    assert found[8, "estimated_cost"] == {None: 600.0}
    assert found[9, "total_sales"] == {"INR": 300.5, "USD": 50.0, None: None}


def test_report_text(table):
    lines = [row.text for row in report.csv_report(table()).collect()]
    for line in (
        "Sales Analysis Report",
        "Total Sales: $350.50",
        "Average Order Value: $87.62",
        "Gross Revenue: $350.50",
        "Profit Margin: -71.18%",
        "04-30-22: $100.50",
        "Easy Ship: 2",
        "Customer Insights",
    ):
        assert line in lines, line


def test_iso_dates_group_as_written(table):
    iso = [row.replace("04-30-22", "2022-04-30").replace("05-01-22", "2022-05-01") for row in ROWS]
    df = table(rows=iso)
    assert dict(df.dtypes)["date"] == "string"
    assert rows(report.csv_daily_sales(df))[0] == ("2022-04-30", 100.5)


def test_amounts_kept_as_text_are_read_as_numbers(table):
    df = table(schema="date string, status string, SKU string, `Courier Status` string, "
               "Qty string, currency string, AMOUNT string, `fulfilled-by` string")
    assert rows(report.csv_sales_overview(df)) == [(350.5, 350.5 / 4)]


def without(column):
    names = HEADER.split(",")
    place = names.index(column)

    def cut(line):
        cells = line.split(",")
        return ",".join(cells[:place] + cells[place + 1 :])

    return cut(HEADER), [cut(row) for row in ROWS]


@pytest.mark.parametrize(
    ("column", "sections"),
    [
        ("date", {2}),
        ("status", {5}),
        ("SKU", {3}),
        ("Courier Status", {5}),
        ("Qty", {3, 7, 8}),
        ("currency", {9}),
        ("AMOUNT", {1, 2, 3, 8, 9}),
        ("fulfilled-by", {4}),
    ],
)
def test_missing_column_skips_its_sections_only(table, column, sections):
    df = report.csv_report(table(*without(column)))
    skipped = {row.section for row in df.where("text LIKE '%not found, skipping%'").collect()}
    assert skipped == sections
    assert {section for section, _ in figures(df)} == {1, 2, 3, 4, 5, 7, 8, 9, 10} - sections


def test_section_without_its_column_says_so(table):
    with pytest.raises(report.MissingColumn, match="amount"):
        report.csv_sales_overview(table(*without("AMOUNT")))


def test_table_without_any_known_column(table):
    df = report.csv_report(table("a,b", ["1,2"]))
    assert figures(df) == {(10, "damaged_rows"): {None: 0.0}}


def test_header_only(table):
    df = report.csv_report(table(rows=[]))
    found = figures(df)
    assert found[1, "total_sales"] == {None: None}
    assert (2, "total_sales") not in found and (4, "fulfillment_rows") not in found
    texts = [row.text for row in df.where("section = 1").collect()]
    assert "No values, skipping Sales Overview calculation" in texts


def test_both_amount_names(table):
    df = table("Sales,Amount", ["1,10", "2,20"])
    assert rows(report.csv_sales_overview(df)) == [(30.0, 15.0)]


def test_a_late_fraction_is_not_lost(table):
    whole = [f"d,s,A,c,1,INR,{n},e" for n in range(1, 3001)]
    df = table(rows=[*whole, "d,s,A,c,1,INR,9.75,e"])
    assert rows(report.csv_sales_overview(df))[0][0] == sum(range(1, 3001)) + 9.75


def test_values_that_are_no_number_are_counted(table):
    df = table(rows=[*ROWS, "d,s,A,c,many,INR,n/a,e", "d,s,A,c,,INR,,e"])
    found = figures(report.csv_report(df))
    assert found[1, "unreadable_amounts"] == {None: 1.0}
    assert found[7, "unreadable_quantities"] == {None: 1.0}
    assert found[1, "total_sales"] == {None: 350.5}


def test_report_reads_the_table_twice(table):
    plan = report.csv_report(table())._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan csv") == 2


def test_rows_that_do_not_fit_the_header_are_kept_and_counted(spark, tmp_path):
    """Short, long and broken rows."""
    path = tmp_path / "upload.csv"
    lines = ["Date,Qty,Amount", "d1,1,10", "d2,2", "d3,3,30,extra", "", 'd4,"4"x,40', "d5,5,n/a", "d6"]
    path.write_text("\n".join(lines) + "\n")
    df = read_sales_csv(spark, str(path))
    assert sorted(r[DAMAGED] for r in damaged_rows(df).collect()) == ["d2,2", "d3,3,30,extra", "d6"]
    found = figures(report.csv_report(df))
    assert found[10, "damaged_rows"] == {None: 3.0}
    assert found[1, "unreadable_amounts"] == {None: 1.0}
    assert found[1, "total_sales"] == {None: 80.0}
    assert found[7, "unreadable_quantities"] == {None: 1.0}
    sound = tmp_path / "sound.csv"
    sound.write_text("\n".join(lines[:2]))
    assert figures(report.csv_report(read_sales_csv(spark, str(sound))))[10, "damaged_rows"] == {None: 0.0}


def test_quoted_line_breaks(spark, tmp_path):
    path = tmp_path / "upload.csv"
    path.write_text('"Order\nDate",Qty,Amount\n"one\ntwo",1,"1,5"\n"say ""hi""",2,3\n')
    df = read_sales_csv(spark, str(path), line_breaks=True)
    assert df.columns[:3] == ["Order\nDate", "Qty", "Amount"]
    assert sorted(r[0] for r in df.collect()) == ["one\ntwo", 'say "hi"']
    assert damaged_rows(df).count() == 0


def test_files_with_different_headers_meet_by_name(spark, tmp_path):
    folder = tmp_path / "uploads"
    (folder / "more").mkdir(parents=True)
    (folder / "a.csv").write_text("Amount,Qty,SKU\n1,2,x\n")
    (folder / "b.csv").write_text("﻿sku,amount\nx,10.25\ny\n")
    (folder / "more" / "c.csv").write_text("Qty,Amount,SKU,Qty\n5,100,z,6\n")
    (folder / "_hidden.csv").write_text("Amount\n9999\n")
    (folder / "empty.csv").write_text("")
    df = read_sales_csv(spark, str(folder))
    sums = {r.sku: (r.total_quantity, r.total_sales) for r in report.csv_top_skus(df).collect()}
    assert sums == {"x": (2.0, 11.25), "y": (None, None), "z": (None, 100.0)}
    assert [r[DAMAGED] for r in damaged_rows(df).collect()] == ["y"]
    assert read_sales_csv(spark, str(folder / "*.csv")).count() == 3


def test_amounts_are_summed_as_decimals(table):
    """No total depends on the order of the rows, and no cell makes a total NaN."""
    exact = table(rows=[*["d,s,A,c,1,INR,0.1,e"] * 10, "d,s,A,c,1,INR,NaN,e", "d,s,A,c,1,INR,1e3,e"])
    assert rows(report.csv_sales_overview(exact))[0][0] == 1001.0
    assert figures(report.csv_report(exact))[1, "unreadable_amounts"] == {None: 1.0}
