import pytest
from conftest import column, values

from ledgerloom.functions.dates import parse_date, parse_month
from ledgerloom.functions.numbers import whole
from ledgerloom.functions.text import missing_to_null, product_key, strip, title_case
from ledgerloom.operators import star, structuring
from ledgerloom.schemas import RAW_TABLES, STAR, raw_schema
from ledgerloom.sources.raw import malformed_lines, raw_row_counts, scan_raw, write_csv
from pyspark.sql import functions as F


def texts(table, *items):
    return table("id int; c string", list(enumerate(items)))


def test_missing_tokens(table):
    df = missing_to_null(texts(table, "", "NA", "None", "null", "-", "nan").drop("id"))
    assert sorted(v[0] or "" for v in values(df, "c")) == ["", "", "", "", "", "-"]


def test_scan_round_trip(spark, table, tmp_path):
    row = dict.fromkeys(raw_schema("dim_store").fieldNames(), None)
    row.update(store_id="1", store_name=' a "b", c ', store_type="NA", location=None)
    raw = spark.createDataFrame([tuple(row.values())], raw_schema("dim_store"))
    write_csv(raw, f"{tmp_path}/dim_store.csv")
    back = scan_raw(spark, str(tmp_path), ["dim_store"])
    assert values(back["dim_store"], "*") == [("1", ' a "b", c ', None, None)]
    assert values(raw_row_counts(back), "*") == [("dim_store", 1)]


def write_text(path, *lines):
    path.mkdir(exist_ok=True)
    (path / f"part-{len(list(path.iterdir()))}.csv").write_text("\n".join(lines) + "\n")


def test_scan_takes_columns_by_name(spark, tmp_path):
    write_text(tmp_path / "dim_store.csv", "location,store_type,store_id,store_name", "a,b,1,c")
    assert values(scan_raw(spark, str(tmp_path), ["dim_store"])["dim_store"], "*") == [
        ("1", "c", "b", "a")
    ]


def test_scan_refuses_other_columns(spark, tmp_path):
    write_text(tmp_path / "dim_store.csv", "store_id,store_name,store_type,wrong", "1,a,b,c")
    with pytest.raises(ValueError, match="location.*wrong"):
        scan_raw(spark, str(tmp_path), ["dim_store"])


def test_scan_refuses_files_that_differ(spark, tmp_path):
    folder = tmp_path / "dim_store.csv"
    write_text(folder, "store_id,store_name,store_type,location", "1,a,b,c")
    write_text(folder, "store_name,store_id,store_type,location", "a,2,b,c")
    with pytest.raises(Exception, match="(?i)header"):
        scan_raw(spark, str(tmp_path), ["dim_store"])["dim_store"].collect()


def test_scan_of_texts_with_line_breaks(spark, tmp_path):
    write_text(tmp_path / "dim_store.csv", "store_id,store_name,store_type,location",
               '1,"a', 'b",c,d')
    df = scan_raw(spark, str(tmp_path), ["dim_store"])["dim_store"]
    assert values(df, "store_name", "location") == [("a\nb", "d")]


def test_malformed_lines_are_an_error_or_told(spark, tmp_path):
    write_text(tmp_path / "dim_store.csv", "store_id,store_name,store_type,location",
               "1,a,b,c", '2,"x', 'y",b,c', "3,a,b,c,d", "4,a", "5,a,,c")
    cases = (
        (False, [("1", "c"), ("5", "c")], [('2,"x',), ("3,a,b,c,d",), ("4,a",), ('y",b,c',)]),
        (True, [("1", "c"), ("2", "c"), ("5", "c")], [("3,a,b,c,d",), ("4,a",)]),
    )
    for multiline, good, bad in cases:
        options = {"tables": ["dim_store"], "multiline": multiline}
        with pytest.raises(Exception, match="(?i)malformed|failed_read_file"):
            scan_raw(spark, str(tmp_path), **options)["dim_store"].collect()
        df = scan_raw(spark, str(tmp_path), **options, skip_malformed=True)["dim_store"]
        assert sorted(values(df, "store_id", "location")) == good
        lines = malformed_lines(spark, str(tmp_path), **options)
        assert sorted(values(lines, "line")) == bad
        assert lines.count() == len(bad)


def test_large_and_unreadable_numbers(spark, rules):
    names = raw_schema("fact_sales").fieldNames()
    row = dict.fromkeys(names) | {"transaction_id": "T"}
    lines = [
        {"quantity": "3000000000", "discount_pct": "123456", "unit_price": "12.345"},
        {"employee_id": "E-77", "date_id": "someday", "gross_amount": "1e99"},
        {"employee_id": "12.001", "store_id": "12.0"},
        {},
    ]
    raw = spark.createDataFrame([tuple({**row, **x}.values()) for x in lines], raw_schema("fact_sales"))
    typed = structuring.structure_table("fact_sales", raw, rules)
    assert values(typed, "quantity", "discount_pct", "unit_price", "employee_id", "store_id") == [
        (3000000000, 123456, 12.345, None, None),
        (None, None, None, None, None),
        (None, None, None, None, 12),
        (None, None, None, None, None),
    ]
    assert values(typed, "refused_values", "unreadable_values") == [
        (None, None),
        ("employee_id=E-77; gross_amount=1e99", "date_id=someday"),
        ("employee_id=12.001", None),
        (None, None),
    ]


def test_headcount_may_be_absent(spark, tmp_path, rules):
    write_text(tmp_path / "fact_opex.csv", "opex_id,month,expense_type,amount,store_id",
               "1,Apr-18,Rent,5,1")
    raw = scan_raw(spark, str(tmp_path), ["fact_opex"])["fact_opex"]
    typed = structuring.structure_table("fact_opex", raw, rules)
    loaded = star.accepted(star.apply_schema(typed, STAR["fact_opex"]))
    assert values(loaded, "month", "amount", "headcount") == [("2018-04-01", 5, None)]


def test_parse_date(table):
    df = texts(table, "2018-01-05", "bad", None, "05/02/2018", "2018-1-5", "2018-13-01").withColumn(
        "d", parse_date(F.col("c"))
    )
    assert column(df, "d") == ["2018-01-05", None, None, None, None, None]
    more = df.withColumn("d", parse_date(F.col("c"), ("yyyy-MM-dd", "dd/MM/yyyy")))
    assert column(more, "d") == ["2018-01-05", None, None, "2018-02-05", None, None]


def test_missing_dates_count(table):
    df = table("date_id date; copies bigint", [("2018-01-05", 2), (None, 3)])
    plain = table("date_id date", [("2018-01-05",), (None,)])
    found = structuring.missing_dates({"weighted": df, "plain": plain})
    assert sorted(values(found, "*")) == [("plain", "date_id", 1), ("weighted", "date_id", 3)]


def test_profile_of_table_without_dates(table):
    found = structuring.table_profile({"t": table("a int", [(1,), (2,)])})
    assert values(found, "*") == [("t", 2, None, 0)]


def test_whole(table):
    df = texts(table, "12.0", "x", None, "12", "9007199254740993", "1.5", " 7 ").withColumn(
        "n", whole(F.col("c"))
    )
    assert column(df, "n") == [12, None, None, 12, 9007199254740993, None, 7]


def test_product_key(table):
    df = texts(table, "12.0", " 12 ", "12", "12.05", None, "a\t").withColumn(
        "k", product_key(F.col("c"))
    )
    assert column(df, "k") == ["12", "12", "12", "12.05", None, "a"]


def test_strip_all_whitespace(table):
    df = texts(table, "\t a b\n", chr(0xA0) + "x" + chr(0x3000)).withColumn("s", strip(F.col("c")))
    assert column(df, "s") == ["a b", "x"]


def test_title_case(table):
    items = ["e-wallet", "UPI", "credit card", "a1b", "it's", None]
    df = texts(table, *items).withColumn("t", title_case(F.col("c")))
    assert column(df, "t") == [i.title() if i else None for i in items]


def test_parse_month(table):
    items = ["Apr-18", "2018-04-21", "bad", "apr-95", None, "Jan-68", "Jan-69", "Apr-2018"]
    df = texts(table, *items).withColumn("m", parse_month(F.col("c")))
    assert column(df, "m") == [
        "2018-04-01", "2018-04-01", None, "1995-04-01", None, "2068-01-01", "1969-01-01", None,
    ]


def test_grain_counts_all_members(table):
    rows = table(
        "transaction_id string; product_id string; payment_mode string",
        [("a", "1", "x"), ("a", "1", "y"), ("a", "2", "x"), ("b", "1", "x"), ("b", "1", "x")],
    )
    assert values(structuring.grain_check(structuring.distinct_rows(rows)), "*") == [(4,)]


def test_distinct_rows_treats_missing_as_equal(table):
    rows = table(
        "a string; b string", [("x", None), ("x", None), ("x", "cash"), ("x", " cash")]
    )
    found = structuring.distinct_rows(rows)
    assert sorted(values(found, "b", "copies"), key=str) == [
        (" cash", 1), ("cash", 1), (None, 2),
    ]


def test_domain_profile_keeps_missing(table):
    found = structuring.domain_profile({"t": table("c string", [("a",), (None,)])}, [("t", "c")])
    assert sorted(values(found, "*"), key=str) == [("t.c", "a", 1), ("t.c", None, 1)]


def test_every_raw_table_can_be_structured(spark, rules):
    for name in RAW_TABLES:
        raw = spark.createDataFrame([], raw_schema(name))
        typed = structuring.structure_table(name, raw, rules)
        assert typed.columns == [*raw.columns, "refused_values", "unreadable_values"]
        for f in typed.schema.fields:
            if f.name in STAR[name].names and f.name != "product_id":
                declared = STAR[name][f.name].dataType.simpleString()
                wide = {"int": "bigint"}.get(declared, declared)
                if "decimal" in declared or f.name == "quantity_ordered":
                    wide = "decimal(18,4)"
                assert f.dataType.simpleString() == wide
