import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from filigree.functions import readings
from filigree.operators import wide
from filigree.plans import facts_wide

FACTS = "id bigint, accession_number string, concept_name string, value decimal(20,4), value_text string, period_end date, dimensions map<string,string>, created_at timestamp_ntz, data_type string, section string"
D1, D2 = datetime.date(2020, 12, 31), datetime.date(2021, 12, 31)
T = [datetime.datetime(2021, 1, i) for i in range(1, 9)]
LISTED = [("us-gaap:Assets", "monetary"), ("dei:Flag", "boolean"), ("dei:Day", "date"), ("dei:Name", "string"), ("us-gaap:Rate", "pure")]


def _wide(spark, rows):
    facts = spark.createDataFrame([(*r, "clash", "clash") for r in rows], FACTS)
    listed = spark.createDataFrame(LISTED, "concept_name string, data_type string")
    schema = {c: facts_wide.KIND_OF[k] for c, k in LISTED}
    return wide.widen(facts_wide.concept_cells(facts, listed), facts_wide.ENTITY, schema)


def test_cells(spark):
    a = "0001900000-20-000001"
    rows = [
        (1, a, "us-gaap:Assets", Decimal("5"), None, D1, None, T[0]), (2, a.replace("-", ""), "US-GAAP_assets", None, "(1,234.50)", D1, {}, T[1]), (3, a, "us-gaap:Assets", None, "n/a", D1, None, T[5]),
        (4, a, "us-gaap:Assets", Decimal("9"), None, D1, {"x": "y"}, T[6]), (5, a, "us-gaap:Assets", Decimal("9"), None, None, None, T[6]), (6, a, "dei:Flag", None, " No ", D1, None, T[0]), (7, a, "dei:Day", None, "March 5, 2021", D1, None, T[0]),
        (8, a, "dei:Name", None, "  ", D1, None, T[0]), (9, a, "own:Thing", Decimal("7"), None, D1, None, T[0]), (11, a, "own:Thing", None, "seven", D1, None, T[0]), (10, a, "us-gaap:Rate", None, "4.5%", D2, None, None), (12, None, "us-gaap:Assets", Decimal("1"), None, D1, None, T[0]), (13, a, None, Decimal("1"), None, D1, None, T[0]),
        (14, "b", "dei:Flag", None, "maybe", D1, None, T[0]), (2, a.replace("-", ""), "US-GAAP_assets", None, "(1,234.50)", D1, {}, T[1]),
    ]
    got = {(r.accession_number, r.period_end): r for r in _wide(spark, rows).collect()}
    assert set(got) == {(a, D1), (a, D2)}
    r = got[a, D1]
    assert (r.us_gaap_Assets, r.dei_Flag, r.dei_Day, r.dei_Name, r.us_gaap_Rate) == (Decimal("-1234.5"), False, datetime.date(2021, 3, 5), None, None)
    assert r.others == {"own:Thing": "7.0000"} and r.row_ids == {"us-gaap:Assets": 2, "dei:Flag": 6, "dei:Day": 7, "own:Thing": 9}
    assert got[a, D2].us_gaap_Rate == Decimal("0.045") and got[a, D2].row_ids == {"us-gaap:Rate": 10}


def test_many_batches_and_a_hot_entity(spark):
    rows = [(i, f"e{i % 7}" if i % 3 else "hot", f"own:c{i % 5000}", Decimal(i), None, D1, None, T[0]) for i in range(12_000)]
    got = {r.accession_number: r for r in _wide(spark, rows).collect()}
    want = {}
    for i, e, c, *_ in rows:
        want.setdefault(e, {}).setdefault(c, i)
    assert {e: r.row_ids for e, r in got.items()} == want
    assert {e: set(r.others) for e, r in got.items()} == {e: set(c) for e, c in want.items()}


def test_empty_table_and_clashing_names(spark):
    assert _wide(spark, []).count() == 0
    cells = spark.createDataFrame([], "e string, attribute string, n decimal(38,8), t string, b boolean, d date, id bigint")
    with pytest.raises(ValueError):
        wide.widen(cells, ["e"], {"a:b": "text", "a_b": "text"})
    with pytest.raises(ValueError):
        wide.widen(cells, ["e"], {"E": "text"})


@pytest.mark.parametrize(
    "text,value",
    [
        ("1,234", "1234"), (" 1 234 567 ", "1234567"), ("$1,018,077", "1018077"), ("(USD 1,273,000)", "-1273000"), ("-USD 0.37", "-0.37"), ("5%", "0.05"), ("1.234.567,89", "1234567.89"), ("12,5", "12.5"), ("−7", "-7"), ("7-", "-7"), (".5", "0.5"),
        ("1'000", "1000"), ("€ 3", "3"), ("3 EUR", "3"), ("1,23,4", None), ("n/a", None), ("", None), ("—", None), ("(not disclosed)", None), ("see note 4", None), ("12 34", None), ("***", None), (None, None), ("1.2.3", None), ("9" * 60, None),
    ],
)
def test_number(spark, text, value):
    got = spark.createDataFrame([(text,)], "t string").select(readings.number(F.col("t"))).first()[0]
    assert got == (None if value is None else Decimal(value))


def test_dates_and_booleans(spark):
    df = spark.createDataFrame([(x,) for x in ("2020-02-30", "2020-01-05", "2020/01/05", "January 05, 2020", "5 January 2020", "soon", None, "TRUE", "no")], "t string")
    got = df.select(readings.date(F.col("t")).alias("d"), readings.boolean(F.col("t")).alias("b")).collect()
    assert [r.d for r in got] == [None, *[datetime.date(2020, 1, 5)] * 4, None, None, None, None] and [r.b for r in got][-3:] == [None, True, False]
