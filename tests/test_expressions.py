"""Text, number, code, date, chemistry and geodesy expressions."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tracewater.functions import chemistry, codes, dates, geodesy, numbers, text


def apply(frame, expression, *values):
    df = frame("i int, v string", *enumerate(values))
    return [r.x for r in df.select("i", expression(F.col("v")).alias("x")).orderBy("i").collect()]


@pytest.mark.parametrize(
    "written, decimal, plain, padded",
    [
        ("1", "01", "01", "01000"),
        ("20", "20", "20", "20000"),
        ("201", "20.1", "201", "20100"),
        ("2014", "2014", "2014", "20140"),
        ("1.1", "01.1", "011", "01100"),
        ("1.111", "01.11.1", "01111", "01111"),
        ("20.14", "20.14", "2014", "20140"),
        ("20,141", "20.14.1", "20141", "20141"),
        ("20.14.12", "20.14.12", "201412", "201412"),
        (None, None, None, None),
    ],
)
def test_code_forms(frame, written, decimal, plain, padded):
    forms = codes.code_forms(F.col("v"))
    row = frame("v string", (written,)).select(*[f.alias(n) for n, f in forms.items()]).first()
    assert (row.decimal, row.plain, row.padded) == (decimal, plain, padded)


def test_tolerant_numbers(frame):
    texts = ["12", "12.7", "-12.7", "abc", None, " 5 ", "1e3", "12d", "NaN", "99999999999"]
    assert apply(frame, numbers.tolerant_int, *texts) == [12, 12, -12, None, None, 5, 1000, None, None, None]
    assert apply(frame, numbers.tolerant_double, "2.5", "x", None) == [2.5, None, None]


def test_annual_load(frame):
    df = frame("v double", (1000.0,), (27397.26,), (None,))
    assert [r[0] for r in df.select(numbers.annual_load(F.col("v"))).collect()] == [0.37, 10.0, None]


def test_title_case(frame):
    got = apply(frame, text.title_case, "'S-HERTOGENBOSCH", "DEN BOSCH", "noord-brabant oost", "d'OR élan", None, "3e bath")
    assert got == ["'S-Hertogenbosch", "Den Bosch", "Noord-Brabant Oost", "D'or Élan", None, "3e Bath"]


def test_replacements(frame):
    assert apply(frame, lambda c: text.replace_first(c, " ", "+"), "a b c", "abc", None) == ["a+b c", "abc", None]
    assert apply(frame, lambda c: text.strip_suffix(c, "_ZZS"), "Bath_ZZS", "Bath_ZZS_x") == ["Bath", "Bath_ZZS_x"]
    assert apply(frame, text.safe_file_name, "Bath (Zuid)") == ["Bath__Zuid_"]
    long = "Vervaardiging van overige chemische producten en meer"
    assert apply(frame, text.wrap_label, long, "kort") == ["Vervaardiging van overige chemische\nproducten en meer", "kort"]


def test_address_shows_missing_parts(frame):
    df = frame("a string, b string, c string", ("Markt 1", None, "Veghel"))
    assert df.select(text.address_text(F.col("a"), F.col("b"), F.col("c"))).first()[0] == "Markt 1, NA, Veghel, Netherlands"
    assert apply(frame, text.normal_address, "  Markt  1 ,5461JJ,  Veghel ") == ["MARKT 1, 5461JJ, VEGHEL"]


def test_comma_decimal(frame):
    df = frame("i int, v double", (0, 7498.12), (1, 100.0), (2, 0.0), (3, -0.25), (4, 1e10), (5, None), (6, 1e-4),
               (7, 4e-16), (8, -1.23456789e-12), (9, 1.7976931348623157e308), (10, -0.0), (11, float("nan")))
    got = [r[0] for r in df.orderBy("i").select(text.comma_decimal(F.col("v"))).collect()]
    assert got == ["7498,12", "100", "0", "-0,25", "10000000000", None, "0,0001",
                   "0,0000000000000004", "-0,00000000000123456789", "17976931348623157" + "0" * 292, "0", "NaN"]


def test_dates(frame):
    day = dt.date(2023, 8, 7)
    forms = ["7 augustus 2023", "7 augustus 2023 12:30:00", "07-08-2023", "07-08-2023 10:00:00", "2023-08-07", "2023-08-07 01:02:03", "20230807", "7 aug 2023"]
    assert apply(frame, dates.parse_date, *forms) == [day] * len(forms)
    assert apply(frame, dates.parse_date, "onbekend", "31-02-2023", None, "7 maandag 2023") == [None] * 4
    months = ["januari", "februari", "maart", "april", "mei", "juni", "juli", "augustus", "september", "oktober", "november", "december"]
    assert [d.month for d in apply(frame, dates.parse_date, *[f"1 {m} 2020" for m in months])] == list(range(1, 13))


def test_export_time(frame):
    got = apply(frame, dates.export_time, "x/Export-2024-03-01-101500.csv", "x/Export.csv", "x/Export_2024-13-41-000000")
    assert got == [dt.datetime(2024, 3, 1, 10, 15), None, None]


@pytest.mark.parametrize(
    "formula, smiles, label",
    [
        ("NaCl", "[Na+].[Cl-]", "Inorganic"),
        ("NaCl", None, "Inorganic"),
        ("CHCl3", "C(Cl)(Cl)Cl", "Inorganic"),
        ("C2H6O", "CCO", "Organic"),
        ("C2H3NaO2", "CC(=O)[O-].[Na+]", "Organic Ionic"),
        ("C12H28Sn", "CCC[Sn](CCC)CCC", "Organometallic"),
        ("C10H10Fe", "[CH-]1C=CC=C1[Fe+2]", "Organic"),
        ("C8H20Pb", "CC[Pb](CC)(CC)CC", "Organometallic"),
        ("C2H5Br", "CCBr", "Organic"),
        ("C2H7BO2", "CCB(O)O", "Organometallic"),
        ("C2H6O", None, None),
        (None, "C.C", None),
        (None, None, None),
    ],
)
def test_chemical_class(frame, formula, smiles, label):
    df = frame("f string, s string", (formula, smiles))
    assert df.select(chemistry.chemical_class(F.col("f"), F.col("s"))).first()[0] == label


def test_rd_known_points_and_round_trip(frame):
    x, y = geodesy.to_rd(F.col("lon"), F.col("lat"))
    df = frame("lon double, lat double", (5.38720621, 52.15517440), (4.88352559, 52.37453253), (5.9, 50.9), (6.6, 53.2))
    moved = df.withColumns({"x": x, "y": y})
    got = moved.collect()
    assert (round(got[0].x, 3), round(got[0].y, 3)) == (155000.0, 463000.0)
    assert abs(got[1].x - 120700.72) < 1 and abs(got[1].y - 487525.50) < 1
    lon, lat = geodesy.to_wgs84(F.col("x"), F.col("y"))
    for r in moved.select("lon", "lat", lon.alias("lon2"), lat.alias("lat2")).collect():
        assert abs(r.lon - r.lon2) < 1e-5 and abs(r.lat - r.lat2) < 1e-5
