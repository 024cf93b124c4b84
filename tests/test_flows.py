"""Invented plants through all stages, with the expected rows worked out by hand."""

import pytest
from pyspark.sql import functions as F

from tracewater.plans import bridge, emission, places, region, run, suspects
from tracewater.session import shared_folder
from tracewater.sources import schemas, sinks

POSSIBLE, EXPECTED = "Emissie mogelijk", "Emissie verwacht"


@pytest.fixture
def navigator(frame):
    return frame(
        "substance_group string, substance string, cas string, division string, branch string, sub_branch string, compartment string, emission_status string",
        ("ZZS Metalen", "lood", "7439-92-1", "3.6", "B1", None, "Water", POSSIBLE),
        ("ZZS Metalen", "lood", "7439-92-1", "3.6", "B1", None, "Water", POSSIBLE),
        ("ZZS Zouten", "lood", "7439-92-1", "3.6", "B1", None, "Water", POSSIBLE),
        ("ZZS Metalen", "lood", "7439-92-1", "3.6", None, None, "Water", POSSIBLE),
        ("Individuele stoffen", "formaldehyde", "50-00-0", "3.6", None, None, "Water", POSSIBLE),
        ("ZZS Metalen", "kwik", None, "3.7", "B2", "S1", "Water", EXPECTED),
        ("ZZS Metalen", None, None, "3.7", "B2", "S1", "Water", POSSIBLE),
        ("ZZS Metalen", "zink", "7440-66-6", "3.7", "B2", "S9", "Water", POSSIBLE),
    )


@pytest.fixture
def names(frame):
    return frame(
        "name_nl string, name_uk string, cas string, ec_nr string, smiles string",
        ("lood", "lead", "7439-92-1", "231-100-4", "[Pb]"), ("kwik", "mercury", None, None, "[Hg]"),
    )


@pytest.fixture
def pmt(frame):
    return frame("cas string, pmt_name string, pmt_score double, pmt_class string", ("7439-92-1", "Lead", 0.4, "High"))


@pytest.fixture
def activity(frame):
    return frame(
        "division string, branch string, sub_branch string, code string, code_name string, activity_nr string",
        ("3.6", "B1", None, "20,1", "chemie", "3.6.1"), ("3.6", "B1", None, "1", "landbouw", "3.6.1"),
        ("3.6", None, None, "96.03", "uitvaart", "3.6"), ("3.7", "B2", "S1", "201", "chemie", "3.7.1"),
        ("3.7", "B2", "S9", None, "leeg", "3.7.9"),
    )


def test_only_formaldehyde_is_branchless(navigator, rows):
    assert rows(bridge.branchless(navigator)) == [("3.6", "Individuele stoffen", "formaldehyde", "50-00-0")]


def test_clean_listing(navigator):
    listing = bridge.clean_listing(navigator)
    got = [(r.substance_group, r.substance, r.branch) for r in listing.collect()]
    assert sorted(got, key=str) == sorted(
        [("ZZS Metalen", "lood", "B1"), ("ZZS Zouten", "lood", "B1"), ("Individuele stoffen", "formaldehyde", None),
         ("ZZS Metalen", "kwik", "B2"), ("ZZS Metalen", "zink", "B2")], key=str)


def test_bridge(navigator, names, pmt, activity, rows):
    got = bridge.substance_bridge(navigator, names, pmt, activity)
    assert rows(got.select("substance", "substance_group", "code_padded", "code_decimal", "name_uk", "pmt_score")) == sorted(
        [("formaldehyde", "Individuele stoffen", "96030", "96.03", None, None),
         ("kwik", "ZZS Metalen", "20100", "20.1", "mercury", None),
         ("lood", "ZZS Metalen", "01000", "01", "lead", 0.4), ("lood", "ZZS Metalen", "20100", "20.1", "lead", 0.4),
         ("lood", "ZZS Zouten", "01000", "01", "lead", 0.4), ("lood", "ZZS Zouten", "20100", "20.1", "lead", 0.4)],
        key=lambda t: [(v is not None, str(v)) for v in t])
    wide = bridge.substance_code_matrix(got, ["01", "20.1", "96.03"])
    assert {(r.substance, r.substance_group, r["01"], r["20.1"], r["96.03"]) for r in wide.collect()} == {
        ("formaldehyde", "Individuele stoffen", None, None, 1), ("kwik", "ZZS Metalen", None, 1, None),
        ("lood", "ZZS Metalen", 1, 1, None), ("lood", "ZZS Zouten", 1, 1, None)}


@pytest.fixture
def companies(frame):
    return frame(
        "plant string, codes string, sectors string, street string, postcode string, town string",
        ("Bath", "201, 01", "chemie | landbouw", "Markt 1", "1111AA", "Bath"),
        ("Bath", "201", "chemie", "Markt 2", "1111AA", "Bath"),
        ("Bath", "999", "overig", "Markt 3", "1111AB", "Bath"),
        ("Dinther", "01, 9603", "landbouw | uitvaart", "Dorp 1", "2222BB", "Dinther"),
        ("Heugem", None, None, "Kade 1", "3333CC", "Heugem"),
    )


@pytest.fixture
def selection(frame):
    return frame("code_decimal string, process string, main_group string", ("20.1", "p", "Chemie"), ("01", "p", "Landbouw"), ("96.03", None, "Uitvaart"))


def test_region(navigator, names, pmt, activity, companies, selection):
    linked = bridge.substance_bridge(navigator, names, pmt, activity)
    got = region.region_suspects(companies, selection, linked, ["pmt_score"])
    found = {(r.plant, r.substance): (r.total_companies_expected, r.total_companies_possible, r.unique_codes_possible, r.expected, r.possible, r.pmt_score) for r in got.collect()}
    # Two groups list lead under the same codes; they must not count twice.
    assert found == {
        ("Bath", "lood"): (None, 3, 2, None, 1, 0.4), ("Bath", "kwik"): (2, None, None, 1, None, None),
        ("Dinther", "lood"): (None, 1, 1, None, 1, 0.4)}
    assert [r.substance for r in region.sorted_region_suspects(got).where("plant = 'Bath'").collect()] == ["kwik", "lood"]


def test_region_with_names_of_substances(frame, navigator, names, pmt, activity, companies, selection, rows):
    linked = bridge.substance_bridge(navigator, names, pmt, activity)
    codes = frame("substance string, use_id string", ("lood", "1"), ("lood", "2"), ("zink", "3"), (None, "4"))
    plain = region.region_suspects(companies, selection, linked, ["pmt_score"])
    got = region.region_suspects(companies, selection, linked, ["pmt_score"], names=codes)
    assert rows(got) == rows(plain.join(codes, "substance", "left").select(*got.columns)) and got.count() == 5
    # Lists of substances meet the plants in merge joins, whatever their files' size.
    text = got._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
    assert "SortMergeJoin [substance_id" in text and "SortMergeJoin [coalesce(code" in text


def test_sorted_final_list_is_made_once(spark):
    final = spark.range(8).select(*[(F.col("id") % 3).cast("string").alias(c) for c in suspects.DISPLAY_NAMES]).join(spark.range(3).withColumnRenamed("id", "n"))
    text = suspects.sorted_final_list(final)._jdf.queryExecution().executedPlan().toString()
    assert "FileScan parquet" in text and "Join" not in text


def test_region_side_reports(companies, selection, rows):
    assert rows(region.unselected_counts(region.code_counts(companies), selection)) == [("Bath", 1, 1), ("Heugem", 1, 1)]
    totals = region.group_totals(companies, selection)
    assert rows(totals) == [("Bath", "Chemie", 2), ("Bath", "Landbouw", 1), ("Dinther", "Landbouw", 1)]
    assert rows(region.top_groups(totals, 1).select("plant", "main_group")) == [("Bath", "Chemie"), ("Dinther", "Landbouw")]
    addresses = region.company_addresses(companies, selection)
    assert rows(addresses.select("code", "address")) == [
        ("01", "Dorp 1, 2222BB, Dinther, Netherlands"), ("01", "Markt 1, 1111AA, Bath, Netherlands"),
        ("201", "Markt 1, 1111AA, Bath, Netherlands"), ("201", "Markt 2, 1111AA, Bath, Netherlands")]


def test_locate_uses_override_of_the_original_address(frame, rows):
    df = frame("address string", ("Markt 1,  5461JJ, Veghel",), ("fout 9",), ("weg",), (None,))
    register = frame("address string, latitude double, longitude double", ("MARKT 1, 5461JJ, VEGHEL", 51.6, 5.5), ("Markt 1, 5461JJ, Veghel", 51.7, 5.6), ("Plein 1", 52.0, 5.0))
    overrides = frame("address string, corrected string", ("Fout 9", "plein  1"))
    located = places.locate(df, register, overrides)
    assert rows(located) == [(None, None, None), ("Markt 1,  5461JJ, Veghel", 51.6, 5.5), ("fout 9", 52.0, 5.0), ("weg", None, None)]
    report = places.location_report(located).first()
    assert (report.n_rows, report.n_matched, report.matched_pct) == (4, 2, 50.0)


@pytest.fixture
def parameters(frame):
    return frame("casnummer string, id string, codes string, omschrijving string", ("7439-92-1", "1", "Pb", "lood"), ("50-00-0", "2", "fal", "formaldehyde"))


def test_parameter_list_repairs_repeats(frame, parameters, rows):
    linked = frame(
        "substance_group string, substance string, cas string, name_nl string, compartment string, emission_status string",
        ("ZZS b", "lood", "7439-92-1", "lood", "Water", POSSIBLE), ("Individuele stoffen", "lood", "7439-92-1", "lood", "Water", POSSIBLE),
        ("ZZS a", "mix", "NVT", "mix", "Water", POSSIBLE), ("ZZS a", "mix", "NVT", "mix", "Lucht", POSSIBLE),
        ("ZZS a", "los", None, "los", "Water", POSSIBLE), ("ZZS a", "kwik", "1-1-1", "kwik", "Water", POSSIBLE), ("ZZS a", "kwik", "1-1-1", "kwik", "Lucht", POSSIBLE),
    )
    got = suspects.parameter_list(linked, parameters, ["substance", "cas", "name_nl", "compartment", "emission_status"])
    assert rows(got.select("substance", "compartment", "groups", "codes")) == [
        ("kwik", "Lucht", "ZZS a", None), ("kwik", "Water", "ZZS a", None), ("lood", "Water", "Individuele stoffen, ZZS b", "Pb"), ("los", "Water", "ZZS a", None)]


@pytest.fixture
def register(frame):
    return frame(
        "postcode string, substance_code string, substance_name string, company string, code_name string, emission double, unit string, year int, origin string, dataset string",
        ("1111AA", "10.0", "Lood", "Fabriek", "chemie", 5.0, "kg", 2023, "e-MJV", "ER"), ("1111AB", "x", "Iets", "Fabriek", "chemie", None, "kg", 2023, "e-MJV", "ER"),
        ("9999ZZ", "10", "Lood", "Elders", "chemie", 7.0, "kg", 2023, "e-MJV", "ER"),
    )


@pytest.fixture
def measurements(frame):
    return frame(
        "year string, plant_code string, location string, parameter_code string, substance_name string, cas string, register_code string, median double",
        ("Alle", "1", "BATH", "Pb", "lood", "7439-92-1", "10", 100000.0), ("2022", "1", "BATH", "Pb", "lood", "7439-92-1", "10", 5.0),
        ("Alle", "Alle", "BATH", "Pb", "lood", "7439-92-1", "10", 5.0), ("Alle", "1", "BATH", "Zn", "zink", "7440-66-6", "nvt", 0.0),
        ("Alle", "2", None, "Zn", "zink", "7440-66-6", "nvt", 200000.0),
    )


@pytest.fixture
def emissions(frame, register, measurements, parameters):
    pairs = frame("plant string, postcode6 string", ("Bath", "1111AA"), ("Bath", "1111AA"), ("Zuid", "1111AA"), ("Bath", "1111AB"))
    codes = frame("register_code int, register_name string, parameter_code string", (10, "Lood", "Pb"))
    return emission.emission_union(emission.register_of_plants(register, pairs), measurements, codes, parameters, 2023)


def test_emission_union(emissions, rows):
    assert emissions.columns == emission.COLUMNS
    assert rows(emissions.select("plant", "cas", "company", "emission", "register_code", "year")) == sorted(
        [("Bath", "7439-92-1", "Fabriek", 5.0, 10.0, 2023.0), ("Zuid", "7439-92-1", "Fabriek", 5.0, 10.0, 2023.0),
         ("Bath", None, "Fabriek", None, None, 2023.0), ("Bath", "7439-92-1", "RWZI Bath", 36.5, 10.0, 2023.0),
         ("NA", "7440-66-6", "RWZI NA", 73.0, None, 2023.0)], key=lambda t: [(v is not None, str(v)) for v in t])
    assert [r.emission for r in emission.sorted_emissions(emissions).where("plant = 'Bath'").collect()] == [36.5, 5.0, None]


def test_compounds_and_classes(frame, rows):
    known = frame(
        "cas string, cid string, formula string, smiles string",
        ("1", "20", "C2H6O", "CCO"), ("1", "3", "C2H6O", " OCC "), ("2", "5", "C2H6O", "OCC"), ("3", None, "C9", "C"), ("4", "7", None, "N"), ("5", "8", "NaCl", None), ("6", "9", "KCl", None),
    )
    wanted = frame("cas string", ("6",), ("5",), ("4",), ("3",), ("2",), ("1",), ("1",), (None,))
    enriched = suspects.enrich_compounds(wanted, known)
    # CAS 2 shares the SMILES of 1, and 6 the missing one of 5: both lose their properties.
    assert rows(enriched.select("cas", "cid")) == [("1", "3"), ("4", "7"), ("5", "8")]
    assert rows(suspects.classify(enriched).select("cas", "chemical_class")) == [("1", "Organic"), ("5", "Inorganic")]


def test_end_to_end(spark, frame, navigator, names, pmt, activity, companies, selection, parameters, register, measurements):
    pairs = frame("plant string, postcode6 string", ("Bath", "1111AA"))
    inputs = run.Inputs(
        navigator=navigator, names=names, pmt=pmt, activity=activity, selection=selection, companies=companies, parameters=parameters,
        register=emission.register_of_plants(register, pairs),
        register_codes=frame("register_code int, register_name string, parameter_code string", (10, "Lood", "Pb")),
        measurements=measurements,
        compounds=frame("cas string, cid string, formula string, smiles string, inchi string, inchi_key string, title string, mass double, charge int",
                        ("7439-92-1", "5352425", "Pb", "[Pb]", "i", "k", "Lead", 207.97, 0), ("7440-66-6", "1", "C9Zn", "C[Zn]", "i", "k", "Zinc", 63.9, 0)),
    )
    final = suspects.sorted_final_list(run.suspect_list(inputs, run.Options(year=2023), shared_folder(spark, "run")))
    assert final.columns[: len(suspects.DISPLAY_NAMES)] == list(suspects.DISPLAY_NAMES)
    got = [(r.plant, r.substance, r.company, r.emission, r.possible, r.chemical_class, r.groups, r.aquo_code) for r in final.collect()]
    assert got == [
        ("Bath", "lood", "RWZI Bath", 36.5, 1, "Inorganic", "ZZS Metalen, ZZS Zouten", "Pb"),
        ("Bath", "lood", "Fabriek", 5.0, 1, "Inorganic", "ZZS Metalen, ZZS Zouten", "Pb"),
        ("Bath", "kwik", None, None, None, None, "ZZS Metalen", None),
        ("Dinther", "lood", None, None, 1, "Inorganic", "ZZS Metalen, ZZS Zouten", "Pb"),
        ("NA", "zink", "RWZI NA", 73.0, None, "Organic", None, "Zn"),
    ]
    assert suspects.organic_part(final).count() == 1
    shown = sinks.with_display_names(final, suspects.DISPLAY_NAMES)
    assert shown.columns[:5] == ["case_study", "Stofgroep", "ZZS_Stofgroepen", "Stofnaam", "CAS-nummer"]


def test_plant_alias_and_strict_organic(frame, rows):
    df = frame("plant string, chemical_class string", ("Dummy1", "Organic Ionic"), ("Bath", "Organic"), (None, "Inorganic"))
    assert rows(suspects.plant_alias(df, {"Dummy1": "Bath"}).select("plant")) == [(None,), ("Bath",), ("Bath",)]
    assert suspects.organic_part(df).count() == 2 and suspects.organic_part(df, strict=True).count() == 1


def test_schemas_keep_codes_as_text():
    for schema in (schemas.NAVIGATOR, schemas.ACTIVITY, schemas.COMPANIES, schemas.REGISTER):
        assert all(f.dataType.simpleString() == "string" for f in schema.fields if "code" in f.name or f.name in ("cas", "codes"))
