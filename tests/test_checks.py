"""Reports over small frames."""

from tracewater.plans import checks, places


def test_register_and_postcode_sizes(frame, rows):
    placed = frame("plant string, nic string, company string", ("P", "1", "a"), ("P", "1", "a"), ("P", None, "b"), ("Q", "1", "a"))
    assert rows(checks.register_sizes(placed)) == [("P", 3, 2), ("Q", 1, 1)]
    pairs = frame("plant string, postcode6 string", ("P", "1111AA"), ("P", "1111AB"), ("P", "2222AA"), ("P", "2222AA"))
    assert rows(checks.postcode_sizes(pairs)) == [("P", 3, 2)]


def test_unlinked_and_missing(frame, rows):
    emissions = frame("register_code int, register_name string, parameter_code string, description string",
                      (1, "a", None, None), (1, "a", None, None), (2, "b", "B", None), (3, "c", "C", "see"))
    assert rows(checks.unlinked_register(emissions)) == [(1, "a", True), (2, "b", False)]
    substances = frame("cas string, substance string", ("1", "a"), ("1", "a"), ("2", "b"), (None, "c"))
    compounds = frame("cas string, cid string", ("1", "9"), ("2", None))
    assert rows(checks.without_compound(substances, compounds)) == [("2", "b")]


def test_losses_totals_and_summary(frame, rows):
    found = frame("cas string, smiles string", ("1", "C"), ("2", "C"), ("3", None), ("4", None))
    assert rows(checks.smiles_losses(found)) == [(4, 2, 50.0)]
    assert rows(checks.class_totals(frame("chemical_class string", ("Organic",), ("Organic",), ("Inorganic",)))) == [("Inorganic", 1), ("Organic", 2)]
    summary = checks.suspects_summary(frame("cas string, plant string", ("1", "P"), (None, "P"), ("1", "Q"))).first()
    assert (summary.n_rows, summary.n_cas, summary.n_plant) == (3, 2, 2)
    rate = checks.parameter_link_rate(frame("cas string, codes string", ("1", "a"), ("2", None), ("3", "c"))).first()
    assert (rate.n_matched, rate.matched_pct) == (2, 67.0)


def test_company_density_weighs_codes_and_skips_unknown(frame):
    companies = frame("plant string, address string", ("P", "Markt 1"), ("P", "Markt 1"), ("P", "Dorp 1"), ("P", "nergens"))
    register = frame("address string, latitude double, longitude double", ("markt 1", 52.0, 5.0), ("dorp 1", 52.3, 5.0))
    bands = places.company_density(companies, register, (1000.0, 1000.0), (1500.0, 1500.0))
    peak = bands.orderBy(bands.density.desc()).first()
    assert peak.band == 10
    # 52.0 N, 5.0 E lies near x = 128.4 km, y = 446.2 km: the address with two codes.
    assert abs(peak.ix - 128.4) < 1 and abs(peak.iy - 446.2) < 1.5
    mass = sum(r.density for r in bands.collect())
    assert abs(mass - 1.0) < 0.01


def test_company_contours_with_plug_in_bandwidth(frame):
    places_at = [(f"A {i}", 52.0 + (i * i % 17) / 400, 5.0 + (i * 7 % 23) / 300) for i in range(60)]
    register = frame("address string, latitude double, longitude double", *places_at)
    companies = frame("address string, plant string", *[(a, "p") for a, _, _ in places_at], ("nowhere", "p"))
    rings = places.company_contours(companies, register, (500.0, 500.0), None, shares=(50, 90)).collect()
    assert {r.band for r in rings} == {50, 90} and all(r.points[0] == r.points[-1] for r in rings)
    total = {b: sum(r.area for r in rings if r.band == b) for b in (50, 90)}
    assert 0 < total[50] < total[90]


def test_postcode_sizes_count_step_by_step(spark):
    schema = "plant string, postcode6 string"
    pairs = spark.createDataFrame([("P", "1234AB"), ("P", "1234AB"), ("P", "1234CD"), ("P", None), ("Q", None), (None, "9")], schema)
    found = checks.postcode_sizes(pairs)
    assert "Expand" not in found._jdf.queryExecution().optimizedPlan().toString()
    assert {tuple(r) for r in found.collect()} == {("P", 2, 1), ("Q", 0, 0), (None, 1, 1)}


def test_postcode_sizes_of_distinct_pairs_are_not_shuffled_for_it(frame, rows):
    pairs = frame("plant string, postcode6 string", ("P", "1234AB"), ("P", "1234AC"), ("P", "9999ZZ"), ("Q", None)).repartition(2)
    found = checks.postcode_sizes(pairs, distinct=True)
    assert rows(found) == [("P", 3, 2), ("Q", 0, 0)]
    plans = [checks.postcode_sizes(pairs, distinct=d)._jdf.queryExecution().executedPlan().toString().count("HashAggregate") for d in (True, False)]
    assert plans[0] < plans[1]
