"""Folder scans and outputs on invented files in the input shapes."""

import datetime as dt
import gzip
import json

import pytest
from pyspark.sql import functions as F

from tracewater.sources import readers, schemas, sinks
from tracewater.session import shared_folder

HEADER = "Stofgroep\tStofnaam\tCAS-nummer\tAfdeling\tBranche\tSubbranche\tCompartiment\tEmissiestatus\t\n"


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")


def test_navigator_files(spark, tmp_path, rows):
    write(tmp_path / "a_branche.txt", "﻿" + HEADER + "ZZS Metalen\tlood\t7439-92-1\t3.6\tB1\t\tWater\tEmissie mogelijk\n"
          + "ZZS Metalen\t\t\t3.6\tB1\t\tWater\tEmissie mogelijk\n")
    write(tmp_path / "b_branche.txt", "﻿" + HEADER)
    write(tmp_path / "c_afdeling.txt", "﻿" + HEADER + "Individuele stoffen\tformaldehyde\tNA\t3.6\t\t\tWater\tEmissie verwacht\n")
    write(tmp_path / "skip.csv", "x\ty\n")
    got = readers.scan_delimited(spark, str(tmp_path), schemas.NAVIGATOR, pattern="*.txt")
    assert got.columns == ["file", "substance_group", "substance", "cas", "division", "branch", "sub_branch", "compartment", "emission_status"]
    found = rows(got.withColumn("file", F.regexp_extract("file", "([^/]*)$", 1)))
    assert ("a_branche.txt", "ZZS Metalen", "lood", "7439-92-1", "3.6", "B1", None, "Water", "Emissie mogelijk") in found
    assert ("c_afdeling.txt", "Individuele stoffen", "formaldehyde", None, "3.6", None, None, "Water", "Emissie verwacht") in found
    assert len(found) == 3


def test_score_files(spark, tmp_path):
    names = ["CAS  RN", "Name"] + [f"{s}-score{x}" for s in ("PMT", "P", "M", "T") for x in ("", " Classification", " Explanation")]
    line = ["100-44-7", "benzyl, chloride", "0.42", "High", "text"] + ["0.18", "Low to moderate", "why"] * 3
    write(tmp_path / "20_scores.csv", "﻿" + "\t".join(names) + "\n" + "\t".join(line) + "\n")
    row = readers.scan_delimited(spark, str(tmp_path), schemas.PMT).first()
    assert (row.cas, row.pmt_name, row.pmt_score, row.t_class) == ("100-44-7", "benzyl, chloride", 0.42, "Low to moderate")
    assert len(schemas.PMT_COLUMNS) == 13


def test_newest_export_picks_the_latest_file(spark, tmp_path):
    for name, value in [("ER_Export-2024-01-05-101010.csv", "old"), ("ER_Export-2024-02-01-000000.csv", "new"),
                        ("ER_Export-kopie.csv", "bad"), ("Other-2025-01-01-000000.csv", "other")]:
        write(tmp_path / name, f"v\n{value}\n")
    got = readers.scan_newest_export(
        spark, str(tmp_path), lambda p: readers.scan_delimited(spark, p, schemas.struct("v"), file_column=None), "ER_Export*.csv"
    )
    assert [r.v for r in got.collect()] == ["new"]
    with pytest.raises(FileNotFoundError):
        readers.newest_export(spark, str(tmp_path), "Nothing*")


def test_plant_from_file_name(spark, tmp_path, rows):
    write(tmp_path / "Bath_ZZS.csv", "v\n1\n")
    write(tmp_path / "Den Bosch_ZZS.csv", "v\n2\n")
    found = readers.scan_delimited(spark, str(tmp_path), schemas.struct("v"))
    assert rows(readers.scan_with_name_part(found, "plant", "/([^/]+)_ZZS")) == [("1", "Bath"), ("2", "Den Bosch")]


def test_landed_sheet_skips_title_lines(spark, tmp_path, rows):
    write(tmp_path / "s1.csv", "﻿Bijlage 3\n\nAfdeling;Branche;Subbranche;SBI;naam;nr\n3.6;B1;;20,1;chemie;3.6.1\n3.7;NA;;1;x;3.7.1\n")
    write(tmp_path / "s2.csv", "Bijlage 3\r\n\r\nAfdeling;Branche;Subbranche;SBI;naam;nr\r\n3.8;B2;S;2;y;3.8.1\r\n")
    got = readers.scan_landed(spark, str(tmp_path), schemas.ACTIVITY, preamble=2)
    assert rows(got.select("division", "branch", "sub_branch", "code")) == [("3.6", "B1", None, "20,1"), ("3.7", None, None, "1"), ("3.8", "B2", "S", "2")]


def test_pages_keep_one_row_per_id(spark, tmp_path, rows):
    write(tmp_path / "page0.csv", "id;v\n1;a\n2;b\n")
    write(tmp_path / "page1.csv", "id;v\n2;b\n3;c\n")
    assert rows(readers.scan_pages(spark, str(tmp_path), schemas.struct("id v"), ["id"])) == [("1", "a"), ("2", "b"), ("3", "c")]


def test_domain_table(spark, tmp_path):
    write(tmp_path / "p.csv", "X1;Omschrijving;Codes;Begin geldigheid;Eind geldigheid;Id\ng1;lood;Pb;1 mei 2010;31 december 2099;7\n")
    row = readers.scan_domain_table(spark, str(tmp_path)).first()
    assert row.asDict() == {"id": "7", "codes": "Pb", "omschrijving": "lood", "begin_geldigheid": dt.date(2010, 5, 1),
                            "eind_geldigheid": dt.date(2099, 12, 31), "guid": "g1"}


def test_domain_overview(spark, tmp_path):
    write(tmp_path / "o.csv", "X1;Elementtype;Voorkeurslabel;Metadata;Wijzigingsdatum;Begin geldigheid;Eind geldigheid\n"
          "g;Domeintabel;Parameter;Id,Codes,Omschrijving;3 mei 2024 10:00:00;1 januari 2011;31 december 2099\n")
    row = readers.scan_domain_overview(spark, str(tmp_path)).first()
    assert (row.domain_table, row.kind, row.guid, row.columns) == ("Parameter", "Domeintabel", "g", ["Id", "Codes", "Omschrijving"])
    assert (row.wijzigingsdatum, row.begin_geldigheid) == (dt.date(2024, 5, 3), dt.date(2011, 1, 1))


def test_headers_of_every_shape_in_one_scan(spark, tmp_path, rows, monkeypatch):
    """Columns in any order, absent ones, a mark, packed files, empty files; the same by either way to the first lines."""
    for i in range(6):
        write(tmp_path / "in" / f"plain {i}.csv", f"a;b;c\n{i};x;y\n")
    write(tmp_path / "in" / "turned.csv", "\ufeffc;a;b\r\nturned;7;NA\r\n")
    write(tmp_path / "in" / "short.csv", 'b;a\n"q;""r""";8\n;9;more than titles\n')
    write(tmp_path / "in" / "empty.csv", "")
    with gzip.open(tmp_path / "in" / "packed.csv.gz", "wt") as out:
        out.write("c;b;a\np;q;10\n")

    def scan():
        return readers.scan_delimited(spark, str(tmp_path / "in"), schemas.struct("a b c"), sep=";", names={}, optional=["c"], file_column=None)

    want = sorted([*[(str(i), "x", "y") for i in range(6)], ("7", None, "turned"), ("8", 'q;"r"', None), ("9", None, None), ("10", "q", "p")], key=str)
    assert sorted(rows(scan()), key=str) == want
    assert scan()._jdf.queryExecution().optimizedPlan().toString().count("Relation") == 2  # the rows, and the other headers
    monkeypatch.setattr(readers, "_scheme", lambda spark, folder: "store")
    assert sorted(rows(scan()), key=str) == want
    with pytest.raises(ValueError, match="c"):
        readers.scan_delimited(spark, str(tmp_path / "in"), schemas.struct("a b c"), sep=";", names={})


def test_first_lines_are_all_that_is_read(spark, tmp_path, rows):
    """The scan lists paths without contents; a task opens them and stops after the asked lines."""
    write(tmp_path / "a.txt", "one\n\nthree\nfour\n")
    (tmp_path / "b.txt").write_bytes(b"only")
    found = readers._first_lines(spark, str(tmp_path), 3, "*.txt")
    got = rows(found.select(F.regexp_extract("path", "([^/]*)$", 1), "line", "value"))
    assert sorted(got) == [("a.txt", 1, "one"), ("a.txt", 2, ""), ("a.txt", 3, "three"), ("b.txt", 1, "only")]
    assert "content" not in found._jdf.queryExecution().executedPlan().toString().split("ReadSchema")[1]


def test_feature_collection(spark, tmp_path):
    square = [[0, 0, 9], [1, 0, 9], [1, 1, 9], [0, 0, 9]]
    doc = {"type": "FeatureCollection", "features": [
        {"type": "Feature", "properties": {"naam": "Bath", "n": 1}, "geometry": {"type": "Polygon", "coordinates": [square, square]}},
        {"type": "Feature", "properties": {"naam": "Dinther", "n": 2}, "geometry": {"type": "MultiPolygon", "coordinates": [[square], [square], [square]]}},
    ]}
    write(tmp_path / "page.json", json.dumps(doc, indent=1))
    got = {r.naam: r for r in readers.scan_polygons(spark, str(tmp_path), {"naam": "string", "n": "int"}).collect()}
    assert len(got["Bath"].rings) == 2 and len(got["Dinther"].rings) == 3 and got["Dinther"].n == 2
    assert [tuple(p) for p in got["Bath"].rings[0]] == [(0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 0.0)]


def test_comma_csv_has_mark_and_commas(spark, tmp_path, frame):
    out = str(tmp_path / "out")
    sinks.write_comma_csv(frame("naam string, waarde double", ("é", 1.5)).coalesce(1), out)
    part = next((tmp_path / "out").glob("part-*.csv"))
    assert part.read_bytes().decode("utf-8") == "﻿naam;waarde\né;1,5\n"


def test_report_folder_and_per_value_output(spark, tmp_path, frame, rows):
    folder = sinks.write_report(frame("a int", (1,)), str(tmp_path / "r"), dt.date(2024, 5, 1))
    assert folder.endswith("r/run_date=2024-05-01")
    df = frame("rwzi string, v int", ("Bath", 1), ("Dinther", 2))
    sinks.write_per_value(df, str(tmp_path / "p"), "rwzi")
    assert sorted(p.name for p in (tmp_path / "p").glob("rwzi=*")) == ["rwzi=Bath", "rwzi=Dinther"]
    assert rows(spark.read.parquet(str(tmp_path / "p")).select("rwzi", "v")) == [("Bath", 1), ("Dinther", 2)]


def test_stage_and_shared_folder(spark, frame):
    folder = shared_folder(spark, "x")
    assert folder != shared_folder(spark, "x")
    staged = sinks.write_stage(frame("a int", (1,), (2,)), folder)
    assert staged.count() == 2
    assert "FileScan parquet" in staged._jdf.queryExecution().toString()


def test_shared_folder_follows_the_cluster_setting():
    class Conf(dict):
        def get(self, key, default=None):
            return dict.get(self, key, default)

        def set(self, key, value):
            self[key] = value

    class Session:
        conf = Conf({"spark.checkpoint.dir": "hdfs://shared/checkpoints/"})

    assert shared_folder(Session(), "bridge").startswith("hdfs://shared/checkpoints/bridge-")

    class Dir:
        def __init__(self, value):
            self.value = value

        def isDefined(self):  # noqa: N802
            return self.value is not None

        def get(self):
            return self.value

    def bare(master, checkpoint_dir):
        inner = type("Inner", (), {"getCheckpointDir": lambda self: Dir(checkpoint_dir)})()
        outer = type("Outer", (), {"sc": lambda self: inner})()
        context = type("Context", (), {"_jsc": outer, "master": master})()
        return type("Bare", (), {"conf": Conf(), "sparkContext": context})()

    assert shared_folder(bare("spark://host:7077", "hdfs://set/dir"), "x").startswith("hdfs://set/dir/x-")
    for master in ("spark://host:7077", "local-cluster[3,2,1024]"):
        with pytest.raises(ValueError, match="checkpoint.dir"):
            shared_folder(bare(master, None), "x")
    assert "tracewater-" in shared_folder(bare("local[2]", None), "x")
    assert "tracewater.shared.dir" not in Session.conf


def test_columns_go_by_name_in_any_order(spark, tmp_path, rows):
    folder = tmp_path / "named"
    folder.mkdir()
    (folder / "a.txt").write_text('\ufeffName;CAS  RN\n"say ""hi""; now";1\nNA;2\n', encoding="utf-8")
    (folder / "b.txt").write_text("CAS  RN;Name;Extra\n3;y;z\n", encoding="utf-8")
    (folder / "c.txt").write_text("CAS  RN\n4\n", encoding="utf-8")
    names = {"CAS  RN": "cas", "Name": "name"}
    got = readers.scan_delimited(spark, str(folder), schemas.struct("cas name"), sep=";", file_column=None, names=names, optional=["name"])
    assert rows(got) == [("1", 'say "hi"; now'), ("2", None), ("3", "y"), ("4", None)] or set(rows(got)) == {
        ("1", 'say "hi"; now'), ("2", None), ("3", "y"), ("4", None)
    }
    with pytest.raises(ValueError, match="name"):
        readers.scan_delimited(spark, str(folder), schemas.struct("cas name"), sep=";", names=names)


def test_domain_tables_of_different_shapes(spark, tmp_path):
    folder = tmp_path / "domain"
    folder.mkdir()
    (folder / "a.csv").write_text(";Codes;Begin geldigheid\ng1;x;01-02-2020\n", encoding="utf-8")
    (folder / "b.csv").write_text("Codes;Extra;\ny;e;g2\n", encoding="utf-8")
    table = readers.scan_domain_table(spark, str(folder))
    got = {(r.guid, r.codes, r.extra, str(r.begin_geldigheid)) for r in table.collect()}
    assert got == {("g1", "x", None, "2020-02-01"), ("g2", "y", "e", "None")}


def test_comma_csv_round_trip_of_quotes(spark, frame, tmp_path, rows):
    df = frame("id string, v double", ('a "b"; c', 4e-16), ("NA?", None))
    sinks.write_comma_csv(df, str(tmp_path / "q"))
    raw = "".join(p.read_text(encoding="utf-8") for p in (tmp_path / "q").glob("*.csv"))
    assert '"a ""b""; c"' in raw and "0,0000000000000004" in raw
    back = readers.scan_delimited(spark, str(tmp_path / "q"), schemas.struct("id v"), sep=";", file_column=None)
    assert set(rows(back)) == {('a "b"; c', "0,0000000000000004"), ("NA?", None)}


def test_refresh_replaces_only_the_values_it_holds(spark, tmp_path):
    folder = str(tmp_path / "plants")
    first = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), (None, 4)], "plant string, v int")
    sinks.write_per_value(first, folder, "plant")

    def files(value):
        found = sorted((tmp_path / "plants" / f"plant={value}").glob("*.parquet"))
        return [(f.name, f.stat().st_mtime_ns) for f in found]

    kept, replaced = files("b"), files("a")
    manifest = sinks.refresh_per_value(spark.createDataFrame([("a", 9), ("c", 5), (None, 6)], "plant string, v int"), folder, "plant")
    assert files("b") == kept and kept and files("a") != replaced
    assert {(r.plant, r.v) for r in spark.read.parquet(folder).collect()} == {("a", 9), ("b", 3), ("c", 5), (None, 6)}
    assert {(r.plant, r.n_rows) for r in manifest.collect()} == {("a", 1), ("c", 1), (None, 1)}
    sinks.refresh_per_value(first.limit(0), folder, "plant")
    assert spark.read.parquet(folder).count() == 4
