import json
import sqlite3
import struct

import pyarrow.parquet as pq
import pytest

from oreweave.__main__ import main
from oreweave.functions.wkb import parse_parts, polygon_wkb
from oreweave.plans.pipelines import ingest_delimited
from oreweave.sources.delimited import choose_delimiter, read_delimited
from oreweave.sources.documents import RuleExtractor
from oreweave.sources.geoparquet import csv_bytes, layer_of_upload, load_if_present, read_geoparquet, with_points, write_geoparquet
from oreweave.sources.vector import check_crs, load_geology
from oreweave.streaming.landing import ingest_available, stream_registry

HEAD = "i\tdep_id\tname\tdev_stat\turl\tcode_list\tlongitude\tlatitude\n"
SQUARE = [(0.0, 0.0), (0.0, 4.0), (4.0, 4.0), (4.0, 0.0), (0.0, 0.0)]  # clockwise, as a shapefile's outer ring


def test_delimited(spark, tmp_path):
    assert [choose_delimiter(h) for h in ("a\tb, c", "a,b", "a|b|c", "a;b", "", '"a,b"\tc')] == ["\t", ",", "|", ";", "\t", "\t"]
    f = tmp_path / "r.tsv"
    f.write_text(HEAD + '1\t10\t"say ""hi"""\tP\tu\t AU CU \t-132.05\t55.1\n2\t11\tshort\n')
    rows = read_delimited(spark, str(f)).orderBy("_ord").collect()
    assert rows[0]["name"] == 'say "hi"' and rows[0]["code_list"] == " AU CU " and rows[1]["latitude"] is None
    assert [r["record_id"] for r in ingest_delimited(spark, str(f)).collect()] == ["10"]


def test_geoparquet_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("1", 1.0, 2.0, ["a"]), ("2", None, 2.0, [])], "record_id string, latitude double, longitude double, commodities array<string>")
    out = str(tmp_path / "geo")
    files = write_geoparquet(with_points(df), out, single_file=True).collect()
    assert json.loads(pq.read_metadata(files[0]["file"]).metadata[b"geo"])["columns"]["geometry"]["encoding"] == "WKB"
    back = {r["record_id"]: r["geometry"] for r in read_geoparquet(spark, out).collect()}
    assert struct.unpack_from("<dd", bytes(back["1"]), 5) == (2.0, 1.0) and back["2"] is None
    assert b'["a"]' in csv_bytes(df).replace(b'""', b'"') and load_if_present(spark, str(tmp_path / "none")) is None
    assert layer_of_upload(["a.shp", "b.dbf"]) == "a.shp"


def test_a_table_is_written_onto_itself_and_survives_a_failure(spark, tmp_path):
    from oreweave.sources.geoparquet import geoparquet_bytes

    out = str(tmp_path / "geo")
    df = spark.createDataFrame([(str(i), float(i), 2.0) for i in range(9)], "record_id string, latitude double, longitude double").repartition(3)
    write_geoparquet(df, out)
    write_geoparquet(read_geoparquet(spark, out).where("latitude > 3"), out)
    assert read_geoparquet(spark, out).count() == 5
    with pytest.raises(Exception, match="boom"):
        write_geoparquet(read_geoparquet(spark, out).selectExpr("raise_error('boom') AS record_id", "latitude", "longitude", "geometry"), out)
    assert read_geoparquet(spark, out).count() == 5
    write_geoparquet(df.limit(0), "file:" + out)
    assert read_geoparquet(spark, out).count() == 0 and "geometry" in spark.read.parquet(out).columns
    table = pq.read_table(__import__("io").BytesIO(geoparquet_bytes(df)))
    assert table.num_rows == 9 and b"geo" in table.schema.metadata
    assert csv_bytes(df).count(b"\n") == 10


def test_points_without_coordinate_columns(spark, tmp_path):
    from oreweave.plans.pipelines import enrich

    df = with_points(spark.createDataFrame([("1", 1.0, 2.0), ("2", None, 2.0)], "record_id string, latitude double, longitude double"))
    df.drop("latitude", "longitude").write.parquet(str(tmp_path / "bare"))
    back = read_geoparquet(spark, str(tmp_path / "bare"))
    assert sorted((r["record_id"], r["latitude"], r["longitude"]) for r in back.collect()) == [("1", 1.0, 2.0), ("2", None, None)]
    shapefile(tmp_path / "units")
    rich = {r["record_id"]: r["geologic_unit"] for r in enrich(back, load_geology(spark, str(tmp_path / "units.shp"))).collect()}
    assert rich == {"1": "Tuff bed", "2": None}


def test_verbs_quality_and_dropped_rows(spark, tmp_path, capsys):
    import oreweave

    assert all(callable(getattr(oreweave, v)) for v in oreweave.__all__)
    (tmp_path / "r.tsv").write_text(HEAD + "1\t10\tA\tP\tu\tAG\t-106.9\t37.8\n2\t\tB\tP\tu\tAU\t1\t1\n3\t12\tC\tP\tu\tAU\t1\t95\n")
    main(["ingest", str(tmp_path / "r.tsv"), "-o", str(tmp_path / "reg")])
    assert json.loads(capsys.readouterr().out)["dropped"] == {"no_id": 1, "out_of_range": 1}
    main(["quality", str(tmp_path / "reg")])
    shown = json.loads(capsys.readouterr().out)
    assert shown["rows"] == 1 and shown["rows_with_geometry"] == 1 and shown["commodity_examples"] == [["silver"]]


def shapefile(base):
    points = b"".join(struct.pack("<dd", *p) for p in SQUARE)
    body = struct.pack("<i4d", 5, 0, 0, 4, 4) + struct.pack("<iii", 1, len(SQUARE), 0) + points
    record = struct.pack(">ii", 1, len(body) // 2) + body
    (base.with_suffix(".shp")).write_bytes(struct.pack(">i", 9994) + bytes(96) + record)
    field = b"UNIT_NAME".ljust(11, b"\0") + b"C" + bytes(4) + bytes([10]) + bytes(15)
    dbf = struct.pack("<BBBBIHH", 3, 24, 1, 1, 1, 32 + 32 + 1, 11) + bytes(20) + field + b"\r" + b" " + b"Tuff bed".ljust(10)
    (base.with_suffix(".dbf")).write_bytes(dbf)
    (base.with_suffix(".prj")).write_text('GEOGCS["GCS_WGS_1984"]')


def test_layers(spark, tmp_path):
    shapefile(tmp_path / "units")
    row = load_geology(spark, str(tmp_path / "units.shp")).first()
    assert row["geologic_unit"] == "Tuff bed" and len(parse_parts(bytes(row["geometry"]))[0][0]) == 5
    feature = {"type": "Feature", "properties": {"Unit_Name": "B", "age": "Eocene"}, "geometry": {"type": "Polygon", "coordinates": [[list(p) for p in SQUARE]]}}
    (tmp_path / "u.geojson").write_text(json.dumps({"type": "FeatureCollection", "features": [feature]}))
    row = load_geology(spark, str(tmp_path / "u.geojson")).first()
    assert (row["geologic_unit"], row["geologic_age_raw"]) == ("B", "Eocene") and row["geometry"] is not None
    with sqlite3.connect(tmp_path / "u.gpkg") as db:
        db.execute("create table gpkg_geometry_columns (table_name text, column_name text, srs_id int)")
        db.execute("insert into gpkg_geometry_columns values ('u', 'geom', 4326)")
        db.execute("create table u (NAME text, geom blob)")
        db.execute("insert into u values ('C', ?)", (b"GP\0\x01" + struct.pack("<i", 4326) + polygon_wkb([SQUARE]),))
    assert load_geology(spark, str(tmp_path / "u.gpkg")).first()["geologic_unit"] == "C"
    with pytest.raises(ValueError):
        check_crs('PROJCS["WGS_1984_UTM_Zone_13N"]')


def test_command_line(spark, tmp_path, capsys):
    (tmp_path / "r.tsv").write_text(HEAD + "1\t10\tCreede Mine\tP\tu\tAG\t-106.9\t37.8\n2\t11\tOther\tP\tu\tAU\t1\t1\n")
    (tmp_path / "docs").mkdir()
    (tmp_path / "docs" / "a.txt").write_text("The Creede Mine lies at 37.81, -106.91 and holds silver and lead. Nothing else.")
    main(["fuse", "--csv", str(tmp_path / "r.tsv"), "--pdf", str(tmp_path / "docs"), "-o", str(tmp_path / "out")])
    assert json.loads(capsys.readouterr().out)["matched"] == 1
    shapefile(tmp_path / "units")
    main(["enrich", "-i", str(tmp_path / "out"), "-s", str(tmp_path / "units.shp"), "-o", str(tmp_path / "rich")])
    assert json.loads(capsys.readouterr().out) == {"total_deposits": 2, "matched_geology": 1, "matched_percent": 50.0, "rows_with_coordinates": 2}
    assert json.loads(RuleExtractor()("No site here."))["deposits"] == []


def test_landing_stream(spark, tmp_path):
    folder, target, check = tmp_path / "in", str(tmp_path / "table"), str(tmp_path / "check")
    folder.mkdir()
    columns = HEAD.strip().split("\t")
    (folder / "1.tsv").write_text(HEAD + "1\t10\ta\tP\tu\tAG\t1\t1\n2\t10\ta\tP\tu\tAG\t1\t1\n")
    ingest_available(stream_registry(spark, str(folder), columns), target, check)
    (folder / "2.tsv").write_text(HEAD + "1\t10\ta\tP\tu\tAG\t1\t1\n2\t12\tb\tP\tu\tAG\t1\t1\n")
    ingest_available(stream_registry(spark, str(folder), columns), target, check)
    assert sorted(r["record_id"] for r in spark.read.parquet(target).collect()) == ["10", "12"]
