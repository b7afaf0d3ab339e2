"""Annotation filters, splits, near-duplicates, vectors, quality, files and contracts."""

from __future__ import annotations

import base64
import io
import json
import random
import struct
import zipfile
import zlib

import numpy as np
import pytest
from conftest import listed, rows
from pyspark.sql import functions as F

from claimweave.functions import filenames
from claimweave.functions import geometry as geo
from claimweave.operators import annotations as ann
from claimweave.operators import neardup, quality, relabel, split, validate
from claimweave.sinks import files as sinks
from claimweave.sources import files as sources


def column(spark, value, schema, expr):
    return spark.createDataFrame([(value,)], schema).select(expr).first()[0]


# --- names and shapes


def test_numbers_in_file_names(spark):
    names = {
        "2024/09/Car_00000236__002.jpg": ("236", "2"), "car-000230_1_jpg.rf.afe14dce.jpg": ("230", "1"), "lote11/coche 000250 2.jpeg": ("250", "2"), "VEHICULO_102_FOTO_1.WEBP": ("102", "1"), "CAR0008054-11.JPG": ("8054", "11"), "Veh004930.6.bmp": ("4930", "6"),
        "aug/veh_3668_1_bright.png": ("3668", "1"), "flota/veh_62_3.png": ("62", "3"), "car9.jpg": ("9", None), "car_000.jpg": ("0", None), "IMG_20241010_105400.jpg": (None, None), "DSC39623.JPG": (None, None), "foto 2024-11-20 02.30.jpeg": (None, None),
        "car12/image (14).png": (None, None), "422da2936629e326.jpg": (None, None), "scar12_1.jpg": (None, None), "": (None, None), None: (None, None),
    }
    df = spark.createDataFrame([(n,) for n in names], "n string").select("n", filenames.vehicle_number(F.col("n")).alias("v"), filenames.shot_number(F.col("n")).alias("s"))
    assert {r["n"]: (r["v"], r["s"]) for r in df.collect()} == names


def test_polygons(spark):
    p = [0.0, 0.0, 4.0, 0.0, 4.0, 3.0, 0.0, 3.0]
    assert column(spark, p, "p array<double>", geo.shoelace_area(F.col("p"))) == 12.0
    assert column(spark, p, "p array<double>", geo.polygon_box(F.col("p"))) == [0.0, 0.0, 4.0, 3.0]
    assert column(spark, p[:4], "p array<double>", geo.shoelace_area(F.col("p"))) == 0.0
    assert column(spark, p, "p array<double>", geo.normalise_polygon(F.col("p"), F.lit(2.0), F.lit(6.0))) == [0.0, 0.0, 1.0, 0.0, 1.0, 0.5, 0.0, 0.5]
    assert column(spark, p, "p array<double>", geo.normalise_polygon(F.col("p"), F.lit(0), F.lit(6))) == []
    assert column(spark, p[:6], "p array<double>", geo.normalise_polygon(F.col("p"), F.lit(2), F.lit(6))) == []
    assert column(spark, [0.5, 0.25], "p array<double>", geo.label_line(F.lit(3), F.col("p"))) == "3 0.500000 0.250000"
    assert column(spark, "1,2;3.25,4", "p string", geo.parse_points(F.col("p"))) == [1.0, 2.0, 3.25, 4.0]
    assert column(spark, [1.0, 2.0, 3.25, 4.0], "p array<double>", geo.format_points(F.col("p"))) in ("1.0,2.0;3.3,4.0", "1.0,2.0;3.2,4.0")
    assert column(spark, [1.0, 2.0, 0.0, 4.0], "b array<double>", geo.valid_box(F.col("b"))) is False
    assert column(spark, None, "b array<double>", geo.valid_box(F.col("b"))) is False
    assert column(spark, [0.0, 0.0, 10.0, 10.0], "b array<double>", geo.overlap_share(F.col("b"), F.array(*[F.lit(v) for v in (5.0, 5.0, 20.0, 20.0)]))) == 0.25
    assert column(spark, [900.0, 900.0, 5.0, 5.0], "b array<double>", geo.padded_crop(F.col("b"), F.lit(100), F.lit(100))) == [0, 0, 8, 8]


# --- annotations


def test_class_mapping(spark):
    labels = {"Dent": "dent", "DENT": "dent", "Tire Flat": None, "damage": None, "Damage": None, "DAMAGE": None, "mop_lom": "dent", "tire thing": None, "new": None, None: None}
    df = spark.createDataFrame([(k,) for k in labels], "l string")
    assert {r[0]: r[1] for r in df.select("l", ann.map_class(F.col("l"))).collect()} == labels


def test_area_and_outline_filters(spark):
    df = spark.createDataFrame([(1, 0.0), (2, 50.0), (3, 100.0), (4, None)], "id int, area double")
    assert rows(ann.drop_small(df, 100.0).select("id")) == {(1,), (3,), (4,)}
    p8, p6 = [0.0] * 8, [0.0] * 6
    shapes = spark.createDataFrame([(1, [p8, p6]), (2, [p6]), (3, []), (4, None)], "id int, polygons array<array<double>>")
    assert {r["id"]: None if r["polygons"] is None else len(r["polygons"]) for r in ann.drop_thin(shapes, "polygons").collect()} == {1: 1, 3: 0, 4: None}


def test_merge_moves_ids_past_the_largest(spark):
    images = lambda *i: spark.createDataFrame([(x,) for x in i], "id bigint")
    anns = lambda *a: spark.createDataFrame(list(a), "id bigint, image_id bigint")
    _, out = ann.rebase_ids([(images(1, 9), anns((5, 9))), (images(), anns()), (images(1), anns((1, 1), (2, 77)))])
    assert rows(out) == {(5, 9), (7, 11), (8, 77)}


def test_dense_ids(spark):
    df = spark.createDataFrame([(f"i{n % 7}", n) for n in range(50)], "image string, pos int")
    got = {r["image"]: r["image_id"] for r in ann.dense_image_ids(df, "image", "pos").select("image", "image_id").distinct().collect()}
    assert got == {f"i{n}": n for n in range(7)}


def test_mask_gate(spark):
    df = spark.createDataFrame([(80.0, 100.0, 100.0), (99.0, 100.0, 100.0), (0.0, 100.0, 0.0), (10.0, 10.0, 90.0)], "intersection double, area_old double, area_new double")
    assert [r["verdict"] for r in ann.mask_gate(df).collect()] == ["accepted", "rejected", "skip_empty", "rejected"]


# --- splits


def test_groups_stay_whole_and_ratios_hold(spark):
    images = spark.createDataFrame([(v * 3 + s, f"car{v:03d}_{s}.jpg") for v in range(60) for s in range(3)], "id bigint, file_name string")
    keyed = images.withColumn("k", split.group_key(F.col("file_name"), r"(car\d+)"))
    groups = split.image_groups(keyed, "k")
    assert groups.select("group_id").distinct().count() == 60
    notes = spark.createDataFrame([(i, i % 3) for i in range(0, 150)], "image_id bigint, label int").withColumn("pos", F.col("image_id"))
    out = split.grouped_split(groups, notes, "label", "pos")
    assert out.count() == 180 and split.crossing_groups(out).count() == 0
    share = {r["split"]: r["n"] / 60 for r in out.select("group_id", "split").distinct().groupBy("split").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert abs(share["train"] - 0.7) < 0.05
    assert listed(split.grouped_split(groups, notes, "label", "pos")) == listed(out)


def test_near_pairs_join_groups(spark):
    images = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id bigint, k string")
    pairs = spark.createDataFrame([(2, 3)], "id_a bigint, id_b bigint")
    assert rows(split.image_groups(images, "k", pairs)) == {(1, 1), (2, 2), (3, 2)}


def test_greedy_patterns_do_not_merge_everything(spark):
    df = spark.createDataFrame([("x/veh0001.jpg",), ("veh0002.jpg",), ("noext",)], "f string")
    assert [r[0] for r in df.select(split.group_key(F.col("f"), None)).collect()] == ["veh0001", "veh0002", "noext"]
    assert [r[0] for r in df.select(split.group_key(F.col("f"), r"(zzz)")).collect()] == ["veh0001", "veh0002", "noext"]


# --- near-duplicates and vectors


def test_near_pairs_against_brute_force(spark):
    rng = random.Random(2)
    codes = [rng.getrandbits(64) for _ in range(30)]
    codes += [c ^ (1 << rng.randrange(64)) for c in codes[:10]] + [codes[0]] * 3
    signed = [(i, c - 2**64 if c >= 2**63 else c) for i, c in enumerate(codes)] + [(999, None)]
    got = rows(neardup.near_pairs(spark.createDataFrame(signed, "id bigint, h bigint"), "id", "h", 6))
    want = {(a, b, bin(codes[a] ^ codes[b]).count("1")) for a in range(len(codes)) for b in range(a + 1, len(codes)) if bin(codes[a] ^ codes[b]).count("1") <= 6}
    assert got == want


def test_relabelling(spark):
    protos = spark.createDataFrame([("a", [1.0, 0.0]), ("b", [0.0, 1.0])], "fine string, prototype array<double>")
    df = spark.createDataFrame([(1, "one", [0.0, 2.0]), (2, "two", [0.0, 2.0]), (3, "two", None), (4, "none", [1.0, 1.0]), (5, None, None)], "id int, coarse string, v array<double>")
    out = {r["id"]: tuple(r)[1:] for r in relabel.assign_fine(df, "id", "coarse", "v", {"one": ("a",), "two": ("a", "b")}, protos).collect()}
    assert out[1] == ("a", 1.0, "direct", False)
    assert out[2][0] == "b" and out[2][2:] == ("classifier", False)
    assert out[3] == ("a", 0.0, "first_candidate", True)
    assert out[4] == out[5] == (None, 0.0, "unmapped", True)


def test_spot_check_rows_come_once(spark):
    df = spark.createDataFrame([(i, "x", i / 10) for i in range(4)] + [(100 + i, "y", 0.5) for i in range(20)], "id int, label string, score double")
    out = relabel.spot_check(df, "label", "score", "id", 6)
    assert out.where("label = 'x'").count() == 4 and out.where("label = 'y'").count() in range(3, 7)


# --- quality


def png(path, pixels):
    h, w, _ = pixels.shape
    raw = b"".join(b"\0" + pixels[y].astype("uint8").tobytes() for y in range(h))
    chunk = lambda t, d: struct.pack(">I", len(d)) + t + d + struct.pack(">I", zlib.crc32(t + d))
    path.write_bytes(b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 2, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b""))


@pytest.fixture(scope="module")
def pictures(tmp_path_factory):
    folder = tmp_path_factory.mktemp("img")
    board = np.full((600, 800, 3), 127)
    yy, xx = np.mgrid[120:480, 160:640]
    board[120:480, 160:640] = np.where(((yy // 8 + xx // 8) % 2)[..., None], 185, 70)
    png(folder / "board.png", board)
    png(folder / "copy.png", np.clip(board - 9, 0, 255))
    png(folder / "dark.png", np.full((600, 800, 3), 4))
    png(folder / "small.PNG", board[::3, ::3])
    (folder / "broken.jpg").write_bytes(b"\xff\xd8nothing")
    (folder / "notes.txt").write_text("x")
    return str(folder)


def test_image_statistics_and_verdict(spark, pictures):
    stats = quality.image_stats(sources.read_images(spark, pictures)).withColumn("name", filenames.base_name(F.col("origin")))
    got = {r["name"]: r for r in quality.verdict(stats.withColumns({"vehicle_detected": F.lit(True), "vehicle_area_fraction": F.lit(0.4)})).collect()}
    assert got["board.png"]["valid"] and got["board.png"]["sharpness"] > 80
    assert got["dark.png"]["problems"] == ["blurry", "underexposed"]
    assert "low_resolution" in got["small.PNG"]["problems"]
    assert got["broken.jpg"]["readable"] is False and got["broken.jpg"]["sharpness"] is None
    assert bin((got["board.png"]["dhash"] ^ got["copy.png"]["dhash"]) & (2**64 - 1)).count("1") <= 6
    assert sources.list_images(spark, pictures).count() == 5
    assert sources.hash_files(spark, pictures, "*.txt").first()["sha256"] == "2d711642b726b04401627ca9fbac32f5c8530fb1903cc4db02258717921a4881"


def test_union_of_boxes_is_no_sum(spark):
    df = spark.createDataFrame([(1, 0.0, 0.0, 50.0, 50.0, 100.0, 100.0), (1, 25.0, 25.0, 75.0, 75.0, 100.0, 100.0), (2, 0.0, 0.0, 100.0, 100.0, 100.0, 100.0)], "image_id int, x1 double, y1 double, x2 double, y2 double, width double, height double")
    got = {r["image_id"]: (round(r["fraction"], 4), r["hull"]) for r in quality.union_area(df).collect()}
    assert got == {1: (0.4375, [0.0, 0.0, 75.0, 75.0]), 2: (1.0, [0.0, 0.0, 100.0, 100.0])}


def test_unions_of_many_images_are_computed_together(spark):
    rng = np.random.default_rng(5)
    data = []
    for image in [None, *range(60)]:
        for _ in range(1 if image == 1 else 40 if image == 2 else rng.integers(1, 13)):
            x, y, w, h = (float(v) for v in rng.integers(0, 30, 4))
            data.append((image, x, y, x + w, y + h, 64.0, 0.0 if image == 3 else 64.0))
    df = spark.createDataFrame(data, "image_id int, x1 double, y1 double, x2 double, y2 double, width double, height double")
    want = {}
    for image in {r[0] for r in data}:
        grid, mine = np.zeros((64, 64), bool), [r for r in data if r[0] == image]
        for _, x1, y1, x2, y2, _, _ in mine:
            grid[int(y1) : int(y2), int(x1) : int(x2)] = True
        hull = [min(r[1] for r in mine), min(r[2] for r in mine), max(r[3] for r in mine), max(r[4] for r in mine)]
        want[image] = (0.0 if image == 3 else grid.sum() / 64**2, hull, len(mine))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)  # images go on over batches
    try:
        found = quality.union_area(df)
        assert {r["image_id"]: (r["fraction"], r["hull"], r["n"]) for r in found.collect()} == want
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert "FlatMapGroupsInPandas" not in found._jdf.queryExecution().executedPlan().toString()
    assert quality.union_area(df.limit(0)).count() == 0


def test_documents_are_made_and_parsed_once(spark, sf_dir):
    from claimweave.plans import exchange

    plan = exchange.output_documents(spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [l_orderkey") == plan.count("Relation [o_orderkey") == 1


# --- files


@pytest.fixture(scope="module")
def exports(tmp_path_factory):
    d = tmp_path_factory.mktemp("exports")
    coco = {
        "images": [{"id": 1, "file_name": "a.jpg", "width": 100, "height": 80}, {"id": 2, "file_name": "b.jpg", "width": 100, "height": 80}],
        "annotations": [
            {"id": 1, "image_id": 1, "category_id": 1, "segmentation": [[0, 0, 4, 0, 4, 3, 0, 3]], "bbox": [0, 0, 4, 3], "area": 12, "iscrowd": 0},
            {"id": 2, "image_id": 1, "category_id": 1, "segmentation": {"counts": [1, 2], "size": [2, 2]}, "bbox": [0, 0, 4, 3], "area": 50},
            {"id": 3, "image_id": 9, "category_id": 2, "segmentation": [], "bbox": [0, 0, 0, 3], "area": 0},
        ],
        "categories": [{"id": 1, "name": "Dent"}, {"id": 2, "name": "Tire Flat"}],
        "info": {"x": "y" * 1200},
    }
    (d / "coco").mkdir()
    (d / "coco" / "coco.json").write_text(json.dumps(coco))
    (d / "coco" / "other.json").write_text(json.dumps({"x": "y" * 1500}))
    (d / "via").mkdir()
    via = {"k1": {"name": "v.jpg", "regions": [{"all_x": [0, 4, 4, 0], "all_y": [0, 0, 3, 3], "class": "mop_lom"}, {"all_x": [0, 1], "all_y": [0, 1], "class": "rach"}, {"all_x": [0, 1, 2], "all_y": [0, 1], "class": "rach"}, {"all_x": [0, 1, 2], "all_y": [0, 1, 5], "class": "vo_kinh"}]}}
    (d / "via" / "x_via_annos.json").write_text(json.dumps(via))
    mask = np.zeros((4, 5), bool)
    mask[1:3, 1:4] = True
    buffer = io.BytesIO()
    np.save(buffer, mask)
    code = base64.b64encode(zlib.compress(buffer.getvalue())).decode()
    (d / "fo").mkdir()
    sample = {"filepath": "x/y/s.jpg", "metadata": {"width": 100, "height": 50}, "segmentations": {"detections": [{"label": "Dent", "bounding_box": [0.1, 0.2, 0.05, 0.08], "mask": {"$binary": {"base64": code}}}, {"label": "Crack", "bounding_box": [0.5, 0.5, 0.1, 0.2]}]}}
    (d / "fo" / "samples.json").write_text(json.dumps({"samples": [sample]}))
    (d / "cvat.xml").write_text(
        '<annotations><image id="0" name="a.jpg" width="10" height="10"><polygon label="dent" points="0,0;4,0;4,3;0,3"/><polygon label="odd" points="0,0;4,0;4,3;0,3"/><polygon label="dent" points="0,0;4,0;4,3"/></image>'
        '<image id="1" name="b.jpg" width="10" height="10"></image></annotations>'
    )
    with zipfile.ZipFile(d / "e.zip", "w") as z:
        z.write(d / "cvat.xml", "annotations.xml")
    return d


def test_coco_files(spark, exports):
    path = str(exports / "coco")
    assert [r["path"].rsplit("/", 1)[1] for r in sources.discover_coco(spark, path).collect()] == ["coco.json"]
    coco = sources.read_coco(spark, path, "coco.json")
    assert coco.images.count() == 2
    assert rows(coco.annotations.select("id", F.size("polygons"), "is_rle")) == {(1, 1, False), (2, None, True), (3, 0, False)} or rows(coco.annotations.select("id", "is_rle")) == {(1, False), (2, True), (3, False)}
    assert rows(sources.mapped_annotations(coco).select("id", "type")) == {(1, "dent"), (2, "dent")}
    many = sources.collect_instances(spark, [{"name": "s", "path": path, "glob": "coco.json", "file_prefix": "p_"}])
    assert rows(many.select("file_name", "coarse", "area")) == {("p_a.jpg", "Dent", 12.0), ("p_a.jpg", "Dent", 50.0)}


def test_formats_are_told_apart(spark, exports):
    kinds = {r["path"].rsplit("/", 1)[1]: r["kind"] for r in sources.sniff_format(spark, str(exports)).collect()}
    assert kinds == {"coco.json": "coco", "other.json": "unknown", "x_via_annos.json": "via", "samples.json": "fiftyone"}


def test_via_and_fiftyone(spark, exports):
    assert rows(sources.read_via(spark, str(exports / "via")).select("file_name", "type", "area")) == {("v.jpg", "dent", 12.0)}
    got = {r["type"]: r for r in sources.read_fiftyone(spark, str(exports / "fo")).collect()}
    assert got["crack"]["polygon"] == [50.0, 25.0, 60.0, 25.0, 60.0, 35.0, 50.0, 35.0] and got["crack"]["area"] == 100.0
    assert got["dent"]["polygon"] == [11.0, 11.0, 11.0, 12.0, 13.0, 12.0, 13.0, 11.0]


def test_cvat_and_containers(spark, exports, tmp_path):
    kind, path = sources.open_container(str(exports / "e.zip"), str(tmp_path))
    assert kind == "xml"
    images, polygons = sources.read_cvat(spark, path, ("dent",))
    assert images.count() == 2 and rows(polygons.select("image_id", "label", "area")) == {(0, "dent", 12.0)}
    with pytest.raises(ValueError):
        sources.open_container(str(tmp_path / "x.csv"), str(tmp_path))


def test_label_files_round_trip(spark, tmp_path):
    images = spark.createDataFrame([(1, "a.jpg", "train"), (2, "b.jpg", "val")], "id bigint, file_name string, split string")
    shapes = spark.createDataFrame([(1, 2, 5, [0.1] * 8), (1, 1, 3, [0.25] * 6)], "image_id bigint, ordinal int, class_id int, polygon array<double>")
    lines = sinks.label_lines(images, shapes)
    assert {r["stem"]: len(r["lines"]) for r in lines.collect()} == {"a": 2, "b": 0}
    assert sinks.write_label_files(lines, str(tmp_path)) == 2
    assert (tmp_path / "val" / "b.txt").read_text() == ""
    back = sources.read_labels(spark, str(tmp_path))
    assert rows(back.select("split", "stem", "class_id")) == {("train", "a", 3), ("train", "a", 5)}
    sinks.write_labels(lines, str(tmp_path / "json"))
    assert "names:\n  0: x" in sinks.dataset_yaml("d", ("x",))


def test_long_outlines_are_read_whole(spark, tmp_path):
    (tmp_path / "labels" / "train").mkdir(parents=True)
    (tmp_path / "labels" / "train" / "a.txt").write_text("1 " + " ".join(["0.5"] * 100_002) + "\n")
    assert [len(r["polygon"]) for r in sources.read_labels(spark, str(tmp_path / "labels")).collect()] == [100_002]


def test_cvat_sink_round_trips(spark, tmp_path):
    images = spark.createDataFrame([(7, 0, 'a"&.jpg', 10, 20)], "id bigint, review_order int, file_name string, width int, height int")
    shapes = spark.createDataFrame([(7, 1, "dent", [0.0, 0.0, 4.0, 0.0, 4.0, 3.0, 0.0, 3.0], 0.5), (7, 2, "dent", [0.0] * 8, 0.1)], "image_id bigint, ordinal int, label string, polygon array<double>, confidence double")
    sinks.write_cvat(sinks.cvat_images(images, shapes), str(tmp_path / "annotations.xml"))
    back, polygons = sources.read_cvat(spark, str(tmp_path / "annotations.xml"), ("dent",))
    assert back.first()["file_name"] == 'a"&.jpg' and polygons.count() == 1


def test_audit_lines_append_by_day(spark, tmp_path):
    df = spark.createDataFrame([("c", "E", ["h"], "v", "s", 3, "r", "2024-05-06T01:02:03Z", "secret"), ("d", "E", None, "v", "s", None, "r", "odd", "secret")], "claim_id string, id_evaluacion string, input_hashes array<string>, model_version string, output_summary string, processing_time_ms int, rule_id_applied string, timestamp string, name string")
    records = sinks.audit_records(df)
    sinks.append_audit(records, str(tmp_path / "log"))
    sinks.append_audit(records, str(tmp_path / "log"))
    back = spark.read.text(str(tmp_path / "log"))
    assert rows(back.groupBy(F.col("date").cast("string")).count()) == {("20240506", 2), ("undated", 2)}
    line = json.loads(back.where("date = '20240506'").first()["value"])
    assert list(line) == sorted(sinks.AUDIT_FIELDS) and "secret" not in json.dumps(line)
    assert "<td>c</td>" in sinks.html_table(df.select("claim_id"), "t")


def test_last_source_wins_in_the_manifest(spark):
    images = spark.createDataFrame([(1, "a.jpg", "train"), (2, "z.jpg", "val")], "id int, file_name string, split string")
    found = spark.createDataFrame([("a.jpg", 0, "old/a.jpg"), ("a.jpg", 1, "new/a.jpg")], "file_name string, source_order int, path string")
    assert rows(sinks.copy_manifest(images, found, "out")) == {(1, "new/a.jpg", "out/train/a.jpg")}


def test_coco_document(spark, tmp_path):
    images = spark.createDataFrame([(1, "a")], "id int, file_name string")
    doc = json.loads(sinks.coco_document(images, images.limit(0), images).first()["value"])
    assert doc["images"] == [{"id": 1, "file_name": "a"}] and doc["annotations"] == []
    sinks.write_coco_tables(images, images, images, str(tmp_path / "t"))
    assert spark.read.parquet(str(tmp_path / "t" / "images")).count() == 1


def test_dispatch_scores_and_remapping(spark, exports, tmp_path):
    assert sources.read_annotations(spark, str(exports / "via"))[0] == "via"
    assert sources.read_annotations(spark, str(exports / "fo"))[0] == "fiftyone"
    kind, shapes = sources.read_annotations(spark, str(exports / "coco"))
    assert kind == "coco" and shapes.count() == 2
    (tmp_path / "scores.json").write_text('{"a.jpg": {"mean": 0.5, "min": 0.25, "count": 2}, "b.jpg": {}}')
    assert rows(sources.read_scores(spark, str(tmp_path / "scores.json"))) == {("a.jpg", 0.5, 0.25, 2), ("b.jpg", None, None, None)}
    coco = sources.read_coco(spark, str(exports / "coco"), "coco.json")
    assert rows(sources.remap_categories(coco, {"Dent": 7}).select("id", "category_id")) == {(1, 7), (2, 7), (3, 2)}
    import pandas as pd

    found = sources.detect(coco.images.select("id"), lambda b: pd.DataFrame({"id": b["id"], "n": 1}), "id bigint, n int")
    assert rows(found) == {(1, 1), (2, 1)}


def test_exif_tags(spark, tmp_path):
    entry = lambda tag, value: struct.pack("<HHII", tag, 4, 1, value)
    tiff = b"II*\0" + struct.pack("<I", 8) + struct.pack("<H", 2) + entry(0x010F, 0) + entry(0x8825, 38) + struct.pack("<I", 0) + struct.pack("<H", 1) + entry(2, 0) + struct.pack("<I", 0)
    body = b"Exif\0\0" + tiff
    (tmp_path / "a.jpg").write_bytes(b"\xff\xd8\xff\xe1" + struct.pack(">H", len(body) + 2) + body + b"\xff\xd9")
    (tmp_path / "b.jpg").write_bytes(b"\xff\xd8\xff\xd9")
    (tmp_path / "c.jpg").write_bytes(b"x")
    files = spark.read.format("binaryFile").load(str(tmp_path))
    got = {filename["path"].rsplit("/", 1)[1]: (filename["n_tags"], filename["identifying"]) for filename in quality.exif_report(files).collect()}
    assert got == {"a.jpg": (3, [0x010F, 0x8825]), "b.jpg": (0, []), "c.jpg": (0, [])}


def test_templates(spark):
    from claimweave.functions.templates import data_uri, evaluation_id, render

    df = spark.createDataFrame([("x", 0.256, None)], "a string, b double, c string")
    say = lambda t: df.select(render(t, {"a": F.col("a"), "b": F.col("b"), "c": F.col("c")})).first()[0]
    assert say("{a}: {b:.0%} {b:.1f} {c}!") == "x: 26% 0.3 None!"
    assert say("{a} {zzz}") == "{a} {zzz}" and say("plain") == "plain" and say("") == ""
    assert df.select(evaluation_id(F.col("a"), F.lit("2024-01-02T00:00:00Z"))).first()[0].startswith("EVA-20240102-")
    assert df.select(data_uri(F.encode("a", "UTF-8"))).first()[0] == "data:image/png;base64,eA=="


def test_small_operators(spark):
    from claimweave.operators import lookup, metrics

    assert relabel.prompts_to_classes({"a": "x . y", "b": "y . z . "}) == {"x": "a", "y": "a", "z": "b"}
    assert column(spark, [0, 0, 10, 40], "c array<int>", relabel.small_crop(F.col("c"))) is True
    table = spark.createDataFrame([("a", "x"), ("q", "x")], "k string, v string")
    assert rows(lookup.coverage_gaps(table, {"k": ("a", "b"), "v": ("x",)})) == {("b", "x", "missing"), ("q", "x", "unknown")}
    m = spark.createDataFrame([("a", "tp"), ("a", "fp"), ("a", "fn"), ("a", "tp"), ("b", "fn")], "label string, outcome string")
    assert rows(metrics.precision_recall(m)) == {("a", 0.6667, 0.6667, 0.6667, 3), ("b", 0.0, 0.0, 0.0, 1)}
    docs = spark.createDataFrame([('{"id_evaluacion": "E", "claim_id": "c", "lane": "verde", "damages": [{"damage_id": "C1"}], "estimacion": {"total_eur": 3.5}, "audit": {"input_hashes": ["h"], "processing_time_ms": 4}, "name": "secret"}',), ("{}",)], "p string")
    out = sinks.audit_from_outputs(docs, "p").collect()
    assert sorted(out[0].asDict()) == sorted(sinks.AUDIT_FIELDS)
    assert out[0]["output_summary"].asDict() == {"lane": "verde", "n_damages": 1, "total_eur": 3.5} and out[1]["output_summary"]["n_damages"] == 0


def test_gaps_of_all_detections_hold_against_a_count(spark, sf_dir):
    from claimweave.functions.vocabulary import DAMAGE_TYPES, ZONES
    from claimweave.plans import datasets
    from claimweave.plans.adapter import detections

    seen = rows(detections(spark, sf_dir).select("type", "zone").distinct())
    every = {(t, z) for t in DAMAGE_TYPES for z in ZONES}
    assert rows(datasets.coverage_gaps(spark, sf_dir)) == {(*c, "missing") for c in every - seen} | {(*c, "unknown") for c in seen - every}


def flooded(mask):
    """The largest 4-connected region by filling pixel by pixel, the first in reading order among equals."""
    seen, best = set(), []
    for start in zip(*(v.tolist() for v in np.nonzero(mask)), strict=True):
        if start in seen:
            continue
        region, todo = [], [start]
        seen.add(start)
        while todo:
            y, x = todo.pop()
            region.append((y, x))
            for p in ((y - 1, x), (y + 1, x), (y, x - 1), (y, x + 1)):
                if 0 <= p[0] < mask.shape[0] and 0 <= p[1] < mask.shape[1] and mask[p] and p not in seen:
                    seen.add(p)
                    todo.append(p)
        if len(region) > len(best):
            best = region
    rows = {}
    for y, x in best:
        rows.setdefault(y, []).append(x)
    ys = sorted(rows)
    return [float(v) for p in [(min(rows[y]), y) for y in ys] + [(max(rows[y]), y) for y in reversed(ys)] for v in p] or None


def test_outlines_against_a_flood_fill():
    rng = np.random.default_rng(3)
    for _ in range(300):
        mask = rng.random((rng.integers(1, 12), rng.integers(1, 12))) < rng.choice([0.2, 0.5, 0.7])
        assert sources._outline(mask) == flooded(mask)


def test_masks_and_centre_lines(spark):
    from claimweave.operators import masks

    assert masks.box_mask([1.4, 0.6, 3.0, 99.0], 4, 5).sum() == 2 * 3
    assert masks.box_mask(None, 4, 5).sum() == masks.box_mask([3, 3, 2, 2], 4, 5).sum() == 0
    assert masks.polygon_mask([1.0, 1.0, 4.0, 1.0, 4.0, 3.0, 1.0, 3.0], 10, 10).sum() == 12
    assert masks.polygon_mask([0.0, 0.0, 4.0, 4.0], 10, 10).sum() == masks.polygon_mask(None, 10, 10).sum() == 0
    triangle = masks.polygon_mask([0.0, 0.0, 8.0, 0.0, 0.0, 8.0], 9, 9)
    assert triangle.sum() == 45 and triangle[0].all() and not triangle[8, 1:].any()
    assert masks.line_points(np.zeros((3, 3), bool)) == []
    thick = np.zeros((9, 30), bool)
    thick[2:7, 2:28] = True
    points = masks.line_points(thick)
    assert len(points) == 5 and all(y == 4 for _, y in points)


def test_zone_by_overlap(spark):
    from claimweave.operators import localize

    damages = spark.createDataFrame([(1, 7, [0.0, 0.0, 10.0, 10.0]), (2, 7, [90.0, 90.0, 95.0, 95.0]), (3, 8, [0.0, 0.0, 0.0, 0.0]), (4, 9, None)], "id int, image int, box array<double>")
    parts = spark.createDataFrame([(7, "hood", "front", 0, [0.0, 0.0, 10.0, 10.0]), (7, "door", "front_left", 1, [0.0, 0.0, 8.0, 10.0]), (7, "wheel", None, 2, [0.0, 0.0, 10.0, 10.0]), (8, "hood", "front", 0, [0.0, 0.0, 9.0, 9.0])], "image int, part string, zone string, ord int, part_box array<double>")
    assert rows(localize.best_zone(damages, parts, "image", "id")) == {(1, "door", "front_left", 0.8, 0.8)}
    assert localize.best_zone(damages, parts.limit(0), "image", "id").count() == 0


def test_average_precision_by_hand(spark):
    from claimweave.operators import metrics

    rows_ = [("a", 0.9, True), ("a", 0.8, False), ("a", 0.7, True), ("a", None, True), ("b", 0.5, False)]
    df = spark.createDataFrame(rows_, "label string, score double, hit boolean")
    truths = spark.createDataFrame([("a", 4), ("b", 1), ("c", 2), ("d", 0)], "label string, n_true bigint")
    assert rows(metrics.average_precision(df, truths)) == {("a", round((1 + 2 / 3) / 4, 4), 4), ("b", 0.0, 1), ("c", 0.0, 2)}


def test_pages_and_packages(spark, tmp_path):
    df = spark.createDataFrame([(1, 0.2, "a<b"), (2, 0.9, "c")], "id int, score double, name string")
    page = sinks.review_page(df, "score", 1)
    assert "a&lt;b" in page and "low" in page and ">c<" not in page
    assert sinks.metrics_page(df, df, df, df).count("<h2>") == 4
    assert sinks.spot_check_page(df, "name").count("<table") == 2 and "Damages" in sinks.appraisal_page(df.limit(1), df)
    with zipfile.ZipFile(tmp_path / "e.zip", "w") as z:
        z.writestr("data/a.jpg", b"x")
        z.writestr("z.json", "{}")
    kind, path = sources.open_container(str(tmp_path / "e.zip"), str(tmp_path / "o"))
    assert kind == "json" and (tmp_path / "o" / "data" / "a.jpg").read_bytes() == b"x"


def test_every_yaml_file_counts(spark, tmp_path):
    for i in range(4):
        (tmp_path / f"f{i}.yaml").write_text(f"top:\n  k{i}: {i}\n")
    assert {(r["key"], r["value"]) for r in sources.read_yaml_rows(spark, str(tmp_path), "top").collect()} == {(f"k{i}", str(i)) for i in range(4)}


def test_staged_tables_are_deleted_when_nothing_reads_them(spark, tmp_path):
    from pathlib import Path

    from claimweave.operators.staging import stage_root

    before = set(Path(stage_root(spark).removeprefix("file://")).iterdir())
    df = spark.createDataFrame([(i, i * 3 % 7) for i in range(50)], "id bigint, code bigint")
    out = neardup.near_pairs(df, "id", "code", 1)
    left = set(Path(stage_root(spark).removeprefix("file://")).iterdir()) - before
    n = out.count()
    assert n > 0 and len(left) <= 4  # codes, blocks, probes and what is crowded: read by the plan that is returned


# --- contracts

SCHEMA = {
    "type": "object", "required": ["claim_id", "amount"], "additionalProperties": False,
    "properties": {
        "claim_id": {"type": "string", "pattern": "^[A-Z]"}, "amount": {"type": "number", "minimum": 0}, "currency": {"const": "EUR"}, "closed": {"type": "string", "format": "date"}, "year": {"type": "integer", "minimum": 1980},
        "parts": {"type": "array", "items": {"type": "object", "required": ["part"], "additionalProperties": False, "properties": {"part": {"type": "string"}, "action": {"enum": ["repair", "replace"]}}}},
        "version": {"type": ["string", "null"]},
    },
}


def test_documents_against_a_schema(spark):
    cases = [
        ('{"claim_id": "A", "amount": 3.5, "currency": "EUR", "closed": "2024-01-31", "year": 2000, "parts": [{"part": "hood", "action": "repair"}], "version": null}', []),
        ('{"claim_id": "A"}', ["$: 'amount' is missing"]),
        ('{"claim_id": "A", "amount": -1, "plate": "x"}', ["$.amount: below 0", "$: unexpected 'plate'"]),
        ('{"claim_id": "a", "amount": "x"}', ["$.amount: not of type number", "$.claim_id: does not match ^[A-Z]"]),
        ('{"claim_id": "A", "amount": 1, "parts": [{"part": "a"}, {"action": "paint", "who": 1}]}', ["$.parts[].action: not one of ['repair', 'replace']", "$.parts[]: 'part' is missing", "$.parts[]: unexpected 'who'"]),
        ('{"claim_id": "A", "amount": 1, "closed": "31/01/2024", "currency": "USD", "year": 1.5}', ["$.closed: not a date", "$.currency: not one of ['EUR']", "$.year: below 1980", "$.year: not of type integer"]),
        ("{broken", ["$: not JSON"]), (None, ["$: not JSON"]), ("[]", ["$: not of type object"]),
    ]
    df = spark.createDataFrame([(i, c) for i, (c, _) in enumerate(cases)], "i int, p string")
    got = {r["i"]: sorted(r["errors"]) for r in validate.validate(df, "p", SCHEMA).collect()}
    assert got == {i: sorted(e) for i, (_, e) in enumerate(cases)}
    assert validate.require_valid(df.where("i = 0"), "p", SCHEMA).count() == 1
    with pytest.raises(Exception, match="is missing"):
        validate.require_valid(df.where("i = 1"), "p", SCHEMA).collect()
    with pytest.raises(ValueError):
        validate.schema_errors(F.col("p"), {"oneOf": []})


# --- streams


def test_windows_sessions_and_first_arrivals(spark, tmp_path):
    from claimweave.streaming import monitor

    df = spark.createDataFrame([("2024-01-01 00:00:01", "a"), ("2024-01-01 00:10:00", "a"), ("2024-01-01 05:00:00", "a"), ("2024-01-02 00:00:00", "b")], "t string, k string")
    assert {r["n"] for r in monitor.windowed_counts(df, "t", "k").collect()} == {3, 1}
    assert listed(monitor.sessions(df, "t", "k").select("k", "n")) == [("a", 1), ("a", 2), ("b", 1)]
    df.coalesce(1).write.json(str(tmp_path / "in"))
    stream = spark.readStream.schema("t string, k string").json(str(tmp_path / "in"))
    q = monitor.first_arrivals(stream, "t", "k").writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2


def test_every_query_has_a_stable_schema(spark, sf_dir):
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())
    assert e.queries()["consolidated_damages"](spark, sf_dir).count() > 0
