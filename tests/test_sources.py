"""What is written is read again; files that are missing, broken or doubled."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from facetforge.sources import arrays, records, sinks


def put(path, content):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(content if isinstance(content, bytes) else content.encode())


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_json_scans(spark, tmp_path):
    put(tmp_path / "a.jsonl", '{"sha": "x", "n": 1}\nnot json\n{"sha": "y"}\n')
    assert {tuple(r) for r in records.lines(spark, str(tmp_path / "a.jsonl"), "sha string, n int").collect()} == {("x", 1), (None, None), ("y", None)}
    put(tmp_path / "b.json", json.dumps([{"sha": "x", "n": 1}, {"sha": "y", "n": 2}]))
    assert rows(records.listed(spark, str(tmp_path / "b.json"), "sha string, n int")) == [("x", 1), ("y", 2)]
    put(tmp_path / "c.json", json.dumps({"k1": {"verdict": "pass"}, "k2": {"verdict": "fail"}}, indent=1))
    assert rows(records.mapped(spark, str(tmp_path / "c.json"), "struct<verdict:string>").select("key", "value.verdict")) == [("k1", "pass"), ("k2", "fail")]
    put(tmp_path / "d.json", json.dumps({"results": [{"sha": "x", "raw": "1"}, {"sha": "y", "raw": "2"}, {"sha": "x", "raw": "3"}]}))
    assert rows(records.results(spark, str(tmp_path / "d.json"), "sha:string,raw:string", "sha")) == [("x", "3"), ("y", "2")]


def test_folders_of_pairs_round_trip(spark, tmp_path):
    root = tmp_path / "pairs"
    for task, name, meta in (("E3", "a__p1", {"sha": "a", "part_id": 1}), ("E6", "b__p2", {"sha": "b", "part_id": 2})):
        put(root / task / name / "meta.json", json.dumps(meta, indent=1))
    put(root / "E6" / "broken" / "meta.json", "{")
    got = records.pairs(spark, str(root), "sha string, part_id int").select("task", "name", "sha", "part_id")
    assert {tuple(r) for r in got.collect()} == {("E3", "a__p1", "a", 1), ("E6", "b__p2", "b", 2), ("E6", "broken", None, None)}


def test_missing_and_newer_files(spark, tmp_path):
    assert records.optional(spark, str(tmp_path / "no.jsonl"), "sha string").count() == 0
    put(tmp_path / "old" / "a.json", '[{"sha": "o"}]')
    new, old = str(tmp_path / "new" / "*.json"), str(tmp_path / "old" / "*.json")
    assert rows(records.versioned(spark, new, old, "sha string")) == [("o", "old")]
    put(tmp_path / "new" / "a.json", '[{"sha": "n"}]')
    assert rows(records.versioned(spark, new, old, "sha string")) == [("n", "new")]


def test_patterns_and_jobs(spark):
    paths = spark.createDataFrame([("a/part_ref.jpg",), ("b/donor_ref.jpg",), ("c/x.glb",)], "path string")
    assert rows(records.by_pattern(paths, "path", ["donor_ref.jpg$", "_ref.jpg$"])) == [("a/part_ref.jpg", 1), ("b/donor_ref.jpg", 0)]
    specs = spark.createDataFrame([("in.json:out",), ("alone",), ("a:b:c",)], "spec string")
    assert {tuple(r) for r in records.jobs(specs).collect()} == {("in.json", "out"), ("alone", None), ("a", "b:c")}


def npy(values):
    import io

    held = io.BytesIO()
    np.save(held, np.array(values, np.int32))
    return held.getvalue()


def test_labels_that_conform(spark, tmp_path):
    put(tmp_path / "a" / "face_ids.npy", npy([5, 6, 5]))
    put(tmp_path / "b" / "face_ids.npy", npy([1]))
    put(tmp_path / "c" / "face_ids.npy", b"nothing")
    got = arrays.labels(spark, str(tmp_path / "*" / "face_ids.npy")).withColumn("sha", records.nth_from_end(F.col("path"), 2))
    assert got.where("error is not null").select("sha").collect()[0].sha == "c"
    faces = spark.createDataFrame([("a", 0), ("a", 1), ("a", 2), ("b", 0), ("b", 1)], "sha string, fidx long")
    assert rows(arrays.conforming(faces, got.where("error is null"), ["sha"])) == [("a", 0, 5), ("a", 1, 6), ("a", 2, 5)]


def test_scenes_round_trip(spark, tmp_path):
    one = (np.array([[0, 0, 0], [1, 0, 0], [0, 1, 0]], float), np.array([[0, 1, 2]]))
    two = (np.array([[0, 0, 1], [1, 0, 1], [0, 1, 1], [1, 1, 1]], float), np.array([[0, 1, 2], [1, 3, 2]]))
    put(tmp_path / "in" / "a.glb", arrays.scene_bytes([one, two]))
    put(tmp_path / "in" / "b.glb", b"nothing at all")
    vertices, faces, errors = arrays.scenes(spark, str(tmp_path / "in" / "*.glb"))
    assert (vertices.count(), faces.count(), errors.count()) == (7, 3, 1)
    sha = records.nth_from_end(F.col("path"), 1).alias("sha")
    assert {r.image for r in faces.collect()} == {None}
    made = sinks.scene_files(vertices.select(sha, "mesh", "vid", "x", "y", "z"), faces.select(sha, "mesh", "fidx", "v0", "v1", "v2")).collect()
    put(tmp_path / "out" / "a.glb", bytes(made[0].content))
    again, sides, _ = arrays.scenes(spark, str(tmp_path / "out" / "*.glb"))
    assert rows(again.drop("path")) == rows(vertices.drop("path")) and rows(sides.drop("path")) == rows(faces.drop("path"))
    _, merged, _ = arrays.scenes(spark, str(tmp_path / "out" / "*.glb"), merged=True)
    assert rows(merged.select("fidx", "v0", "v1", "v2")) == [(0, 0, 1, 2), (1, 3, 4, 5), (2, 4, 6, 5)]


def test_a_scene_is_taken_into_the_world():
    document, binary = arrays.parse(arrays.scene_bytes([(np.array([[1.0, 0, 0], [0, 1, 0], [0, 0, 1]]), np.array([[0, 1, 2]]))]))
    half = 0.5**0.5
    document["nodes"] = [{"children": [1], "translation": [10, 0, 0]}, {"mesh": 0, "rotation": [0, 0, half, half], "scale": [2, 2, 2]}]
    [(mesh, world)] = arrays.placed(document, 0, np.eye(4))
    xyz = arrays.accessor(document, binary, 0).astype(float) @ world[:3, :3].T + world[:3, 3]
    assert mesh == 0 and np.allclose(xyz, [[10, 2, 0], [8, 0, 0], [10, 0, 2]])


def test_records_by_task_and_overwritten_tasks(spark, tmp_path):
    df = spark.createDataFrame([("E3", "a", 1), ("E6", "b", 2)], "task string, sha string, n int")
    path = str(tmp_path / "out")
    sinks.records(df, path)
    sinks.overwritten(spark.createDataFrame([("E3", "c", 3)], "task string, sha string, n int"), path)
    assert rows(spark.read.json(path).select("task", "sha", "n")) == [("E3", "c", 3), ("E6", "b", 2)]


def test_maps_new_versions_errors_and_the_page(spark, tmp_path):
    df = spark.createDataFrame([("a", 1, None), ("b", 2, "y" * 2000)], "key string, n int, exc string")
    sinks.as_map(df.drop("exc"), str(tmp_path / "map"), "key")
    assert rows(records.mapped(spark, str(tmp_path / "map"), "struct<n:int>").select("key", "value.n")) == [("a", 1), ("b", 2)]
    changes = spark.createDataFrame([("a", 7), ("b", None), ("z", 1)], "key string, n int")
    assert rows(sinks.updated(df.drop("exc"), changes, ["key"], ["n"])) == [("a", 7), ("b", 2)]
    good, bad = sinks.split_errors(df, F.col("exc").isNotNull(), F.col("exc"), ["key"])
    assert [r.key for r in good.collect()] == ["a"] and [(r.key, r.error, len(r.exc)) for r in bad.collect()] == [("b", True, 1500)]
    html = sinks.page(spark.createDataFrame([("</script>",)], "t string"), "<p>{{title}}</p><script>{{rows}}</script>", {"title": "a < b"})
    assert html == '<p>a &lt; b</p><script>[{"t": "<\\/script>"}]</script>'
    html = sinks.page(spark.createDataFrame([("{{title}}",)], "t string"), "{{rows}} {{title}} {{other}}", {"title": "{{rows}}"})
    assert html == '[{"t": "{{title}}"}] {{rows}} {{other}}'  # what is put in isn't filled in again
    with pytest.raises(ValueError, match="at most"):
        sinks.page(spark.range(5001), "{{rows}}", {})


HARD = {"a": {"n": 1, "t": 'x, "y" } { ] \\'}, 'k"e,y': {"n": 2, "t": "\\"}, "c": {"n": None, "t": "ä\n,\t"}, "": {"n": 4, "t": "[,{"}}


@pytest.mark.parametrize("indent", [None, 1])
@pytest.mark.parametrize("block", ["128m", "7b"])
def test_a_map_is_cut_at_its_keys(spark, tmp_path, indent, block):
    """Whatever the blocks that the file is read in, strings with commas, brackets and backslashes included."""
    put(tmp_path / "m.json", json.dumps(HARD, indent=indent, ensure_ascii=False))
    put(tmp_path / "n.json", json.dumps({"z": {"n": 9, "t": "other file"}}))
    put(tmp_path / "empty.json", "{ }")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", block)
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        got = records.mapped(spark, str(tmp_path / "*.json"), "struct<n:int,t:string>")
        assert {r.key: {"n": r.value.n, "t": r.value.t} for r in got.collect()} == HARD | {"z": {"n": 9, "t": "other file"}}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_maps_of_plain_values_and_repeated_keys(spark, tmp_path):
    put(tmp_path / "a.json", '{"x": "one, two", "y": "", "x": "last"}')
    assert rows(records.mapped(spark, str(tmp_path / "a.json"))) == [("x", "last"), ("y", "")]
    put(tmp_path / "b.json", '{"x": [1, [2, 3]], "y": []}')
    assert {r.key: r.value for r in records.mapped(spark, str(tmp_path / "b.json"), "array<string>").collect()} == {"x": ["1", "[2,3]"], "y": []}


def test_a_large_map_is_read_by_many_tasks(spark, tmp_path):
    put(tmp_path / "m.json", json.dumps({f"k{i}": {"n": i, "t": "a, b" * 20} for i in range(20_000)}))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200k")
    try:
        got = records.mapped(spark, str(tmp_path / "m.json"), "struct<n:int,t:string>")
        assert got.agg(F.count("*"), F.sum("value.n")).first()[:2] == (20_000, 199_990_000)
        assert spark.read.option("lineSep", ",").text(str(tmp_path / "m.json")).rdd.getNumPartitions() > 5
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_several_records_of_one_part_file(spark, tmp_path):
    df = spark.createDataFrame([("a", 1), ("b, c", 2), ('d"', 3), (None, 4)], "key string, n int").coalesce(1)
    sinks.as_map(df, str(tmp_path / "map"), "key")
    assert rows(records.mapped(spark, str(tmp_path / "map"), "struct<n:int>").select("key", "value.n")) == [("a", 1), ("b, c", 2), ('d"', 3)]
    [part] = (tmp_path / "map").glob("part-*.txt")
    assert json.loads(part.read_text()) == {"a": {"n": 1}, "b, c": {"n": 2}, 'd"': {"n": 3}}
    sinks.as_map(df.limit(0), str(tmp_path / "none"), "key")
    assert records.mapped(spark, str(tmp_path / "none"), "struct<n:int>").count() == 0


def test_counters_of_the_job_that_writes(spark, tmp_path):
    df = spark.range(1000).withColumn("ok", F.col("id") % 3 == 0)
    got = sinks.counted(df, str(tmp_path / "t"), n=F.count("*"), passed=F.count_if("ok"))
    again = spark.read.parquet(str(tmp_path / "t"))
    assert got == {"n": again.count(), "passed": again.where("ok").count()} == {"n": 1000, "passed": 334}


def test_a_record_for_each_pair(spark, tmp_path):
    df = spark.createDataFrame([("E3", "a__p1", "a", 1), ("E6", "b__p2", "b", 2)], "task string, name string, sha string, part_id int")
    sinks.by_pair(df, str(tmp_path / "pairs"))
    assert json.loads((tmp_path / "pairs" / "E3" / "a__p1" / "meta.json").read_text()) == {"task": "E3", "sha": "a", "part_id": 1}
    got = records.pairs(spark, str(tmp_path / "pairs"), "sha string, part_id int").select("task", "name", "sha", "part_id")
    assert rows(got) == rows(df)
    sinks.by_pair(df.where("sha = 'a'").withColumn("part_id", F.lit(7)), str(tmp_path / "pairs"))
    assert {r.part_id for r in records.pairs(spark, str(tmp_path / "pairs"), "sha string, part_id int").collect()} == {2, 7}


def test_a_failed_task_leaves_no_file(spark, tmp_path):
    df = spark.range(8).repartition(8).select(F.concat("id", F.lit("/x.bin")).alias("path"), F.when(F.col("id") == 5, F.raise_error(F.lit("broken"))).otherwise(F.encode(F.col("id").cast("string"), "utf-8")).alias("content"))
    from facetforge.sources import named

    with pytest.raises(Exception, match="broken"):
        named.written(df, str(tmp_path / "out"))
    assert not list((tmp_path / "out").rglob("*.bin")) and not (tmp_path / "out" / "_temporary").exists()
    for bad in ("../x", "/x", ""):
        with pytest.raises(Exception, match="no path below"):
            named.written(spark.createDataFrame([(bad, bytearray(b"1"))], "path string, content binary"), str(tmp_path / "out"))
    with pytest.raises(Exception, match="two rows have one path"):
        named.written(spark.createDataFrame([("a", bytearray(b"1"))] * 2, "path string, content binary"), str(tmp_path / "out"))
    assert not list((tmp_path / "out").rglob("*")) if (tmp_path / "out").exists() else True
    named.written(df.where("id <> 5"), str(tmp_path / "out"))
    assert sorted(p.parent.name for p in (tmp_path / "out").rglob("*.bin")) == list("0123467")


def test_a_textured_scene_round_trips(spark, tmp_path):
    """Two meshes, one with a picture: written by the sink, read with its places and its picture."""
    wide, high = 5, 3
    pixels = bytes(range(wide * high * 4))
    vertices = spark.createDataFrame([("s", m, i, float(i), float(m), 0.5, i / 4 if m else None, 0.25 if m else None) for m in (0, 1) for i in range(3)], "sha string, mesh long, vid long, x double, y double, z double, u double, v double")
    faces = spark.createDataFrame([("s", 0, 0, 0, 1, 2), ("s", 1, 0, 2, 1, 0)], "sha string, mesh long, fidx long, v0 long, v1 long, v2 long")
    textures = spark.createDataFrame([("s", wide, high, bytearray(pixels))], "sha string, wide int, high int, pixels binary")
    sinks.scenes(vertices, faces, str(tmp_path / "out"), textures)
    again, sides, errors = arrays.scenes(spark, str(tmp_path / "out" / "s.glb"))
    assert errors.count() == 0
    assert rows(again.select("mesh", "vid", "x", "y", "z").where("mesh = 1")) == rows(vertices.select("mesh", "vid", "x", "y", "z").where("mesh = 1"))
    assert [(r.u, r.v) for r in again.orderBy("mesh", "vid").collect()] == [(None, None)] * 3 + [(i / 4, 0.25) for i in range(3)]
    assert {(r.mesh, r.image) for r in sides.collect()} == {(0, None), (1, 0)}
    images, bad = arrays.textures(spark, str(tmp_path / "out" / "*.glb"))
    assert bad.count() == 0 and [(r.image, r.wide, r.high, bytes(r.pixels)) for r in images.collect()] == [(0, wide, high, pixels)]


@pytest.mark.parametrize("kind", [0, 1, 2, 3, 4])
def test_pictures_of_every_filter(kind):
    import struct
    import zlib

    from facetforge.sources import png

    rng = np.random.default_rng(kind)
    for colour, step in png.CHANNELS.items():
        flat = rng.integers(0, 256, (4, 6, step), dtype=np.uint8)
        body, above = b"", bytes(6 * step)
        for line in flat.reshape(4, -1):
            row, out = bytes(line), bytearray()
            for i, x in enumerate(row):
                left, corner = (row[i - step], above[i - step]) if i >= step else (0, 0)
                out.append(x - {0: 0, 1: left, 2: above[i], 3: left + above[i] >> 1, 4: png.paeth(left, above[i], corner)}[kind] & 255)
            body, above = body + bytes([kind]) + bytes(out), row
        raw = png.SIGNATURE + png.chunk(b"IHDR", struct.pack(">IIBBBBB", 6, 4, 8, colour, 0, 0, 0)) + png.chunk(b"IDAT", zlib.compress(body)) + png.chunk(b"IEND", b"")
        wide, high, pixels = png.decoded(raw)
        got = np.frombuffer(pixels, np.uint8).reshape(4, 6, 4)
        assert (wide, high) == (6, 4) and np.array_equal(got[..., :1], flat[..., :1])
        assert np.array_equal(got[..., 3], flat[..., -1] if step in (2, 4) else np.full((4, 6), 255))
    assert png.decoded(png.encoded(2, 1, bytes(range(8)))) == (2, 1, bytes(range(8)))
    with pytest.raises(ValueError, match="picture"):
        png.decoded(b"nothing")
