"""Scans of binary files: number arrays (.npy) and scenes (.glb), each file read in one task by Spark's own reader."""

from __future__ import annotations

import io
import json
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from facetforge.sources import png

#: Fixed values of the glTF format: component types, and components by the accessor's type.
COMPONENTS = {5120: "<i1", 5121: "<u1", 5122: "<i2", 5123: "<u2", 5125: "<u4", 5126: "<f4"}
SHAPES = {"SCALAR": 1, "VEC2": 2, "VEC3": 3, "VEC4": 4, "MAT4": 16}
MAGIC, JSON_CHUNK, BINARY_CHUNK = 0x46546C67, 0x4E4F534A, 0x004E4942


def labels(spark: SparkSession, path: str) -> DataFrame:
    """path, fidx, label: the elements of one-dimensional arrays of whole numbers; a file that isn't one has a row with the
    error alone (path, null, null, error)."""
    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for files in batches:
            for where, content in zip(files["path"], files["content"], strict=True):
                try:
                    array = np.load(io.BytesIO(content), allow_pickle=False).ravel()
                    yield pd.DataFrame({"path": where, "fidx": np.arange(len(array)), "label": array.astype(np.int64), "error": None})
                except (ValueError, EOFError, OSError) as e:
                    yield pd.DataFrame({"path": [where], "fidx": [None], "label": [None], "error": [str(e)[:200]]})

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInPandas(read, "path string, fidx long, label long, error string")


def conforming(faces: DataFrame, labels: DataFrame, by: list[str]) -> DataFrame:
    """The faces (by, fidx) with their labels, of those assets alone that have as many labels as faces."""
    n, m = faces.groupBy(*by).agg(F.count("*").alias("n")), labels.groupBy(*by).agg(F.count("*").alias("m"))
    good = n.join(m, by).where("n = m").select(*by)
    return faces.join(good, by, "left_semi").join(labels.select(*by, "fidx", "label"), [*by, "fidx"])


def parse(content: bytes) -> tuple[dict, bytes]:
    magic, _, length = struct.unpack_from("<III", content)
    if magic != MAGIC:
        raise ValueError("no binary scene")
    at, document, binary = 12, {}, b""
    while at < length:
        size, kind = struct.unpack_from("<II", content, at)
        chunk = content[at + 8 : at + 8 + size]
        document, binary = (json.loads(chunk), binary) if kind == JSON_CHUNK else (document, chunk if kind == BINARY_CHUNK else binary)
        at += 8 + size
    return document, binary


def accessor(document: dict, binary: bytes, i: int) -> np.ndarray:
    spec = document["accessors"][i]
    view = document["bufferViews"][spec["bufferView"]]
    kind, width = np.dtype(COMPONENTS[spec["componentType"]]), SHAPES[spec["type"]]
    start, step = view.get("byteOffset", 0) + spec.get("byteOffset", 0), view.get("byteStride") or kind.itemsize * width
    return np.ndarray((spec["count"], width), kind, binary, start, (step, kind.itemsize))


def placed(document: dict, node: int, above: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """The meshes under a node with the matrix that takes each into the world."""
    n = document["nodes"][node]
    own = np.eye(4)
    if "matrix" in n:
        own = np.array(n["matrix"], float).reshape(4, 4).T
    else:
        x, y, z, w = n.get("rotation", (0, 0, 0, 1))
        turn = np.array([[1 - 2 * (y * y + z * z), 2 * (x * y - z * w), 2 * (x * z + y * w)], [2 * (x * y + z * w), 1 - 2 * (x * x + z * z), 2 * (y * z - x * w)], [2 * (x * z - y * w), 2 * (y * z + x * w), 1 - 2 * (x * x + y * y)]])
        own[:3, :3], own[:3, 3] = turn * np.array(n.get("scale", (1, 1, 1))), n.get("translation", (0, 0, 0))
    world = above @ own
    if "mesh" in n:
        yield n["mesh"], world
    for child in n.get("children", ()):
        yield from placed(document, child, world)


def picture(document: dict, part: dict) -> int | None:
    """The image of a part's base colour, if it has one."""
    material = document.get("materials", [])[part["material"]] if "material" in part else {}
    texture = material.get("pbrMetallicRoughness", {}).get("baseColorTexture")
    return None if texture is None else document["textures"][texture["index"]].get("source")


def scene(content: bytes) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray | None, int | None]]:
    """Vertices in the world, faces, places in the atlas and the image's number, if there are any, of each mesh that has faces,
    in the order of the scene."""
    document, binary = parse(content)
    roots = document["scenes"][document.get("scene", 0)]["nodes"]
    for root in roots:
        for mesh, world in placed(document, root, np.eye(4)):
            for part in document["meshes"][mesh]["primitives"]:
                if part.get("mode", 4) != 4:
                    continue
                xyz = accessor(document, binary, part["attributes"]["POSITION"]).astype(float)
                faces = accessor(document, binary, part["indices"]).astype(np.int64).reshape(-1, 3) if "indices" in part else np.arange(len(xyz)).reshape(-1, 3)
                if len(faces):
                    place = part["attributes"].get("TEXCOORD_0")
                    # The format counts v from above, meshes from below.
                    uv = None if place is None else accessor(document, binary, place).astype(float) * (1, -1) + (0, 1)
                    yield xyz @ world[:3, :3].T + world[:3, 3], faces, uv, picture(document, part)


def pictures(content: bytes) -> Iterator[tuple[int, bytes]]:
    """The images of a scene file, with their numbers."""
    document, binary = parse(content)
    for i, image in enumerate(document.get("images", [])):
        view = document["bufferViews"][image["bufferView"]]
        start = view.get("byteOffset", 0)
        yield i, binary[start : start + view["byteLength"]]


BROKEN = (ValueError, KeyError, IndexError, TypeError, struct.error, zlib.error)


def scenes(spark: SparkSession, path: str, merged: bool = False) -> tuple[DataFrame, DataFrame, DataFrame]:
    """vertices (path, mesh, vid, x, y, z, u, v), faces (path, mesh, fidx, v0, v1, v2, image) and errors (path, error) of scene
    files; vertices and faces are numbered inside their mesh, or over the whole file if `merged`; u, v and the number of the
    image are null where there are none. A file is one row of Spark's reader, so a scene has to fit into a task, as a mesh
    does wherever it is used."""
    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for files in batches:
            for where, content in zip(files["path"], files["content"], strict=True):
                try:
                    before = first = 0
                    for i, (xyz, faces, uv, image) in enumerate(scene(content)):
                        mesh, at, face = (0, before, first) if merged else (i, 0, 0)
                        u, v = (None, None) if uv is None else uv.T
                        yield pd.DataFrame({"path": where, "kind": "v", "mesh": mesh, "n": at + np.arange(len(xyz)), "a": xyz[:, 0], "b": xyz[:, 1], "c": xyz[:, 2], "u": u, "v": v, "error": None})
                        a, b, c = (faces + at).astype(float).T
                        yield pd.DataFrame({"path": where, "kind": "f", "mesh": mesh, "n": face + np.arange(len(faces)), "a": a, "b": b, "c": c, "u": None if image is None else float(image), "v": None, "error": None})
                        before, first = before + len(xyz), first + len(faces)
                except BROKEN as e:
                    yield pd.DataFrame({"path": [where], "kind": "e", "mesh": None, "n": None, "a": None, "b": None, "c": None, "u": None, "v": None, "error": [f"{type(e).__name__}: {e}"[:200]]})

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    rows = files.mapInPandas(read, "path string, kind string, mesh long, n long, a double, b double, c double, u double, v double, error string")
    vertices = rows.where("kind = 'v'").select("path", "mesh", F.col("n").alias("vid"), F.col("a").alias("x"), F.col("b").alias("y"), F.col("c").alias("z"), "u", "v")
    faces = rows.where("kind = 'f'").select("path", "mesh", F.col("n").alias("fidx"), *(F.col(k).cast("long").alias(f"v{i}") for i, k in enumerate("abc")), F.col("u").cast("int").alias("image"))
    return vertices, faces, rows.where("kind = 'e'").select("path", "error")


def textures(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """images (path, image, wide, high, pixels) of scene files, and errors (path, image, error) of those that can't be read."""
    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for files in batches:
            for where, content in zip(files["path"], files["content"], strict=True):
                i, found = -1, []
                try:
                    found = list(pictures(content))
                except BROKEN as e:
                    yield pd.DataFrame([(where, i, None, None, None, f"{type(e).__name__}: {e}"[:200])], columns=names)
                for i, raw in found:
                    try:
                        yield pd.DataFrame([(where, i, *png.decoded(raw), None)], columns=names)
                    except BROKEN as e:
                        yield pd.DataFrame([(where, i, None, None, None, f"{type(e).__name__}: {e}"[:200])], columns=names)

    names = ["path", "image", "wide", "high", "pixels", "error"]
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    rows = files.mapInPandas(read, "path string, image int, wide int, high int, pixels binary, error string")
    return rows.where("error is null").drop("error"), rows.where("error is not null").select("path", "image", "error")


def scene_bytes(meshes: list[tuple], images: list[bytes] = ()) -> bytes:
    """A scene file of meshes (vertices, faces, and if they have them places in the atlas and an image's number): node and
    geometry names n0.., g0.., in their order. images: PNG files."""
    binary, views, accessors, nodes, made, materials = b"", [], [], [], [], []

    def view(raw: bytes, target: int | None) -> int:
        nonlocal binary
        binary += b"\0" * (-len(binary) % 4)
        views.append({"buffer": 0, "byteOffset": len(binary), "byteLength": len(raw)} | ({"target": target} if target else {}))
        binary += raw
        return len(views) - 1

    def values(data: np.ndarray, kind: int, shape: str, target: int) -> int:
        spec = {"bufferView": view(data.tobytes(), target), "componentType": kind, "count": len(data), "type": shape}
        accessors.append(spec | ({"min": data.min(axis=0).tolist(), "max": data.max(axis=0).tolist()} if shape == "VEC3" and len(data) else {}))
        return len(accessors) - 1

    for i, (xyz, faces, *skin) in enumerate(meshes):
        uv, image = (*skin, None, None)[:2]
        part = {"attributes": {"POSITION": values(np.asarray(xyz, "<f4"), 5126, "VEC3", 34962)}, "indices": values(np.asarray(faces, "<u4").ravel(), 5125, "SCALAR", 34963)}
        if uv is not None:
            part["attributes"]["TEXCOORD_0"] = values((np.asarray(uv, float) * (1, -1) + (0, 1)).astype("<f4"), 5126, "VEC2", 34962)
        if image is not None:
            part["material"] = len(materials)
            materials.append({"name": f"m{i}", "pbrMetallicRoughness": {"baseColorTexture": {"index": int(image)}}})
        made.append({"name": f"g{i}", "primitives": [part]})
        nodes.append({"name": f"n{i}", "mesh": i})
    document = {"asset": {"version": "2.0"}, "scene": 0, "scenes": [{"nodes": list(range(len(nodes)))}], "nodes": nodes, "meshes": made, "accessors": accessors}
    if images:
        document |= {"images": [{"bufferView": view(raw, None), "mimeType": "image/png"} for raw in images], "textures": [{"source": i} for i in range(len(images))], "materials": materials}
    document |= {"bufferViews": views, "buffers": [{"byteLength": len(binary)}]}
    text = json.dumps(document).encode()
    text += b" " * (-len(text) % 4)
    binary += b"\0" * (-len(binary) % 4)
    chunks = struct.pack("<II", len(text), JSON_CHUNK) + text + struct.pack("<II", len(binary), BINARY_CHUNK) + binary
    return struct.pack("<III", MAGIC, 2, 12 + len(chunks)) + chunks
