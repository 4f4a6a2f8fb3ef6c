"""What jobs write: records by task, maps, new versions of records, errors, scenes, and the report page. All are Spark writes;
the page alone is made by the driver, of as many rows as it shows."""

from __future__ import annotations

import html
import json
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from facetforge.sources import png
from facetforge.sources.arrays import scene_bytes
from facetforge.sources.named import written

#: Signs of an exception that are kept.
TAIL = 1500


def records(df: DataFrame, path: str, by: str = "task") -> None:
    """A folder of records for each task; what other tasks left there stays."""
    df.write.mode("append").partitionBy(by).json(path)


def overwritten(df: DataFrame, path: str, by: str = "task") -> None:
    """The same, but a task's earlier records go first. Only the tasks that are written are cleared."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).json(path)


def by_pair(df: DataFrame, path: str, name: str = "meta.json") -> None:
    """A record for each pair's folder, <path>/<task>/<name>/meta.json: of the columns task and name, and the others."""
    others = [c for c in df.columns if c not in ("task", "name")]
    record = F.to_json(F.struct("task", *others), {"pretty": "true"})
    written(df.select(F.concat_ws("/", "task", "name", F.lit(name)).alias("path"), F.encode(record, "utf-8").alias("content")), path)


def as_map(df: DataFrame, path: str, key: str) -> None:
    """Files that each hold one map {key: record, ...}, an entry a line; a file for each task."""
    value = F.struct(*(c for c in df.columns if c != key))
    # An entry is a map of one record without its braces.
    entry = F.regexp_replace(F.to_json(F.create_map(F.col(key).cast("string"), value)), r"(?s)^\{|\}$", "")

    def braced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = True
        for batch in batches:
            for value in batch.column(0).to_pylist():
                yield pa.RecordBatch.from_arrays([pa.array([("{" if first else ",") + value])], ["value"])
                first = False
        if not first:
            yield pa.RecordBatch.from_arrays([pa.array(["}"])], ["value"])

    df.where(F.col(key).isNotNull()).select(entry.alias("value")).mapInArrow(braced, "value string").write.mode("overwrite").text(path)


def counted(df: DataFrame, path: str, **counters: Column) -> dict:
    """Writes the rows as Parquet and returns the counters over them, taken by the same job as it writes."""
    seen = Observation()
    df.observe(seen, *(c.alias(n) for n, c in counters.items())).write.mode("overwrite").parquet(path)
    return seen.get


def updated(df: DataFrame, changes: DataFrame, key: list[str], columns: list[str]) -> DataFrame:
    """The next version of a table: the columns as `changes` has them, where it has a row that isn't null. Nothing is changed
    in place; the caller writes the version beside the last one."""
    new = changes.select(*key, *(F.col(c).alias(f"_{c}") for c in columns))
    rows = df.join(new, key, "left")
    return rows.withColumns({c: F.coalesce(F.col(f"_{c}"), F.col(c)) for c in columns}).select(df.columns)


def split_errors(df: DataFrame, failed: Column, exc: Column, key: list[str]) -> tuple[DataFrame, DataFrame]:
    """The good rows, and a record for each failed one: its key, error = true, and the end of its exception."""
    bad = F.coalesce(failed, F.lit(False))
    errors = df.where(bad).select(*key, F.lit(True).alias("error"), F.right(exc, F.lit(TAIL)).alias("exc"))
    return df.where(~bad), errors


def scene_files(vertices: DataFrame, faces: DataFrame, textures: DataFrame | None = None) -> DataFrame:
    """sha, content: each asset's meshes as a scene file. vertices: sha, mesh, vid, x, y, z, and u, v if they have places in the
    atlas; faces: sha, mesh, fidx, v0, v1, v2, with vid from 0 inside a mesh; textures: sha, wide, high, pixels, one for each
    asset that has any. A scene is one file, so an asset is one group."""
    uv = [c for c in ("u", "v") if c in vertices.columns]
    v = vertices.groupBy("sha").agg(F.sort_array(F.collect_list(F.struct("mesh", "vid", "x", "y", "z", *uv))).alias("v"))
    f = faces.groupBy("sha").agg(F.sort_array(F.collect_list(F.struct("mesh", "fidx", "v0", "v1", "v2"))).alias("f"))

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            out = []
            for sha, vs, fs, wide, high, pixels in rows.itertuples(index=False):
                points, sides = pd.DataFrame(list(vs)), pd.DataFrame(list(fs))
                images = [] if pixels is None else [png.encoded(int(wide), int(high), bytes(pixels))]
                meshes = []
                for m, own in sides.groupby("mesh", sort=True):
                    at = points.loc[points["mesh"] == m]
                    place = at[uv].to_numpy(float) if uv and at[uv].notna().all(axis=None) else None
                    meshes.append((at[["x", "y", "z"]].to_numpy(), own[["v0", "v1", "v2"]].to_numpy(np.int64), place, 0 if images and place is not None else None))
                out.append((sha, scene_bytes(meshes, images)))
            yield pd.DataFrame(out, columns=["sha", "content"])

    both = v.join(f, "sha")
    both = both.join(textures.select("sha", "wide", "high", "pixels"), "sha", "left") if textures is not None else both.selectExpr("*", "cast(null as int) wide", "cast(null as int) high", "cast(null as binary) pixels")
    return both.select("sha", "v", "f", "wide", "high", "pixels").mapInPandas(write, f"sha {vertices.schema['sha'].dataType.simpleString()}, content binary")


def scenes(vertices: DataFrame, faces: DataFrame, path: str, textures: DataFrame | None = None) -> None:
    """Writes each asset's scene as <path>/<sha>.glb."""
    made = scene_files(vertices, faces, textures)
    written(made.select(F.concat(F.col("sha").cast("string"), F.lit(".glb")).alias("path"), "content"), path)


def page(rows: DataFrame, template: str, values: dict[str, str], most: int = 5000) -> str:
    """The report: the template with {{name}} filled in, and {{rows}} as a list of records. The rows of a page are shown, so
    they are few: more than `most` are an error, not cut."""
    got = rows.limit(most + 1).toJSON().collect()
    if len(got) > most:
        raise ValueError(f"a page shows at most {most} rows")
    # In one pass: what is put in isn't filled in again.
    known = {n: html.escape(v) for n, v in values.items()} | {"rows": "[" + ",".join(json.dumps(json.loads(r)).replace("</", "<\\/") for r in got) + "]"}
    return re.sub(r"\{\{(\w+)\}\}", lambda m: known.get(m[1], m[0]), template)
