"""Command lines: `python -m rasterloom.plans.cli COMMAND ...`, with the commands and defaults of the pipeline's steps."""

from __future__ import annotations

import argparse
import os
import time

from pyspark.sql import functions as F

from rasterloom.functions import names, scratch
from rasterloom.operators import blend, context, fuse, mosaic, points, process, tiles, vector
from rasterloom.session import local_session
from rasterloom.sources import fetch, las, manifest, ortho, tiff, vectors


def _tile_meta(m):
    """Mosaic metadata of decoded files."""
    return m.withColumn("left", F.col("x0")).withColumn("top", F.col("y1")).withColumn("right", F.col("x0") + F.col("a") * F.col("width")).withColumn("bottom", F.col("y1") + F.col("e") * F.col("height"))


def update_manifest(spark, a) -> None:
    """Manifests from URL lists (--train, --test) or a `;` table (--table)."""
    if a.table:
        rows = manifest.read_tile_csv(spark, a.table)
        cat = tiles.entries(rows, "test", F.col("nom"), suffixed=True)
    else:
        cat = None
        for split in ("train", "test"):
            if getattr(a, split):
                part = tiles.entries(manifest.read_url_list(spark, getattr(a, split)), split)
                cat = part if cat is None else cat.unionByName(part)
    if cat is None:
        raise SystemExit("give --table, --train or --test")
    manifest.write_manifest(cat, a.output)


def prepare_data(spark, a) -> None:
    """Class rasters of a folder's LAS files, or of a manifest's tiles; with --orthophotos their images, too."""
    if a.manifest:
        listed = manifest.read_manifest(spark, a.manifest).where(F.col("split").isin(*a.splits))
        for split in a.splits:
            rows = listed.where(F.col("split") == split)
            began = time.time()
            done = [fetch.downloaded(rows.select("tile_id", "url"), f"{a.input}/{split}").cache()]
            if a.orthophotos:
                images = rows.select("tile_id", names.orthophoto_url(F.col("tile_id"), a.orthophotos, a.orthophoto_suffix).alias("url"))
                done.append(ortho.prepared(images, f"{a.output}/{split}", a.resolution).cache())
            both = process.appended(*done)
            if done[0].where("status = 'success'").count():
                _class_rasters(spark, f"{a.input}/{split}", f"{a.output}/{split}", a)
            process.summary(both, time.time() - began).show()
            process.failed_lines(both).show(truncate=False)
        return
    began = time.time()
    done = _class_rasters(spark, a.input, a.output, a)
    process.summary(done, time.time() - began).show()


def _class_rasters(spark, source: str, folder: str, a):
    cloud = las.read(spark, source)
    box = points.extents(cloud, a.resolution)
    dense = points.densified(points.rasterized(cloud, a.resolution, a.extended), box.select("tile_id", "rows", "cols"))
    meta = box.select("tile_id", F.col("xmin").alias("x0"), F.col("ymax").alias("y1"), F.col("pixel_x").alias("a"), (-F.col("pixel_y")).alias("e"), F.col("cols").alias("width"), F.col("rows").alias("height"), F.lit(a.crs).alias("crs"))
    done = tiff.write(dense, meta, folder, prefix="classification_map_").select("tile_id", F.lit("success").alias("status"), F.lit(None).cast("string").alias("error")).cache()
    done.count()
    return done


def map_images(spark, a) -> None:
    """A map service's image for each raster of a folder."""
    meta = tiff.metadata(spark, a.input, a.pattern).withColumn("tile_id", F.regexp_replace("tile_id", "^classification_map_", ""))
    ortho.from_map_service(meta.select("tile_id", "x0", "y1", "a", "e", "width", "height", "crs"), a.output, a.service, a.layer, a.resolution, a.image_format).show(truncate=False)


def merge_classifications(spark, a) -> None:
    """Fused rasters of the tiles that both folders have."""
    p, m = tiff.metadata(spark, a.points, a.points_pattern), tiff.metadata(spark, a.model)
    pairs = fuse.matched(p.select("path"), m.select("path"), strict_name=a.strict_names).select(F.concat(F.lit("merged_"), "id").alias("name"), "points_path", "model_path")
    left = tiff.read(spark, a.points, pattern=a.points_pattern).join(p.select("tile_id", "path"), "tile_id").join(pairs, F.col("path") == F.col("points_path")).select(F.col("name").alias("tile_id"), "row", "col", F.col("value").cast("smallint").alias("value"))
    right = tiff.read(spark, a.model).join(m.select("tile_id", "path"), "tile_id").join(pairs, F.col("path") == F.col("model_path")).select(F.col("name").alias("tile_id"), "row", "col", F.col("value").cast("smallint").alias("value"))
    grid = p.join(pairs, F.col("path") == F.col("points_path")).select(F.col("name").alias("tile_id"), "x0", "y1", "a", "e", "width", "height", "crs")
    model_grid = m.join(pairs, F.col("path") == F.col("model_path")).select(F.col("name").alias("tile_id"), "x0", "y1", "a", "e", "width", "height")
    # only rasters of another shape are brought to the points' grid
    same = grid.select("tile_id", "width", "height").join(model_grid.select("tile_id", "width", "height"), ["tile_id", "width", "height"]).select("tile_id")
    fitted = right.join(same, "tile_id", "left_semi").unionByName(fuse.resampled_to(right, model_grid, grid.join(same, "tile_id", "left_anti")))
    out = fuse.fused(left, fitted)
    tiff.write(out, grid, a.output).select("path").show(truncate=False)
    fuse.distribution(out).show()
    fuse.skipped(p.select("path"), m.select("path")).show(truncate=False)


def _exists(path: str) -> bool:
    return "://" not in path and os.path.exists(path)


def merge_tifs(spark, a) -> None:
    """One mosaic of a folder's tiles: a GeoTIFF, or beyond --block pixels one for each block and a VRT over them."""
    if not a.overwrite and any(_exists(f"{a.output}/{a.name}.{x}") for x in ("tif", "vrt")):
        raise SystemExit(f"{a.output}/{a.name} is there already; --overwrite replaces it")
    meta = _tile_meta(tiff.metadata(spark, a.input)).cache()
    if not meta.count():
        raise SystemExit(f"no tiles in {a.input}")
    odd, other_types = mosaic.verified(meta, a.tolerance, a.resample_mismatch)
    if other_types:
        print(f"warning: {other_types} tiles of another data type")
    e = mosaic.extent(meta).first()
    px = tiff.read(spark, a.input).withColumn("value", F.col("value").cast("smallint"))
    if odd:
        print(f"{odd} tiles are resampled")
        px, meta = mosaic.on_grid(px, meta, a.tolerance)
    clip = (a.clip_min, a.clip_max) if a.clip_min is not None and a.clip_max is not None else None
    merged, _ = scratch.written(mosaic.merged(mosaic.global_pixels(px, mosaic.placed(meta)), a.strategy, a.nodata, clip), "mosaic")
    fill = int(a.nodata if a.nodata is not None else (merged.agg(F.min("value")).first()[0] if a.strategy == "mode" else 0))
    inner, grids = mosaic.blocks(merged, e, a.name, a.block, fill)
    if max(e.height, e.width) <= a.block:
        inner, grids = (t.withColumn("tile_id", F.lit(a.name)) for t in (inner, grids))
        tiff.write(inner, grids, a.output, nodata=a.nodata, fill=fill).show(truncate=False)
    else:
        done = tiff.write(inner, grids, a.output, nodata=a.nodata, fill=fill).cache()
        done.show(truncate=False)
        tiff.write_vrt(grids.join(done, "tile_id").collect(), e, f"{a.output}/{a.name}.vrt", a.nodata)
    if a.smooth:
        polys = vector.polygons(vector.components(merged, nodata=a.nodata)).withColumn("rings", vector.to_map(F.col("rings"), e.left, e.top, e.ref_a, e.ref_e))
        each = polys.select("component_id", "class", F.posexplode("rings").alias("k", "ring"))
        smooth = vector.smoothed(each, iterations=a.smooth_iterations).groupBy("component_id", "class").agg(F.transform(F.array_sort(F.collect_list(F.struct("k", "ring"))), lambda r: r["ring"]).alias("rings"))
        vectors.write(smooth, f"{a.output}/{a.name}_smoothed.gpkg", "GPKG", srs=_epsg(e.ref_crs)).show(truncate=False)


def _epsg(crs: str | None) -> int:
    return int(crs[5:]) if crs and crs.startswith("EPSG:") else -1


def _raster(spark, path: str):
    """Pixels (grow, gcol, value) of a GeoTIFF, a folder of tiles, or a mosaic's VRT, and the row of its extent."""
    where, pattern = (path[: path.rfind("/")], path.rsplit("/", 1)[-1][:-4] + "_*_*.tif") if path.endswith(".vrt") else (path, "*.tif")
    meta = _tile_meta(tiff.metadata(spark, where, pattern))
    px = tiff.read(spark, where, pattern=pattern)
    return mosaic.global_pixels(px, mosaic.placed(meta)).select("grow", "gcol", F.col("value").cast("int").alias("value")), mosaic.extent(meta).first()


def vectorize(spark, a) -> None:
    """A raster's regions as polygons: GPKG, ESRI Shapefile or GeoJSON features, a line each."""
    form = spark.range(1).select(names.vector_format(F.lit(a.output))).first()[0] if a.format == "auto" else a.format
    px, e = _raster(spark, a.input)
    polys = vector.polygons(vector.components(px, a.eight_connected)).withColumn("rings", vector.to_map(F.col("rings"), e.left, e.top, e.ref_a, e.ref_e))
    if form == "GeoJSON":
        vector.geojson(polys, field=a.field_name).write.mode("overwrite").text(a.output)
    else:
        vectors.write(polys, a.output, form, a.field_name, _epsg(e.ref_crs), single=not a.parts).show(truncate=False)


def inference(spark, a) -> None:
    """Class maps of tiles by a model (module:function giving a callable on (h, w, 3) arrays), each in its 3 x 3 context."""
    import importlib

    module, _, function = a.model.partition(":")
    load = getattr(importlib.import_module(module), function)
    found = tiff.contents(spark, a.input, "orthophoto_*.tif").withColumn("key", names.tile_key(F.col("tile_id"))).where("key IS NOT NULL")
    images = found.select("key.tx", "key.ty", F.regexp_replace("tile_id", "^orthophoto_", "").alias("tile_id"), "content")
    modes = None if a.no_tta else tuple(a.tta_modes or blend.DEFAULT_MODES)
    out = context.predicted(images, a.model, load, a.classes, a.tile_size, a.overlap, a.grid_step, modes, a.classes == 19, names.parsed_bias(a.class_bias), a.herb_margin)
    tiff.write_rasters(out, a.output, prefix="prediction_", nodata=255).show(truncate=False)


def phase(spark, title: str, words: list[str]) -> bool:
    """Runs a command; whether it ended without an error, which is told."""
    print(f"{title}: {' '.join(words)}")
    try:
        main(words, spark)
    except (Exception, SystemExit) as e:  # noqa: BLE001  a phase that fails is reported, and the pipeline decides
        print(f"{title} failed: {e}")
        return False
    return True


EXTENSIONS = {"ESRI Shapefile": "shp", "GPKG": "gpkg", "GeoJSON": "geojson"}


def run_pipeline(spark, a) -> None:
    """All phases: data, class maps, fusion, one mosaic a split, polygons. Data and mosaics must succeed; splits without
    fused rasters are left out."""
    if not _exists(a.manifest):
        raise SystemExit(f"no manifest {a.manifest}; update-manifest makes one")
    began, base = time.time(), a.base.rstrip("/")
    predictions, merged = f"{base}/predictions_{a.output_name}", f"{base}/merged_classifications_{a.output_name}"
    if not (a.only_merge or a.skip_data_prep):
        words = ["prepare-data", "--manifest", a.manifest, "--input", f"{base}/data", "--output", f"{base}/data", "--resolution", str(a.resolution), "--extended", "--splits", *a.splits]
        if a.orthophotos:
            words += ["--orthophotos", a.orthophotos]
        if not phase(spark, "data", words):
            raise SystemExit(1)
    if not (a.only_merge or a.skip_inference):
        if not a.model:
            raise SystemExit("inference needs --model")
        for split in a.splits:
            words = ["inference", "--input", f"{base}/data/{split}", "--output", f"{predictions}/{split}", "--model", a.model, "--classes", str(a.classes), "--tile-size", str(a.tile_size), "--overlap", str(a.overlap), "--grid-step", str(a.grid_step)]
            if not phase(spark, f"class maps of {split}", words + (["--no-tta"] if a.no_tta else [])):
                raise SystemExit(1)
    if not (a.only_merge or a.skip_merge):
        for split in a.splits:
            phase(spark, f"fusion of {split}", ["merge-classifications", "--points", f"{base}/data/{split}", "--points-pattern", "classification_map_*.tif", "--model", f"{predictions}/{split}", "--output", f"{merged}/{split}"])
    for split in a.splits:
        if not _exists(f"{merged}/{split}"):
            print(f"no fused rasters of {split}")
            continue
        words = ["merge-tifs", "--input", f"{merged}/{split}", "--output", base, "--name", f"final_{a.output_name}_{split}", "--strategy", a.merge_strategy, "--clip-min", "0", "--clip-max", "3", "--overwrite"]
        if not phase(spark, f"mosaic of {split}", words + (["--smooth"] if a.smooth else [])):
            raise SystemExit(1)
    made = {split: next((p for p in (f"{base}/final_{a.output_name}_{split}.{x}" for x in ("tif", "vrt")) if _exists(p)), None) for split in a.splits}
    for split, raster in made.items():
        if a.vectorize and raster:
            words = ["vectorize", "--input", raster, "--output", f"{base}/final_{a.output_name}_{split}.{EXTENSIONS[a.vector_format]}", "--format", a.vector_format, "--field-name", "vegetation_class"]
            phase(spark, f"polygons of {split}", words + (["--eight-connected"] if a.vector_8connected else []))
    print(f"pipeline complete in {time.time() - began:.1f} s: {', '.join(p for p in made.values() if p) or 'no mosaic'}")


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="rasterloom")
    sub = top.add_subparsers(dest="command", required=True)

    def command(name: str, run, *arguments) -> None:
        p = sub.add_parser(name, help=run.__doc__)
        for flag, options in arguments:
            p.add_argument(flag, **options)
        p.set_defaults(run=run)

    required = {"required": True}
    command("update-manifest", update_manifest, ("--table", {}), ("--train", {}), ("--test", {}), ("--output", required))
    resolution = ("--resolution", {"type": float, "default": 0.2})
    command(
        "prepare-data", prepare_data, ("--input", required), ("--output", required), ("--manifest", {}), ("--splits", {"nargs": "+", "default": ["train", "test"]}), resolution, ("--extended", {"action": "store_true"}), ("--crs", {"default": "EPSG:2154"}),
        ("--orthophotos", {}), ("--orthophoto-suffix", {"default": ".tif"}),
    )
    command(
        "map-images", map_images, ("--input", required), ("--output", required), ("--pattern", {"default": "classification_map_*.tif"}), ("--service", required), ("--layer", required), ("--resolution", {"type": float, "default": 0.8}),
        ("--image-format", {"default": "image/tiff"}),
    )
    model = [("--classes", {"type": int, "default": 4}), ("--grid-step", {"type": int, "default": 5}), ("--no-tta", {"action": "store_true"})]
    command(
        "inference", inference, ("--input", required), ("--output", required), ("--model", required), ("--tile-size", {"type": int, "default": 512}), ("--overlap", {"type": int, "default": 256}), *model,
        ("--tta-modes", {"nargs": "*"}), ("--class-bias", {"nargs": "*"}), ("--herb-margin", {"type": float, "default": 3.0}),
    )
    command("merge-classifications", merge_classifications, ("--points", required), ("--model", required), ("--output", required), ("--strict-names", {"action": "store_true"}), ("--points-pattern", {"default": "*.tif"}))
    strategy = {"choices": mosaic.STRATEGIES, "default": "mode"}
    command(
        "merge-tifs", merge_tifs, ("--input", required), ("--output", required), ("--name", {"default": "mosaic"}), ("--strategy", strategy), ("--nodata", {"type": int}), ("--smooth", {"action": "store_true"}),
        ("--smooth-iterations", {"type": int, "default": 3}), ("--clip-min", {"type": int}), ("--clip-max", {"type": int}), ("--tolerance", {"type": float, "default": 1e-3}), ("--resample-mismatch", {"action": "store_true"}),
        ("--block", {"type": int, "default": 2048}), ("--overwrite", {"action": "store_true"}),
    )
    command("vectorize", vectorize, ("--input", required), ("--output", required), ("--format", {"default": "auto"}), ("--field-name", {"default": "class"}), ("--eight-connected", {"action": "store_true"}), ("--parts", {"action": "store_true"}))
    flags = [(f"--{x}", {"action": "store_true"}) for x in ("smooth", "skip-data-prep", "skip-inference", "skip-merge", "only-merge", "vectorize", "vector-8connected")]
    command(
        "pipeline", run_pipeline, ("--manifest", required), ("--model", {}), ("--base", {"default": "."}), ("--resolution", {"type": float, "default": 0.8}), ("--orthophotos", {}), ("--tile-size", {"type": int, "default": 384}),
        ("--overlap", {"type": int, "default": 192}), *model, ("--splits", {"nargs": "+", "default": ["test"]}), ("--output-name", {"default": "mosaic"}), ("--merge-strategy", strategy),
        ("--vector-format", {"choices": list(EXTENSIONS), "default": "ESRI Shapefile"}), *flags,
    )
    return top


def main(words: list[str] | None = None, spark=None) -> None:
    a = parser().parse_args(words)
    a.run(spark or local_session(), a)


if __name__ == "__main__":
    main()
