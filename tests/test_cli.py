"""The command lines, from point files to polygons."""

import json
import os

import pandas as pd
import pytest

from rasterloom.plans import cli
from rasterloom.sources import las, tiff


def constant_model():
    import numpy as np

    return lambda cube: np.stack([np.full(cube.shape[:2], float(k == 1)) for k in range(4)], axis=2)


def test_from_points_to_polygons(spark, tmp_path):
    d = str(tmp_path)
    os.makedirs(f"{d}/las")
    for x, y in ((100, 200), (101, 200)):
        rows = [(x * 4 + i % 4 + 0.5, y * 4 + i // 4 + 0.5, 5 if i % 3 else 3) for i in range(16)] + [(x * 4.0, y * 4.0, 6), (x * 4 + 4.0, y * 4 + 4.0, 6)]
        with open(f"{d}/las/{x}_{y}.las", "wb") as f:
            f.write(las.encode(pd.DataFrame(rows, columns=["x", "y", "classification"])))
    cli.main(["prepare-data", "--input", f"{d}/las", "--output", f"{d}/points", "--resolution", "1"], spark)
    assert sorted(os.listdir(f"{d}/points")) == ["classification_map_100_200.tif", "classification_map_101_200.tif"]

    os.makedirs(f"{d}/ortho")
    import numpy as np

    for x in (100, 101):
        with open(f"{d}/ortho/orthophoto_{x}_200.tif", "wb") as f:
            f.write(tiff.encode(np.full((3, 4, 4), 90, np.uint8), x * 4.0, 804.0, 1.0, -1.0))
    cli.main(["inference", "--input", f"{d}/ortho", "--output", f"{d}/model", "--model", "tests.test_cli:constant_model", "--tile-size", "6", "--overlap", "3", "--grid-step", "1", "--herb-margin", "0"], spark)
    cli.main(["merge-classifications", "--points", f"{d}/points", "--model", f"{d}/model", "--output", f"{d}/merged"], spark)
    assert sorted(os.listdir(f"{d}/merged")) == ["merged_100_200.tif", "merged_101_200.tif"]
    cli.main(["merge-tifs", "--input", f"{d}/merged", "--output", f"{d}/out", "--clip-min", "0", "--clip-max", "3", "--smooth"], spark)
    with open(f"{d}/out/mosaic.tif", "rb") as f:
        data = f.read()
    assert tiff.decode(data).shape == (1, 4, 8)
    cli.main(["vectorize", "--input", f"{d}/out/mosaic.tif", "--output", f"{d}/out/v.geojson"], spark)
    lines = [json.loads(r.value) for r in spark.read.text(f"{d}/out/v.geojson").collect()]
    assert lines and {x["geometry"]["type"] for x in lines} == {"Polygon"}
    # the same in blocks, under a virtual raster
    cli.main(["merge-tifs", "--input", f"{d}/merged", "--output", f"{d}/blocks", "--clip-min", "0", "--clip-max", "3", "--block", "3"], spark)
    assert os.path.exists(f"{d}/blocks/mosaic.vrt") and len([n for n in os.listdir(f"{d}/blocks") if n.endswith(".tif")]) == 6
    cli.main(["vectorize", "--input", f"{d}/blocks/mosaic.vrt", "--output", f"{d}/blocks/v.geojson"], spark)
    assert sorted(r.value for r in spark.read.text(f"{d}/blocks/v.geojson").collect()) == sorted(r.value for r in spark.read.text(f"{d}/out/v.geojson").collect())
    with pytest.raises(SystemExit, match="overwrite"):
        cli.main(["merge-tifs", "--input", f"{d}/merged", "--output", f"{d}/blocks", "--block", "3"], spark)
    os.makedirs(f"{d}/empty")
    with pytest.raises(SystemExit, match="no tiles"):
        cli.main(["merge-tifs", "--input", f"{d}/empty", "--output", f"{d}/x"], spark)
    import sqlite3

    with sqlite3.connect(f"{d}/out/mosaic_smoothed.gpkg") as db:
        assert db.execute("SELECT count(*) FROM vegetation").fetchone()[0] == len(lines)


def put(folder, name, cube, x0, y1, a, crs="EPSG:2154"):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "wb") as f:
        f.write(tiff.encode(cube, x0, y1, a, -a, crs))


def test_mosaic_of_unlike_tiles(spark, tmp_path):
    """Another CRS is an error, another resolution too unless it is resampled."""
    import numpy as np

    d = str(tmp_path)
    one, two = np.full((1, 4, 4), 1, np.uint8), np.array([[[2, 3], [0, 1]]], np.uint8)
    put(f"{d}/crs", "a.tif", one, 0.0, 4.0, 1.0)
    put(f"{d}/crs", "b.tif", one, 4.0, 4.0, 1.0, "EPSG:3946")
    with pytest.raises(Exception, match="another CRS"):
        cli.main(["merge-tifs", "--input", f"{d}/crs", "--output", f"{d}/o1"], spark)
    put(f"{d}/size", "a.tif", one, 0.0, 4.0, 1.0)
    put(f"{d}/size", "b.tif", two, 4.0, 4.0, 2.0)
    with pytest.raises(Exception, match="another resolution"):
        cli.main(["merge-tifs", "--input", f"{d}/size", "--output", f"{d}/o2"], spark)
    cli.main(["merge-tifs", "--input", f"{d}/size", "--output", f"{d}/o3", "--resample-mismatch"], spark)
    with open(f"{d}/o3/mosaic.tif", "rb") as f:
        got = tiff.decode(f.read())[0]
    assert got.tolist() == [[1, 1, 1, 1, 2, 2, 3, 3]] * 2 + [[1, 1, 1, 1, 0, 0, 1, 1]] * 2


def test_pipeline_command(spark, tmp_path, capsys):
    """All phases from a manifest of local files to a GeoPackage; missing inputs end it."""
    import numpy as np

    from rasterloom.sources import manifest

    d = str(tmp_path)
    os.makedirs(f"{d}/src")
    rows = []
    for x, y in ((100, 200), (101, 200)):
        pts = [(x * 4 + i % 4 + 0.5, y * 4 + i // 4 + 0.5, 5 if i % 3 else 3) for i in range(16)] + [(x * 4.0, y * 4.0, 6), (x * 4 + 4.0, y * 4 + 4.0, 6)]
        with open(f"{d}/src/{x}_{y}.las", "wb") as f:
            f.write(las.encode(pd.DataFrame(pts, columns=["x", "y", "classification"])))
        put(f"{d}/images", f"{x}_{y}.tif", np.full((3, 8, 8), 90, np.uint8), x * 4.0, 804.0, 0.5)
        rows.append(("test", f"{x}_{y}", f"test/orthophoto_{x}_{y}.tif", f"test/classification_map_{x}_{y}.tif", f"file://{d}/src/{x}_{y}.las"))
    manifest.write_manifest(spark.createDataFrame(rows, "split string, tile_id string, orthophoto string, classification_map string, url string"), f"{d}/manifest")
    words = ["pipeline", "--manifest", f"{d}/manifest", "--base", d, "--model", "tests.test_cli:constant_model", "--resolution", "1", "--orthophotos", f"file://{d}/images", "--tile-size", "6", "--overlap", "3", "--grid-step", "1", "--output-name", "town", "--vectorize", "--vector-format", "GPKG"]
    cli.main(words, spark)
    assert sorted(os.listdir(f"{d}/data/test"))[2:] == ["classification_map_100_200.tif", "classification_map_101_200.tif", "orthophoto_100_200.tif", "orthophoto_101_200.tif"]
    assert os.path.exists(f"{d}/final_town_test.tif") and os.path.exists(f"{d}/final_town_test.gpkg") and "pipeline complete" in capsys.readouterr().out
    cli.main([*words[:-3], "--only-merge", "--splits", "test", "train"], spark)
    assert "no fused rasters of train" in capsys.readouterr().out
    with pytest.raises(SystemExit, match="no manifest"):
        cli.main(["pipeline", "--manifest", f"{d}/none", "--base", d], spark)
    with pytest.raises(SystemExit):
        cli.main(["pipeline", "--manifest", f"{d}/manifest", "--base", f"{d}/other", "--skip-data-prep", "--model", "no.such:model"], spark)


def test_update_manifest(spark, tmp_path):
    from rasterloom.sources import manifest

    (tmp_path / "t.txt").write_text("http://x/LHD_FXX_0001_0002_P.laz\n")
    cli.main(["update-manifest", "--train", str(tmp_path / "t.txt"), "--output", str(tmp_path / "m")], spark)
    row = manifest.read_manifest(spark, str(tmp_path / "m")).first()
    assert (row.split, row.tile_id, row.orthophoto) == ("train", "0001_0002", "train/orthophoto_0001_0002.tif")
