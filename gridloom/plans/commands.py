"""The commands: initialise, materialise, build overviews, validate, release, and so on.

Each is one function over a store; the work is a lazy plan per batch of cells, the batch being
what a checkpoint commits.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom import spec
from gridloom.functions import metadata
from gridloom.functions.lattice import TILE_NAME, div, mosaic_offset
from gridloom.operators import checks, inventory, ledger, place
from gridloom.operators.pyramid import plan_counts, pyramid, regions
from gridloom.plans.store import LEDGER_CELLS, EncodingMismatch, Session, SnapshotStore, StoreError, retried
from gridloom.sources.inventory import parse_mosaic
from gridloom.spec import EncodingSpec, GridSpec, PropertySpec

Checkpoint = Callable[[Session], None]


def catalogue(properties: list[PropertySpec], grid: GridSpec, encoding: EncodingSpec, factors: tuple[int, ...]) -> dict[str, object]:
    """Every node of a store by its path, with its attributes: root, coordinates and the arrays,
    natively and for each level."""
    axes = metadata.coordinates(grid)
    wanted: dict[str, object] = {
        "/": {"region": metadata.region_note(grid), "spatial_ref": metadata.spatial_ref(grid), "multiscales": metadata.multiscales(factors)},
        "/x": axes["x"] | {"size": grid.width, "first": grid.x_min + grid.pixel / 2},
        "/y": axes["y"] | {"size": grid.height, "first": grid.y_max - grid.pixel / 2},
    }
    shapes = {1: (grid.height, grid.width), **grid.level_shapes(factors)}
    for p in properties:
        for f, (h, w) in shapes.items():
            path = p.array_path if f == 1 else f"{p.group}/{f}x/{p.name}"
            shape = [len(p.depths), h, w][3 - p.ndim :]
            wanted[path] = {
                **metadata.property_attributes(p, f),
                **metadata.geo_attributes(h, w, grid.pixel * f, grid),
                "shape": shape,
                "dtype": "float32",
                "fill": "NaN",
                "chunks": list(encoding.chunks(p.ndim)),
                "shards": list(encoding.shards(p.ndim, len(p.depths) if f == 1 else 1)),
                "codec": f"{encoding.codec}-{encoding.level}",
                "depth_interval": [d.label for d in p.depths],
            }
    return wanted


def init_store(store: SnapshotStore, properties: list[PropertySpec], grid: GridSpec, encoding: EncodingSpec, factors: tuple[int, ...]) -> list[str]:
    """Create what is missing: groups, coordinates, attributes and empty arrays, natively and
    for each level. Idempotent and additive; another encoding is refused. Returns what was
    created."""
    held = store.attributes()
    wanted = catalogue(properties, grid, encoding, factors)
    session = store.writable()
    created = []
    for path, value in wanted.items():
        before = held.get(path)
        if before is None:
            created.append(path)
            session.attribute(path, value)
        elif isinstance(value, dict) and "chunks" in value and any(before[k] != value[k] for k in ("shape", "dtype", "chunks", "shards", "codec")):
            raise EncodingMismatch(f"{path} is stored otherwise")
    if created:
        session.commit(f"init {len(created)} nodes")
    return created


def inspect_source(
    mosaics: DataFrame,
    listing: DataFrame,
    disk_headers: DataFrame,
    properties: list[PropertySpec],
    grid: GridSpec,
    base_url: str,
) -> tuple[DataFrame, DataFrame, dict[str, object]]:
    """From inventories to a manifest: ``(manifest, issues, report)``.

    ``mosaics`` has property, depth and xml; ``listing`` has property, depth, relpath and size of
    what lies on the disk; ``disk_headers`` adds header and error for tiles to repair. Headers
    are verified against the specification, windows are de-duplicated, both sides of the
    listing are compared, and tiles that only the disk has are recovered where they fit. The
    manifest and the issues are lazy; the report counts them.
    """
    headers, sources = parse_mosaic(mosaics)
    rows = issues = None
    for p in properties:
        own = headers.where(F.col("property") == p.name)
        at = own.select("property", "depth", *(c.alias(n) for c, n in zip(mosaic_offset(F.col("geotransform"), grid), ("ox", "oy"))))
        placed = sources.where(F.col("property") == p.name).join(F.broadcast(at), ["property", "depth"])
        url = F.concat(F.lit(f"{base_url.rstrip('/')}/{p.name}/{p.name}_"), F.regexp_replace("depth", "_", "-"), F.lit("cm_mean"))
        built = inventory.build_manifest(placed, (F.col("ox"), F.col("oy")), p.tile_px, url, grid)
        found = inventory.layer_issues(own, p)
        rows = built if rows is None else rows.unionByName(built)
        issues = found if issues is None else issues.unionByName(found)
    kept, conflicts = inventory.dedupe_windows(rows)
    keys = ["property", "depth", "relpath"]
    # a tile that lost its window is still in the inventory
    disk_only, vrt_only, _ = inventory.cross_check(rows, listing, keys)
    sized = inventory.cross_check(kept, listing, keys)[2]
    claims = disk_only.join(disk_headers, keys, "left")
    repaired = inventory.repair(claims.withColumn("error", F.when(F.col("header").isNull(), F.coalesce("error", F.lit("unread"))).otherwise(F.col("error"))), kept, grid)
    name = F.regexp_extract("relpath", "([^/]+)$", 1)
    part = lambda i: F.regexp_extract(name, TILE_NAME, i).cast("int")
    filled = {
        "cell": F.regexp_extract("relpath", "^([^/]+)/", 1), "subtile": F.format_string("%d-%d", part(3), part(4)), "url": F.col("relpath"), "width": F.col("header.width"),
        "height": F.col("header.height"), "cell_row": div(F.col("y_off"), grid.cell_px).cast("smallint"), "cell_col": div(F.col("x_off"), grid.cell_px).cast("smallint"),
        "is_full": F.col("header.width") == F.col("header.height"), "rows_per_strip": F.col("header.rows_per_strip"), "resampled_in_vrt": F.lit(False),
        "etag": F.lit(None).cast("string"), "modified": F.lit(None).cast("string"), "ordinal": F.lit(None).cast("bigint"),
    }
    recovered = repaired.where("class = 'recovered'").select(*[filled.get(f.name, F.col(f.name)).cast(f.dataType).alias(f.name) for f in spec.MANIFEST])
    manifest = sized.select(*[F.col(f.name).cast(f.dataType) for f in spec.MANIFEST]).unionByName(recovered)
    count = lambda df: df.count()
    report = {
        "layers": count(headers), "tiles": count(kept), "conflicts": count(conflicts), "misplaced": count(kept.where("misplaced")), "issues": count(issues),
        "inventory_only": count(vrt_only), "disk_only": {r["class"]: r["n"] for r in repaired.groupBy("class").agg(F.count("*").alias("n")).collect()},
        "anomalies": count(inventory.source_anomalies(sources)),
    }
    return manifest, issues, report


def materialize(
    store: SnapshotStore,
    prop: PropertySpec,
    manifest: DataFrame,
    tiles: DataFrame,
    grid: GridSpec,
    encoding: EncodingSpec,
    cells: list[tuple[int, int]] | None = None,
    commit_every: int = 16,
    overwrite: bool = False,
    checkpoint: Checkpoint | None = None,
) -> dict[str, int]:
    """Write a property's cells from decoded tiles (paths, header, values, error), in
    batches of ``commit_every`` cells, each one plan and one commit. Cells in the ledger are
    left alone unless ``overwrite``; a batch is one file set with a key for each cell, so a
    killed run loses at most a batch, a resumed one repeats nothing, and a cell that is written
    again takes the place of what it held, in the pixels as in the fills. A batch's tiles are
    decoded once."""
    spark = store.spark
    if grid.cell_px % encoding.shard:
        raise spec.SpecError("a cell isn't whole shards")
    own = place.depth_index(manifest.where(F.col("property") == prop.name), prop)
    everywhere = place.touched_cells(own, grid).select("cell_row", "cell_col").distinct()
    wanted = everywhere.withColumn("property", F.lit(prop.name))
    if cells is not None:
        wanted = place.only_cells(wanted, spark.createDataFrame(cells, "cell_row int, cell_col int"))
    done = store.ledger("cells", LEDGER_CELLS)
    if not overwrite:
        wanted = place.without_done(wanted, done)
    todo = sorted((r["cell_row"], r["cell_col"]) for r in wanted.select("cell_row", "cell_col").collect())
    stats = {"cells": 0, "pixels": 0, "filled": 0, "anomalies": 0}
    for at in range(0, len(todo), commit_every):
        batch = todo[at : at + commit_every]
        some = spark.createDataFrame(batch, "cell_row int, cell_col int")
        rows = place.touched_cells(own.drop("cell_row", "cell_col"), grid).join(F.broadcast(some), ["cell_row", "cell_col"], "left_semi")
        rows = rows.drop("cell_row", "cell_col").distinct()
        names = place.tile_keys(tiles)
        read = tiles.join(rows.select(*names).distinct(), names, "left_semi").persist()
        fine_rows, coarse_rows = rows.where("not resampled_in_vrt"), rows.where("resampled_in_vrt")
        fine = place.overwrite(place.place(place.check_tiles(read, fine_rows, grid), prop.divisor))
        coarse = place.resolve_coarse(coarse_rows.join(read, names), grid)
        coarse = coarse.withColumn("value", place.decode(F.col("raw"), prop.divisor))
        filled = place.gap_fill(place.expand_coarse(coarse, grid), place.covered_pixels(fine_rows))
        in_cell = lambda df, px: df.withColumn("cell_row", div(F.col("y"), px).cast("int")).withColumn("cell_col", div(F.col("x"), px).cast("int"))
        filled = in_cell(filled, grid.cell_px).join(F.broadcast(some), ["cell_row", "cell_col"], "left_semi").persist()
        pixels = in_cell(place.assemble(fine, filled), grid.cell_px).join(F.broadcast(some), ["cell_row", "cell_col"], "left_semi")
        pixels = pixels.drop("cell_row", "cell_col").withColumn("factor", F.lit(1))
        blocks = place.to_blocks(pixels, prop.group, encoding.shard, grid.height, grid.width)
        shards = grid.cell_px // encoding.shard
        blocks = blocks.withColumn("cell_row", div(F.col("by"), shards).cast("int")).withColumn("cell_col", div(F.col("bx"), shards).cast("int"))
        session = store.writable()
        keys = {(r, c): f"blocks/{prop.name}/1/{r:03d}-{c:03d}" for r, c in batch}
        session.write_each(keys, blocks.repartition("cell_row", "cell_col").sortWithinPartitions("cell_row", "cell_col", "depth_idx", "by", "bx"), ["cell_row", "cell_col"])
        session.record("cells", [(prop.name, r, c) for r, c in batch])
        counts = place.fill_counts(filled, "cell_row", "cell_col").collect()
        session.replace("fills", [0, 3, 4], [(prop.name, r, c) for r, c in batch])
        session.record("fills", [(prop.name, r["source"], prop.depths[r["depth_idx"]].label, r["cell_row"], r["cell_col"], r["pixels_filled"]) for r in counts])
        stats["anomalies"] += place.anomalies(rows.join(read, names)).count()
        read.unpersist()
        filled.unpersist()
        stats["filled"] += sum(r["pixels_filled"] for r in counts)
        stats["cells"] += len(batch)
        if checkpoint:
            checkpoint(session)
        session.commit(f"{prop.name}: {len(batch)} cells")
    return stats


def pixels_of(store: SnapshotStore, prop: PropertySpec, encoding: EncodingSpec, factor: int = 1, ref: int | str | None = None) -> DataFrame:
    """The stored pixels of a property at a level, as of a snapshot; none is an empty table."""
    prefix = f"blocks/{prop.name}/{factor}/"
    folders = [f for k, f in sorted(store.folders(ref).items()) if k.startswith(prefix)]
    if not folders:
        return store.spark.createDataFrame([], spec.PIXELS)
    return place.from_blocks(store.spark.read.schema(spec.BLOCKS).parquet(*folders), encoding.shard)


def _flagged(pixels: DataFrame, cells: DataFrame, span: int, grid: GridSpec) -> DataFrame:
    """``pixels`` with ``inside``: whether one of ``cells`` lies under it, a pixel spanning
    ``span`` native ones. Its corners are looked up in the cells, which a grid bounds."""
    if span > grid.cell_px:
        raise spec.SpecError("a pixel spans more than a cell")
    names = []
    for k, (dy, dx) in enumerate(((0, 0), (0, 1), (1, 0), (1, 1))):
        edge = lambda c, late: div((F.col(c).cast("long") + late) * span - late, grid.cell_px).cast("int")
        names.append(f"in_{k}")
        marked = cells.select(F.col("cell_row").alias("at_row"), F.col("cell_col").alias("at_col"), F.lit(True).alias(names[-1]))
        pixels = pixels.withColumn("at_row", edge("y", dy)).withColumn("at_col", edge("x", dx)).join(F.broadcast(marked), ["at_row", "at_col"], "left").drop("at_row", "at_col")
    return pixels.withColumn("inside", F.coalesce(*names, F.lit(False))).drop(*names)


def _mark_built(store: SnapshotStore, prop: PropertySpec) -> int:
    session = store.writable()
    session.record("built", [(prop.name,)])
    return session.commit(f"{prop.name}: built")


def build_overviews(
    store: SnapshotStore,
    prop: PropertySpec,
    grid: GridSpec,
    encoding: EncodingSpec,
    factors: tuple[int, ...],
    rebuild: bool = False,
    partial: bool = False,
    cells: list[tuple[int, int]] | None = None,
) -> int:
    """All levels of a property, each its own commit under a resume token that holds the scope.
    A token of another scope is ignored; a finished build clears it and, unless ``partial``,
    records the property as built, in a commit of its own that is retried. With ``cells`` only
    pixels over those of them that are written are computed again, the level's others stay, and
    the build is partial. Returns the levels written."""
    spark = store.spark
    partial = partial or cells is not None
    if not rebuild and not partial and store.ledger("built", "property string").where(F.col("property") == prop.name).count():
        return 0
    held = sorted((r["cell_row"], r["cell_col"]) for r in ledger.done_cells(store.ledger("cells", LEDGER_CELLS)).where(F.col("property") == prop.name).collect())
    todo = held if cells is None else sorted(set(held) & set(cells))
    if not todo:
        raise StoreError(f"{prop.name} has no cells yet")
    scope = metadata.scope_key(prop.name, factors, todo)
    token = store.attributes().get(f"progress/{prop.name}") or {}
    start = factors.index(token["factor"]) + 1 if token.get("key") == scope and token.get("factor") in factors else 0
    shapes = grid.level_shapes(factors)
    wanted = spark.createDataFrame(todo, "cell_row int, cell_col int")
    total = plan_counts(regions(wanted, factors, encoding.shard, len(prop.depths), grid)).agg(F.sum("regions")).first()[0]
    source = pixels_of(store, prop, encoding, factors[start - 1] if start else 1)
    done = factors[start - 1] if start else 1
    written = 0
    for f in factors[start:]:
        sub = GridSpec(grid.x_min, grid.y_max, grid.pixel * done, *reversed(shapes[done] if done > 1 else (grid.height, grid.width)), 1)
        if cells is not None:  # parents of every level pixel that is computed again
            over = source.withColumn("fine_y", F.col("y")).withColumn("fine_x", F.col("x"))
            over = over.withColumn("y", div(F.col("y"), f // done)).withColumn("x", div(F.col("x"), f // done))
            source = _flagged(over, wanted, f, grid).where("inside").withColumn("y", F.col("fine_y")).withColumn("x", F.col("fine_x")).drop("fine_y", "fine_x", "inside")
        level = pyramid(source.drop("factor"), (f // done,), sub)[f // done].withColumn("factor", F.lit(f))
        if cells is not None:
            kept = _flagged(pixels_of(store, prop, encoding, f), wanted, f, grid).where("not inside").select(*spec.PIXELS.fieldNames())
            level = level.select(*spec.PIXELS.fieldNames()).unionByName(kept)
        session = store.writable()
        session.write(f"blocks/{prop.name}/{f}/all", place.to_blocks(level, prop.group, encoding.shard, *shapes[f]))
        if f == factors[-1]:
            session.clear(f"progress/{prop.name}")
        else:
            session.attribute(f"progress/{prop.name}", {"key": scope, "factor": f, "done": factors.index(f) + 1, "total": total})
        session.commit(f"{prop.name}: level {f}x")
        source, done, written = pixels_of(store, prop, encoding, f), f, written + 1
    if not partial:
        retried(lambda: _mark_built(store, prop))
    return written


def status(store: SnapshotStore, manifest: DataFrame) -> DataFrame:
    tokens = [(k.split("/")[1], int(v["done"])) for k, v in store.attributes().items() if k.startswith("progress/")]
    return ledger.status(
        ledger.expected_cells(manifest), store.ledger("cells", LEDGER_CELLS), store.ledger("built", "property string"),
        store.spark.createDataFrame(tokens, "property string, done int"),
    )


def structure_checks(store: SnapshotStore, properties: list[PropertySpec], grid: GridSpec, encoding: EncodingSpec, factors: tuple[int, ...], ref: int | str | None = None) -> DataFrame:
    """Every attribute of every node against the catalogue, as of a snapshot: one row each."""
    wanted, held = catalogue(properties, grid, encoding, factors), store.attributes(ref)
    items = lambda nodes: [(path, k, json.dumps(v, sort_keys=True)) for path in wanted for k, v in dict(nodes.get(path) or {}).items()]
    schema = "path string, item string, value string"
    found = checks.structure(store.spark.createDataFrame(items(wanted), schema), store.spark.createDataFrame(items(held), schema))
    return found.withColumn("check", F.concat(F.lit("structure:"), "check"))


def _content_checks(store: SnapshotStore, p: PropertySpec, manifest: DataFrame, tiles: DataFrame, grid: GridSpec, encoding: EncodingSpec, ref: int | str | None) -> list[tuple[str, bool, str]]:
    """A property's stored pixels against its sources, in the cells that are written: equal
    integers, no hole that a coarse source fills, the projection of its tiles."""
    done = ledger.done_cells(store.ledger("cells", LEDGER_CELLS, ref)).where(F.col("property") == p.name).select("cell_row", "cell_col")
    done = F.broadcast(done)  # bounded by the grid's cells
    own = place.depth_index(manifest.where(F.col("property") == p.name), p)
    names = place.tile_keys(tiles)
    within = lambda df: df.join(done, [div(F.col("y"), grid.cell_px).cast("int") == done["cell_row"], div(F.col("x"), grid.cell_px).cast("int") == done["cell_col"]], "left_semi")
    fine, coarse = own.where("not resampled_in_vrt").drop("cell_row", "cell_col"), own.where("resampled_in_vrt")
    stored = pixels_of(store, p, encoding, 1, ref)
    source = place.source_pixels(place.check_tiles(tiles, fine, grid)).groupBy(*checks.PIXEL).agg(F.max_by("raw", "ordinal").alias("raw"))
    exact = checks.byte_exact(within(source), stored, p.divisor).first()
    pixels, differing = (exact["pixels"], exact["differing"]) if exact else (0, 0)
    opened = place.resolve_coarse(coarse.join(tiles, names), grid).withColumn("value", place.decode(F.col("raw"), p.divisor))
    holes = checks.coarse_holes(place.expand_coarse(opened, grid), place.covered_pixels(fine), stored, done, grid.cell_px).count()
    sample = checks.crs_sample(tiles.join(fine.select(*names), names, "left_semi").where("header is not null"), grid.pixel)
    foreign, tiled = sample.agg(F.count_if(~(F.col("crs_ok") & F.col("pixel_ok"))), F.count("*")).first()
    return [
        (f"tiles:{p.name}", differing == 0, f"{differing} of {pixels} pixels differ"),
        (f"holes:{p.name}", holes == 0, f"{holes} pixels are empty"),
        (f"crs:{p.name}", foreign == 0, f"{foreign} of {tiled} tiles are of another projection or pixel size"),
    ]


#: The properties that make up a whole.
TEXTURE = ("sand", "silt", "clay")


def validate(
    store: SnapshotStore,
    properties: list[PropertySpec],
    grid: GridSpec,
    encoding: EncodingSpec,
    factors: tuple[int, ...],
    ref: int | str | None = None,
    manifest: DataFrame | None = None,
    tiles: DataFrame | None = None,
) -> DataFrame:
    """One row per check: the structure, every level recomputed, the sums of the texture where
    all three parts are among the properties, and, given ``manifest`` and decoded ``tiles``, the
    stored pixels against their sources. All pixels take part, none is sampled."""
    rows = []
    for p in properties:
        before = 1
        shapes = grid.level_shapes(factors)
        for f in factors:
            parent, level = pixels_of(store, p, encoding, before, ref), pixels_of(store, p, encoding, f, ref)
            bad = checks.recompute(parent, level, f // before, *shapes[f]).count()
            rows.append((f"overview:{p.name}:{f}x", bad == 0, f"{bad} pixels differ"))
            before = f
        if manifest is not None and tiles is not None:
            rows += _content_checks(store, p, manifest, tiles, grid, encoding, ref)
    by_name = {p.name: p for p in properties}
    if all(n in by_name for n in TEXTURE):
        total = checks.closure(*(pixels_of(store, by_name[n], encoding, 1, ref) for n in TEXTURE)).first()
        rows.append(("texture", total["failed"] == 0, f"{total['failed']} of {total['pixels']} sums aren't 100 %"))
    found = structure_checks(store, properties, grid, encoding, factors, ref)
    return found.unionByName(store.spark.createDataFrame(rows, spec.CHECKS))


def release(store: SnapshotStore, manifest: DataFrame, tag: str, properties: list[PropertySpec], grid: GridSpec, encoding: EncodingSpec, factors: tuple[int, ...]) -> int:
    """Tag the head if every property is complete and built, and check the structure again as it
    is read through the tag, which stays."""
    complete = ledger.complete_properties(manifest, store.ledger("cells", LEDGER_CELLS))
    gate = checks.release_gate(ledger.expected_cells(manifest), complete, store.ledger("built", "property string"))
    if blockers := gate.collect():
        raise StoreError("not releasable: " + ", ".join(sorted(f"{r['property']} {r['reason']}" for r in blockers)))
    number = store.tag(tag)
    if failed := structure_checks(store, properties, grid, encoding, factors, tag).where("not passed").count():
        raise StoreError(f"{failed} checks of the structure fail through {tag}")
    return number


def write_manifest(manifest: DataFrame, report: dict[str, object], folder: str) -> None:
    """The manifest as Parquet with its declared schema, the report as sorted JSON."""
    manifest.write.mode("overwrite").parquet(f"{folder}/manifest.parquet")
    text = json.dumps(report, sort_keys=True, indent=2)
    manifest.sparkSession.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(f"{folder}/report")


def read_manifest(spark: SparkSession, folder: str) -> DataFrame:
    try:
        return spark.read.schema(spec.MANIFEST).parquet(f"{folder}/manifest.parquet")
    except Exception as e:
        raise StoreError(f"no manifest in {folder}") from e
