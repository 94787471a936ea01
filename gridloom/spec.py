"""The frozen specification: grid, depths, encoding, properties, table schemas."""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import asdict, dataclass, field

from pyspark.sql import types as T


class SpecError(ValueError):
    """A specification that contradicts itself."""


@dataclass(frozen=True)
class GridSpec:
    """A north-up lattice of square pixels, divided into square cells."""

    x_min: float
    y_max: float
    pixel: float
    width: int
    height: int
    cell_px: int

    def __post_init__(self) -> None:
        if self.pixel <= 0 or self.width % self.cell_px or self.height % self.cell_px:
            raise SpecError("the grid isn't a whole number of cells")

    @property
    def cell_rows(self) -> int:
        return self.height // self.cell_px

    @property
    def cell_cols(self) -> int:
        return self.width // self.cell_px

    @property
    def x_max(self) -> float:
        return self.x_min + self.width * self.pixel

    @property
    def y_min(self) -> float:
        return self.y_max - self.height * self.pixel

    @property
    def geotransform(self) -> str:
        return " ".join(f"{v:g}" if v != int(v) else str(int(v)) for v in (self.x_min, self.pixel, 0, self.y_max, 0, -self.pixel))

    def level_shapes(self, factors: tuple[int, ...]) -> dict[int, tuple[int, int]]:
        """(height, width) of each level: floors chained from level to level, each level being
        reduced from the one before by the ratio of their factors."""
        shapes, h, w, before = {}, self.height, self.width, 1
        for f in factors:
            if f <= before or f % before:
                raise SpecError(f"level {f} isn't a multiple of level {before}")
            h, w, before = h // (f // before), w // (f // before), f
            shapes[f] = (h, w)
        return shapes


@dataclass(frozen=True)
class DepthInterval:
    top_cm: int
    bottom_cm: int

    def __post_init__(self) -> None:
        if not 0 <= self.top_cm < self.bottom_cm:
            raise SpecError("a depth interval must go down from its top")

    @property
    def label(self) -> str:
        return f"{self.top_cm}_{self.bottom_cm}"

    @property
    def token(self) -> str:
        return f"{self.top_cm}-{self.bottom_cm}cm"


@dataclass(frozen=True)
class EncodingSpec:
    """How arrays are stored: chunks inside shards, compressed floats with NaN for nothing."""

    chunk: int = 50
    shard: int = 450
    codec: str = "zstd"
    level: int = 3

    def __post_init__(self) -> None:
        if self.shard % self.chunk:
            raise SpecError("a shard must be a whole number of chunks")

    def chunks(self, ndim: int) -> tuple[int, ...]:
        return (1, self.chunk, self.chunk)[3 - ndim :]

    def shards(self, ndim: int, depths: int = 1) -> tuple[int, ...]:
        return (depths, self.shard, self.shard)[3 - ndim :]


@dataclass(frozen=True)
class PropertySpec:
    name: str
    group: str
    units: str
    mapped_units: str
    divisor: int
    tile_px: int
    rows_per_strip: int
    run: str
    transformation: str = "none"
    depths: tuple[DepthInterval, ...] = field(default=())
    status: str = "included"

    @property
    def ndim(self) -> int:
        return 3 if len(self.depths) > 1 else 2

    @property
    def array_path(self) -> str:
        return f"{self.group}/{self.name}"

    def layer_dir(self, depth: DepthInterval, statistic: str = "mean") -> str:
        return f"{self.name}_{depth.token}_{statistic}"

    def layer_url(self, base: str, depth: DepthInterval, statistic: str = "mean") -> str:
        return f"{base.rstrip('/')}/{self.name}/{self.layer_dir(depth, statistic)}"

    def depth_index(self, label: str) -> int:
        """The index of a depth label; an unknown depth is an error, never null."""
        for i, d in enumerate(self.depths):
            if label in (d.label, d.token):
                return i
        raise SpecError(f"{self.name} has no depth {label}")


# Fixed values of the published product.
GRID = GridSpec(x_min=-20_037_500.0, y_max=8_600_750.0, pixel=250.0, width=160_200, height=59_400, cell_px=1800)
DEPTHS = tuple(DepthInterval(a, b) for a, b in ((0, 5), (5, 15), (15, 30), (30, 60), (60, 100), (100, 200)))
WHOLE_PROFILE = (DepthInterval(0, 30),)
ENCODING = EncodingSpec()
FACTORS = (2, 4, 8, 16, 32, 64, 128, 256)
NODATA = -32768
PROJ4 = "+proj=igh +lon_0=0 +x_0=0 +y_0=0 +ellps=WGS84 +units=m"
EXPECTED_METADATA = {"Code_version": "v2.0.0", "WoSIS_version": "Data stream 7"}
SOURCE_VERSION, DATASET_VERSION = "2.0.0", "0.1.0"
SOIL, PROFILE = "soil_properties", "profile_properties"

# Name, group, units, mapped units, divisor, tile pixels, rows per strip, run, transformation, depths.
PROPERTIES = {
    p.name: p
    for p in (
        PropertySpec("bdod", SOIL, "kg/dm3", "cg/cm3", 100, 600, 6, "RUN03", "none", DEPTHS),
        PropertySpec("cec", SOIL, "cmol(c)/kg", "mmol(c)/kg", 10, 450, 9, "RUN06", "none", DEPTHS),
        PropertySpec("cfvo", SOIL, "cm3/100cm3 (vol%)", "cm3/dm3", 10, 450, 9, "RUN06", "none", DEPTHS),
        PropertySpec("clay", SOIL, "g/100g (mass%)", "g/kg", 10, 450, 9, "RUN10", "alr", DEPTHS),
        PropertySpec("nitrogen", SOIL, "g/kg", "cg/kg", 100, 450, 9, "RUN05", "none", DEPTHS),
        PropertySpec("ocd", SOIL, "kg/m3", "hg/m3", 10, 450, 9, "RUN03", "none", DEPTHS),
        PropertySpec("phh2o", SOIL, "pH", "pH x 10", 10, 600, 6, "RUN05", "none", DEPTHS),
        PropertySpec("sand", SOIL, "g/100g (mass%)", "g/kg", 10, 450, 9, "RUN10", "alr", DEPTHS),
        PropertySpec("silt", SOIL, "g/100g (mass%)", "g/kg", 10, 450, 9, "RUN10", "alr", DEPTHS),
        PropertySpec("soc", SOIL, "g/kg", "dg/kg", 10, 450, 9, "RUN18", "none", DEPTHS),
        PropertySpec("ocs", PROFILE, "kg/m2", "t/ha", 10, 450, 9, "RUN03", "none", WHOLE_PROFILE),
    )
}


def included_properties(properties: dict[str, PropertySpec] = PROPERTIES) -> list[PropertySpec]:
    return [p for p in properties.values() if p.status == "included"]


def layers(properties: dict[str, PropertySpec] = PROPERTIES) -> Iterator[tuple[PropertySpec, DepthInterval]]:
    """Every property with every depth: 61 layers."""
    return ((p, d) for p in included_properties(properties) for d in p.depths)


def parse_properties(text: str | None, properties: dict[str, PropertySpec] = PROPERTIES) -> list[PropertySpec]:
    """A comma-separated list of names; none is all, an unknown one is an error."""
    if text is None or not text.strip():
        return included_properties(properties)
    names = [n.strip() for n in text.split(",") if n.strip()]
    if unknown := [n for n in names if n not in properties]:
        raise SpecError(f"unknown properties: {', '.join(unknown)}")
    return [properties[n] for n in names]


def check_consistency(grid: GridSpec = GRID, encoding: EncodingSpec = ENCODING, properties: dict[str, PropertySpec] = PROPERTIES) -> None:
    """Cells must be whole shards and whole tiles, so that one cell is written by one worker."""
    if grid.cell_px % encoding.shard:
        raise SpecError("a cell must be a whole number of shards")
    for p in properties.values():
        if grid.cell_px % p.tile_px:
            raise SpecError(f"{p.name}: a cell must be a whole number of tiles")
        if p.divisor <= 0 or not p.depths:
            raise SpecError(f"{p.name}: a divisor and depths are needed")
        if any(a.bottom_cm != b.top_cm for a, b in zip(p.depths, p.depths[1:])):
            raise SpecError(f"{p.name}: depths must follow each other")


def as_json(grid: GridSpec = GRID, encoding: EncodingSpec = ENCODING, properties: dict[str, PropertySpec] = PROPERTIES) -> str:
    whole = {"grid": asdict(grid), "encoding": asdict(encoding), "properties": {k: asdict(v) for k, v in properties.items()}}
    return json.dumps(whole, sort_keys=True, indent=2)


_TYPES = {
    "string": T.StringType(), "int": T.IntegerType(), "bigint": T.LongType(), "smallint": T.ShortType(), "float": T.FloatType(), "double": T.DoubleType(),
    "boolean": T.BooleanType(), "array<bigint>": T.ArrayType(T.LongType()), "array<float>": T.ArrayType(T.FloatType()),
}


def _schema(text: str) -> T.StructType:
    """A declared schema; parsed here since a specification needs no session."""
    return T.StructType([T.StructField(name.strip("`"), _TYPES[kind]) for name, kind in (c.split() for c in text.split(","))])


MANIFEST = _schema(
    "property string, depth string, cell string, subtile string, url string, relpath string, width int, height int, x_off int, y_off int, "
    "cell_row smallint, cell_col smallint, is_full boolean, rows_per_strip int, resampled_in_vrt boolean, size bigint, etag string, "
    "modified string, ordinal bigint"
)
PIXELS = _schema("property string, factor int, depth_idx smallint, y int, x int, value float")
BLOCKS = _schema(
    "`group` string, property string, factor int, depth_idx smallint, by int, bx int, h int, w int, n_valid int, payload array<float>"
)
TILE_HEADER = _schema(
    "width int, height int, rows_per_strip int, strip_offsets array<bigint>, strip_byte_counts array<bigint>, tie_x double, tie_y double, "
    "px double, py double, nodata int, crs string, big_endian boolean, contiguous boolean, data_start bigint, data_end bigint"
)
CHECKS = _schema("check string, passed boolean, message string")
