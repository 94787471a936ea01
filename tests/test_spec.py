import json

import pytest

from gridloom import spec
from gridloom.functions import metadata
from gridloom.spec import DepthInterval, EncodingSpec, GridSpec, SpecError


def test_layers_and_groups():
    assert len(list(spec.layers())) == 61
    assert [p.name for p in spec.included_properties() if p.group == spec.PROFILE] == ["ocs"]
    assert spec.PROPERTIES["ocs"].ndim == 2 and spec.PROPERTIES["clay"].ndim == 3


def test_grid_values():
    g = spec.GRID
    assert (g.cell_rows, g.cell_cols, g.cell_rows * g.cell_cols) == (33, 89, 2937)
    assert g.x_max == 20_012_500 and g.y_min == -6_249_250
    assert g.geotransform == "-20037500 250 0 8600750 0 -250"


def test_level_shapes_are_chained_floors():
    want = {2: (29700, 80100), 4: (14850, 40050), 8: (7425, 20025), 16: (3712, 10012), 32: (1856, 5006), 64: (928, 2503), 128: (464, 1251), 256: (232, 625)}
    assert spec.GRID.level_shapes(spec.FACTORS) == want
    assert spec.GRID.level_shapes((4, 16)) == {4: (14850, 40050), 16: (3712, 10012)}
    with pytest.raises(SpecError):
        spec.GRID.level_shapes((4, 6))


@pytest.mark.parametrize(
    "make",
    [
        lambda: GridSpec(0, 0, 250, 100, 90, 45),
        lambda: DepthInterval(5, 5),
        lambda: EncodingSpec(chunk=50, shard=440),
        lambda: spec.check_consistency(encoding=EncodingSpec(chunk=50, shard=700)),
        lambda: spec.parse_properties("clay, mud"),
        lambda: spec.PROPERTIES["clay"].depth_index("7_9"),
    ],
)
def test_refusals(make):
    with pytest.raises(SpecError):
        make()


def test_lists_labels_and_json():
    spec.check_consistency()
    assert [p.name for p in spec.parse_properties(" clay,sand , ")] == ["clay", "sand"]
    assert len(spec.parse_properties(None)) == 11
    clay = spec.PROPERTIES["clay"]
    assert clay.layer_dir(clay.depths[0]) == "clay_0-5cm_mean" and clay.depth_index("30-60cm") == clay.depth_index("30_60") == 3
    assert EncodingSpec().chunks(2) == (50, 50) and EncodingSpec().shards(3, 6) == (6, 450, 450)
    assert json.loads(spec.as_json())["grid"]["width"] == 160_200


def test_metadata():
    attrs = metadata.property_attributes(spec.PROPERTIES["phh2o"], 4)
    assert attrs["units"] == "pH" and attrs["derived_from"] == "2x" and "scale_factor" not in attrs and "_FillValue" not in attrs
    assert [m["factor"] for m in metadata.multiscales()] == [1, *spec.FACTORS]
    assert metadata.multiscales((4, 16))[2]["scale"] == 4
    assert metadata.geo_attributes(10, 20, 500.0)["spatial:bbox"][2] == spec.GRID.x_min + 10_000
    a = metadata.scope_key("clay", (2, 4), [(1, 2), (0, 1)])
    assert a == metadata.scope_key("clay", (2, 4), [(0, 1), (1, 2)]) != metadata.scope_key("clay", (2,), [(0, 1), (1, 2)])
    assert len(a) == 16
