"""Field masks held against the schema they select from: masks are drawn at random over the nested change schema."""

import random

import pytest
from pyspark.sql import types as T

from syncledger.functions.fields import format_mask, merge_masks, parse_mask, select_fields
from syncledger.sources.listing import nest_changes

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def nested(inv):
    return nest_changes(inv.C)


def draw(schema, rnd):
    """A mask over some fields of a struct: 0 for a whole field, a mask of its own for a nested one."""
    picked = rnd.sample(schema.fields, rnd.randint(1, len(schema.fields)))
    return {f.name: draw(f.dataType, rnd) if isinstance(f.dataType, T.StructType) and rnd.random() < 0.7 else 0
            for f in picked}


def leaves(mask, at=()):
    """The paths that a mask ends at."""
    return {p for k, v in mask.items() for p in (leaves(v, (*at, k)) if v else {(*at, k)})}


def covered(paths):
    """Without the paths that have a longer one below them."""
    return {p for p in paths if not any(q != p and q[:len(p)] == p for q in paths)}


def walk(schema, mask):
    """What a mask leaves of a schema, field by field."""
    kept = []
    for name, sub in mask.items():
        kind = schema[name].dataType
        kept.append((name, walk(kind, sub) if sub else kind))
    return kept


def shape(schema):
    return [(f.name, shape(f.dataType) if isinstance(f.dataType, T.StructType) else f.dataType) for f in schema.fields]


def flat(tree):
    return [(n, flat(k) if isinstance(k, list) else shape(k) if isinstance(k, T.StructType) else k) for n, k in tree]


def masks(nested, n):
    rnd = random.Random(n)
    return [draw(nested.schema, rnd) for _ in range(n)]


def test_text_and_mask_are_one(nested):
    for mask in masks(nested, 60):
        text = format_mask(mask)
        assert parse_mask(text) == mask
        assert parse_mask("  " + text.replace(",", " ,\n ").replace("(", " ( ")) == mask
        # the same mask with a path for every leaf
        assert leaves(parse_mask(",".join("/".join(p) for p in leaves(mask)))) == leaves(mask)


def test_merging_is_a_union_of_leaves(nested):
    drawn = masks(nested, 40)
    for a, b in zip(drawn[::2], drawn[1::2], strict=True):
        both = merge_masks(a, b)
        assert leaves(both) == leaves(merge_masks(b, a)) == covered(leaves(a) | leaves(b))
        assert merge_masks(a, a) == a and merge_masks(both, a) == both
        assert list(both)[:len(a)] == list(a)


def test_selecting_leaves_what_the_mask_names(nested):
    drawn = masks(nested, 24)
    for a, b in zip(drawn[::2], drawn[1::2], strict=True):
        assert shape(select_fields(nested, format_mask(a)).schema) == flat(walk(nested.schema, a))
        assert shape(select_fields(nested, format_mask(a), format_mask(b)).schema) == \
            flat(walk(nested.schema, merge_masks(a, b)))


def test_values_stay_with_their_fields(nested):
    one = nested.filter("file.name IS NOT NULL").orderBy("seq").first().asDict(recursive=True)
    for mask in masks(nested, 8):
        got = select_fields(nested, format_mask(mask)).limit(10**6).filter(f"{'seq' if 'seq' in mask else 'true'} = "
                                                                          f"{one['seq'] if 'seq' in mask else 'true'}")
        if "seq" in mask:
            row = got.first().asDict(recursive=True)
            for path in leaves(mask):
                a, b = row, one
                for key in path:
                    a, b = a[key], b[key]
                assert a == b


def test_every_field_no_field_and_unknown_fields(nested):
    assert select_fields(nested, "").columns == nested.columns
    assert parse_mask(" \t\n") == {}
    assert set(select_fields(nested, "*").columns) == set(nested.columns)
    assert shape(select_fields(nested, "file/*").schema) == [("file", shape(nested.schema["file"].dataType))]
    assert select_fields(nested, "seq,nothing,file/nothing/at/all").columns == ["seq", "file"]


def test_arrays_of_structs(spark):
    rows = spark.createDataFrame([(1, [(2, "x"), (3, "y")])], "seq int, files array<struct<id:int,name:string>>")
    out = select_fields(rows, "files/name")
    assert [r["name"] for r in out.first()["files"]] == ["x", "y"]
    assert out.schema["files"].dataType.elementType.fieldNames() == ["name"]
