"""Record types of whole sources, and nested references."""

import json

import pytest
from pyspark.sql import functions as F

from quarry.functions.nested import nested, split_path
from quarry.operators.features import apply_transforms, nested_columns
from quarry.plans.api_etl import APIJob
from quarry.sources.records import RecordError, page_records, typed_records, unreadable_pages

PAGES = {1: [{"id": 1, "v": 1}], 2: [{"id": 2, "v": 2.5, "extra": "x"}, {"id": 3, "v": "text", "extra": "y"}]}


def fetcher():
    pages = {k: json.dumps({"results": v}) for k, v in PAGES.items()}
    return lambda page, offset, size: pages.get(page, '{"results": []}')


CONFIG = {"pagination": {"type": "page", "size": 1, "results_path": "results", "total_pages": 2}}


@pytest.mark.parametrize("strict", [True, False])
def test_every_field_and_value_of_an_api_survives(spark, strict):
    job = APIJob(spark, {**CONFIG, "strict": strict})
    rows = sorted(tuple(r) for r in job.extract_from_api(fetcher()).select("id", "v", "extra").collect())
    assert rows == [(1, "1", None), (2, "2.5", "x"), (3, "text", "y")]
    assert job.stats["page_errors"] == 0 and job.stats["unfit_values"] == {}


def test_given_types_count_or_raise(spark):
    job = APIJob(spark, CONFIG)
    got = sorted(tuple(r) for r in job.extract_from_api(fetcher(), "id bigint, v double").collect())
    assert got == [(1, 1.0), (2, 2.5), (3, None)] and job.stats["unfit_values"] == {"v": 1}
    with pytest.raises(RecordError, match="v \\(1\\)"):
        APIJob(spark, {**CONFIG, "strict": True}).extract_from_api(fetcher(), "id bigint, v double")


def test_unreadable_pages(spark):
    def broken(page, offset, size):
        return '{"results": [{"id": 1}' if page == 1 else '{"results": [{"id": 2}]}'

    job = APIJob(spark, CONFIG)
    assert [r.id for r in job.extract_from_api(broken).collect()] == [2] and job.stats["page_errors"] == 1
    with pytest.raises(RecordError):
        APIJob(spark, {**CONFIG, "strict": True}).extract_from_api(broken)


def records(spark, *bodies, path=""):
    return page_records(spark.createDataFrame([(b,) for b in bodies], "body string"), path)


def test_types_widen(spark):
    out = typed_records(records(spark, '[{"n":1,"big":12345678901234567890,"f":1,"null":null,"em":{},"A":1,"a":2,"l":[1]}]',
                                '[{"n":2,"f":0.5,"s":{"x":1}},{"s":{"y":[{"z":1},{"z":"q"}]},"l":["b",{"c":1}]}]', "[]", "{}"))
    kinds = dict(out.rows.dtypes)
    assert kinds == {"A": "bigint", "a_2": "bigint", "big": "decimal(20,0)", "em": "string", "f": "double", "l": "array<string>",
                     "n": "bigint", "null": "string", "s": "struct<x:bigint,y:array<struct<z:string>>>"}
    rows = out.rows.collect()
    assert len(rows) == 4 and out.unfit == {}
    assert [r for r in rows if r.l and len(r.l) == 2][0].l == ["b", '{"c":1}'] and rows[0].big == 12345678901234567890
    assert [[z.z for z in r.s.y] for r in rows if r.s and r.s.y] == [["1", "q"]]


def test_paths_scalars_and_nothing(spark):
    got = typed_records(records(spark, '{"a":{"b":[1,2]}}', '{"a":{"b":7}}', '{"a":{"b":null}}', '{"a":[]}', '{"c":1}', None, "", "no", path="a.b"))
    assert sorted(r[0] for r in got.rows.collect()) == [1, 2, 7]
    none = typed_records(records(spark, "[]"))
    assert none.rows.count() == 0
    pages = spark.createDataFrame([("[]",), ("no",), (None,), (" ",), ('{"a":1,"a":2}',)], "body string")
    assert pages.agg(unreadable_pages()).first()[0] == 2
    mixed = typed_records(records(spark, '[{"x":1},5,null,[2]]'), "x int")
    assert mixed.unfit == {"x": 2} and [r.x for r in mixed.rows.collect()] == [1, None, None, None]


def test_nested_paths(spark):
    assert split_path("a.`b.c`.*.d") == ["a", "b.c", "*", "d"] and split_path("x") == ["x"]
    df = spark.sql("""SELECT named_struct('common', 'Peru', 'official', named_struct('es', 'R. del Perú')) AS name,
        map('PEN', named_struct('name', 'sol')) AS currencies, array(named_struct('k', 1), named_struct('k', 2)) AS list,
        parse_json('{"m":{"a":{"n":1},"b":{"n":"x"}},"l":[{"n":5}]}') AS v, 9 AS `name.common`""")
    row = df.select(nested(df, "name.official.es").alias("a"), nested(df, "currencies.*.name").alias("b"), nested(df, "currencies.USD.name").alias("c"),
                    nested(df, "list.*.k").alias("d"), nested(df, "list.5.k").alias("e"), nested(df, "v.m.*.n", "int").alias("f"),
                    nested(df, "v.l.*.n", "string").alias("g"), nested(df, "v.none.x", "int").alias("h"), nested(df, "none.x").alias("i"),
                    nested(df, "name.common").alias("j"), nested(df, "list.k").alias("k"), nested(df, "NAME.COMMON.x").alias("l")).first()
    assert tuple(row) == ("R. del Perú", ["sol"], None, [1, 2], None, [1, None], ["5"], None, None, 9, None, None)
    nulls = df.select(*[F.when(F.lit(False), F.col(f"`{c}`")).alias(c) for c in df.columns])
    assert tuple(nulls.select(nested(nulls, "name.official.es"), nested(nulls, "currencies.*.name"), nested(nulls, "v.m.*.n", "int")).first()) == (None,) * 3


def test_dotted_names_in_transforms(spark):
    df = spark.sql("SELECT named_struct('common', 'PERU') AS name, '5' AS area")
    spec = {"lower": ["name.common"], "rename": {"name.common": "country_name"}, "dtype": {"area": "int64"}}
    out = apply_transforms(nested_columns(df, [n for part in spec.values() for n in part]), spec)
    assert out.select("country_name", "area").first() == ("peru", 5) and "name" in out.columns
