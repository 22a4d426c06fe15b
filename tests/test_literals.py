from tailtrim.functions import literal_rows


def test_values_keep_their_places_and_types(spark):
    rows = [(f"t{i}", "k", i / 2, 2**40 + i, i) for i in range(12)]
    found = literal_rows(spark, rows, "a string, b string, c double, d bigint, e bigint")
    assert found.schema.simpleString() == "struct<a:string,b:string,c:double,d:bigint,e:bigint>"
    assert [tuple(row) for row in found.collect()] == rows
