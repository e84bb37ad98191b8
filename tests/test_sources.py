"""S1-S10 readers on hand-made files."""

import pytest
from pyspark.sql import functions as F

from tessera.sources import delimited
from tessera.session import shared_path, shared_root


def _write_bytes(path, data: bytes):
    path.write_bytes(data)
    return str(path)


def test_session_has_shared_folder(spark):
    root = shared_root(spark)
    assert root
    assert shared_path(spark, "x").startswith(root)


def test_parse_names_tolerant(spark, tmp_path):
    p = _write_bytes(tmp_path / "names.txt",
                     b"1\tA\n2\t B \nx\tC\n3\n4\tD\tE\n5\tbad\xffbyte\n")
    rows = delimited.parse_names(delimited.read_lines(spark, p)).orderBy("id").collect()
    assert [(r.id, r.name) for r in rows] == [(1, "A"), (2, "B"), (5, "bad�byte")]


def test_parse_alias_blank_first_field_and_last_wins(spark, tmp_path):
    p = _write_bytes(tmp_path / "alias.txt", b"\t5\n1\t2\n2\t3\n7\t8\n7\t9\n")
    rows = delimited.parse_alias(delimited.read_lines(spark, p)).orderBy("bad_id").collect()
    assert [(r.bad_id, r.good_id) for r in rows] == [(1, 2), (2, 3), (7, 9)]


def test_alias_resolution_is_one_hop(spark):
    from tessera.operators.relational import resolve_aliases

    ratings = spark.createDataFrame([(1, 1), (1, 2), (1, 4)], "user bigint, item bigint")
    alias = spark.createDataFrame([(1, 2), (2, 3)], "bad_id bigint, good_id bigint")
    got = sorted(r.item for r in resolve_aliases(ratings, alias).collect())
    assert got == [2, 3, 4]


def test_parse_ratings_strict_fails_on_bad_int(spark, tmp_path):
    good = _write_bytes(tmp_path / "good.txt", b"1 2 3 extra\n4 5 6\n")
    rows = delimited.parse_ratings(delimited.read_lines(spark, good)).orderBy("user").collect()
    assert [tuple(r) for r in rows] == [(1, 2, 3), (4, 5, 6)]
    bad = _write_bytes(tmp_path / "bad.txt", b"1 2 x\n")
    import pytest

    with pytest.raises(Exception):
        delimited.parse_ratings(delimited.read_lines(spark, bad)).collect()


def test_match_names_drops_undecodable_bytes(spark, tmp_path):
    p = _write_bytes(tmp_path / "n.txt", b"10\tNa\xffs\n11\t Eminem \n12\tother\n13\tx\ty\n")
    rows = delimited.match_names(delimited.read_lines(spark, p), ["nas", "eminem"]).orderBy("id").collect()
    assert [(r.id, r.name) for r in rows] == [("10", "Nas"), ("11", " Eminem")]


def test_stopwords_distinct(spark, tmp_path):
    p = _write_bytes(tmp_path / "s.txt", b"the\nand\nthe\n")
    assert sorted(r.word for r in delimited.read_stopwords(spark, p).collect()) == ["and", "the"]


def test_csv_multiline_and_null_drop(spark, tmp_path):
    p = tmp_path / "plots.csv"
    p.write_text('Title,Genre,Plot\n"a","x","line one\nline two with ""quote"""\n'
                 '"b",,"p"\n"c","","q"\n"d","  ","r"\n')
    df = delimited.read_csv_multiline(spark, str(p))
    rows = {r.Title: r for r in df.collect()}
    assert rows["a"].Plot == 'line one\nline two with "quote"'
    kept = sorted(r.Title for r in df.na.drop().collect())
    assert kept == ["a", "d"]


def test_csv_inferred_types(spark, tmp_path):
    p = tmp_path / "t.csv"
    p.write_text("id,Name,fare\n1,Ann,7.25\n2,Bob,8.5\n")
    df = delimited.read_csv_inferred(spark, str(p))
    assert dict(df.dtypes) == {"id": "int", "Name": "string", "fare": "double"}
    df.createOrReplaceTempView("passengers_t")
    assert [r.Name for r in spark.sql("SELECT Name FROM passengers_t ORDER BY id").collect()] == ["Ann", "Bob"]


def test_driver_export_is_bounded(spark):
    df = spark.range(100).select(F.col("id").alias("x"))
    pdf = df.limit(10).toPandas()
    assert len(pdf) == 10
    assert sum(1 for _ in df.select("x").toLocalIterator()) == 100


def test_sizing_conf_scales_with_input():
    from tessera.session import sizing_conf

    small = sizing_conf(10 * 2**20, 8)
    assert small["spark.sql.shuffle.partitions"] == "16"
    big = sizing_conf(100 * 2**40, 8000)
    assert int(big["spark.sql.shuffle.partitions"]) == 100 * 2**40 // (256 * 2**20)


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_strict_integers_fail_whatever_the_ansi_setting(spark, ansi):
    lines = spark.createDataFrame([("x 2 3",), ("4 5",)], "value string")
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        good = delimited.parse_ratings(spark.createDataFrame([("1 2 3 4",)], "value string")).first()
        assert tuple(good) == (1, 2, 3)
        for value in ("x 2 3", "4 5", ""):
            with pytest.raises(Exception, match="not an integer"):
                delimited.parse_ratings(lines.limit(0).union(
                    spark.createDataFrame([(value,)], "value string"))).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)
