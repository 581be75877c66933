import csv
import io
import random

import pytest

from comptoir.sources import files, records, sinks
from comptoir.sources.errors import CorruptInputError, EmptyInputError, MissingPathError, UnsupportedFormatError

SAMPLE = """date,produit,categorie,prix,quantite,ville,source
2024-03-05,Tasse,Maison,5.0,6,Lille,web
2024-03-09,Lampe,Maison,30.0,1,Nantes,magasin
2024-04-01,Sac,Mode,10.0,6,Lille,web
"""


@pytest.fixture
def write(tmp_path):
    def put(name, text, encoding="utf-8"):
        path = tmp_path / name
        path.write_bytes(text if isinstance(text, bytes) else text.encode(encoding))
        return str(path)
    return put


def test_sample_types(spark, write):
    df = files.load_data(spark, write("ventes.csv", SAMPLE))
    assert dict(df.dtypes) == {
        "date": "string", "produit": "string", "categorie": "string", "prix": "double", "quantite": "bigint",
        "ville": "string", "source": "string"}
    assert df.count() == 3


def test_minimal_upload(spark, write):
    df = files.load_csv(spark, write("petit.csv", "col1,col2\n1,2"))
    assert [tuple(r) for r in df.collect()] == [(1, 2)]


@pytest.mark.parametrize("delimiter", [",", ";", "\t", "|"])
def test_delimiters(spark, write, delimiter):
    path = write("d.csv", SAMPLE.replace(",", delimiter))
    assert files.profile_files(spark, path).first().delimiter == delimiter
    assert len(files.load_csv(spark, path).columns) == 7


def test_delimiter_in_quotes(spark, write):
    path = write("q.csv", 'a;b\n"x, y, z";1\n"p, q, r";2\n')
    assert [tuple(r) for r in files.load_csv(spark, path).collect()] == [("x, y, z", 1), ("p, q, r", 2)]


@pytest.mark.parametrize("encoding, found", [("utf-8", "UTF-8"), ("utf-8-sig", "UTF-8"), ("latin-1", "ISO-8859-1"), ("cp1252", "cp1252")])
def test_encodings(spark, write, encoding, found):
    text = "é;b\nà;1\n" if encoding == "latin-1" else "é;b\nà €;1\n"
    path = write("e n.csv", text, encoding)
    assert files.profile_files(spark, path).first().encoding == found
    df = files.load_csv(spark, path)
    assert df.columns == ["é", "b"] and df.first()[0] == text.split("\n")[1].split(";")[0]
    given = files.load_csv(spark, path, encoding=encoding, delimiter=";")
    assert given.first()[0] == df.first()[0]


def test_missing_tokens(spark, write):
    path = write("na.csv", "a,b,c,d\n1,NA,x,True\nN/A,2.5,null,False\nNaN,,y,\n")
    rows = [tuple(r) for r in files.load_csv(spark, path).collect()]
    assert rows == [(1, None, "x", True), (None, 2.5, None, False), (None, None, "y", None)]


def test_headers(spark, write):
    assert files.load_csv(spark, write("h.csv", "a,a,,a\n1,2,3,4\n")).columns == ["a", "a.1", "Unnamed: 2", "a.2"]


def test_uneven_rows(spark, write):
    path = write("u.csv", "a,b\n1,2\n3\n4,5,6,7\n")
    with pytest.raises(CorruptInputError):
        files.load_csv(spark, path)
    assert [tuple(r) for r in files.load_csv(spark, path, on_bad="skip").collect()] == [(1, 2), (3, None)]
    assert [r["_extra"] for r in files.rejected_rows(spark, path).collect()] == ["6"]
    with pytest.raises(Exception, match="more fields"):
        files.load_csv(spark, path, schema="a int, b int").collect()
    assert files.load_csv(spark, path, schema="a int, b int", on_bad="skip").count() == 2


def test_refused_inputs(spark, write, tmp_path):
    with pytest.raises(MissingPathError):
        files.load_data(spark, str(tmp_path / "absent.csv"))
    with pytest.raises(MissingPathError):
        files.load_data(spark, str(tmp_path / "absent.parquet"))
    for name in ("x.xlsx", "x.txt"):
        with pytest.raises(UnsupportedFormatError):
            files.load_data(spark, write(name, "a,b\n1,2"))
    with pytest.raises(EmptyInputError):
        files.load_csv(spark, write("empty.csv", ""))
    with pytest.raises(EmptyInputError):
        files.load_csv(spark, write("header.csv", "a,b\n"))


def test_several_files(spark, write, tmp_path):
    write("a.csv", "x;y\n1;é\n", "latin-1")
    write("b.csv", "y,x\nb,2\n")
    write("c.csv", "x;z\n3;9\n")
    got = files.load_csv(spark, str(tmp_path / "*.csv")).select("x", "y", "z").orderBy("x").collect()
    assert [tuple(r) for r in got] == [(1, "é", None), (2, "b", None), (3, None, 9)]


def test_file_splits_give_the_same_rows(spark, write):
    path = write("many.csv", "a,b\n" + "".join(f"{i},v{i}\n" for i in range(5000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        df = files.load_csv(spark, path)
        assert df.rdd.getNumPartitions() > 1 and df.count() == 5000 and df.agg({"a": "sum"}).first()[0] == sum(range(5000))
        assert files.profile_files(spark, path).first().lines == 5001
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


@pytest.mark.parametrize("kind", ["parquet", "csv", "json"])
def test_bundles(spark, tmp_path, kind):
    tables = {"Données": spark.createDataFrame([(1, "é")], "a int, b string"), "vide": spark.createDataFrame([], "a int")}
    for path, table in zip(sinks.write_tables(tables, str(tmp_path), kind), tables.values()):
        back = spark.read.schema(table.schema).option("header", True).format(kind).load(path)
        assert back.collect() == table.collect()


def test_union(spark):
    a, b = spark.createDataFrame([(1, 2)], "x int, y int"), spark.createDataFrame([(3, 4)], "y int, z int")
    assert sorted(map(tuple, files.union_all([a, b]).collect()), key=str) == [(1, 2, None), (None, 3, 4)]


def test_line_breaks_inside_quotes(spark, write):
    path = write("m.csv", 'a,b\n1,"x\ny"\n2,z\n')
    for settings in ({}, {"encoding": "utf-8", "delimiter": ","}):
        assert [tuple(r) for r in files.load_csv(spark, path, **settings).orderBy("a").collect()] == [(1, "x\ny"), (2, "z")]


def test_stray_quotes_keep_the_split_read(spark, write):
    stray = write("s.csv", 'a,b\n1,5" pipe\n2,"x, ""y"""\n3,z\n')
    assert not files.profile_files(spark, stray).first().multiline
    assert [tuple(r) for r in files.load_csv(spark, stray).orderBy("a").collect()] == [(1, '5" pipe'), (2, 'x, "y"'), (3, "z")]
    for text in ('a,b\n5" pipe,"x\ny"\n', 'a,b\n"x\ny",1\n', 'a,b\n1,"""x\ny"\n'):
        assert files.profile_files(spark, write("q.csv", text)).first().multiline
    assert files.profile_files(spark, write("t.csv", 'a~b\n1~"x\ny"\n'), "~").first().multiline


def test_identifiers_keep_every_digit(spark, write):
    path = write("i.csv", "a,b,c\n1234567890123456789,12345678901234567890,1\n1234567890123456788,12345678901234567891," + "9" * 40 + "\n")
    df = files.load_csv(spark, path)
    assert [t for _, t in df.dtypes] == ["bigint", "decimal(38,0)", "string"]
    assert df.select("a").distinct().count() == 2 and df.select("b").distinct().count() == 2


def test_columns_go_by_name_when_everything_is_given(spark, write):
    paths = [write("h1.csv", "a,b\n1,2\n"), write("h2.csv", "b,a\n20,10\n")]
    rows = files.load_csv(spark, paths, encoding="utf-8", delimiter=",").select("a", "b").orderBy("a").collect()
    assert [tuple(r) for r in rows] == [(1, 2), (10, 20)]


def test_utf16_by_its_mark(spark, write):
    path = write("u.csv", "a;é\n1;ü\n", "utf-16")
    df = files.load_csv(spark, path)
    assert df.columns == ["a", "é"] and tuple(df.first()) == (1, "ü")


def test_nan_is_missing_on_entry(spark, tmp_path):
    spark.createDataFrame([(float("nan"),), (1.0,)], "v double").write.parquet(str(tmp_path / "n.parquet"))
    assert files.load_data(spark, str(tmp_path / "n.parquet")).where("v IS NULL").count() == 1


@pytest.mark.parametrize("split,encoding", [(16, "utf-8"), (300, "latin-1")])
def test_breaks_in_quotes_over_many_splits(spark, write, split, encoding):
    rng = random.Random(split)
    parts = ['x', ' y ', '\n', '\n\n', '"', '",', ',"', 'é', ';', '', 'a long piece of text']
    rows = [(str(i), "".join(rng.choice(parts) for _ in range(rng.randrange(9))), rng.choice(["plain", "", 'in"ch', "two\nlines"])) for i in range(60)]
    text = io.StringIO()
    csv.writer(text, lineterminator="\n").writerows([("id", "note", "la\nbel"), *rows])
    path = write("b.csv", text.getvalue(), encoding)
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    spark.conf.set("spark.sql.files.openCostInBytes", 1)
    try:
        assert files.profile_files(spark, path).first().multiline
        df = files.load_csv(spark, path, na_tokens=[])
        got = sorted((str(r[0]), r[1] or "", r[2] or "") for r in df.collect())
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert df.columns == ["id", "note", "la\nbel"] and got == sorted(rows)


def test_breaks_in_quotes_are_cut_by_many_tasks(spark, write):
    path = write("t.csv", 'a,b\n' + "".join(f'{i},"v{i}\nw"\n' for i in range(4000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        lines = records._lines(spark, [path])
        states = records._states(lines, records.Quotes(",", "UTF-8"))
        assert lines.rdd.getNumPartitions() > 8 and states.count() > 8
        df = files.load_csv(spark, path)
        assert df.rdd.getNumPartitions() > 8
        assert df.agg({"a": "sum"}).first()[0] == sum(range(4000)) and df.where("b LIKE '%\nw'").count() == 4000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_line_ends_are_told_like_a_reader_of_single_characters():
    def plain(line, inside, at_start=True):
        quoted = inside
        i = 0
        while i < len(line):
            c = line[i]
            if quoted:
                if c == '"':
                    if line[i + 1:i + 2] == '"':
                        i += 1
                    else:
                        quoted = False
                        while i + 1 < len(line) and line[i + 1] != ",":
                            i += 1
                at_start = False
            elif c == '"' and at_start:
                quoted, at_start = True, False
            else:
                at_start = c == ","
            i += 1
        return quoted

    rng = random.Random(0)
    quotes = records.Quotes(",", "UTF-8")
    for _ in range(3000):
        line = "".join(rng.choice('"",x \r') for _ in range(rng.randrange(14)))
        for inside in (False, True):
            assert quotes.after(line.encode(), inside) == plain(line, inside), (line, inside)


def test_several_files_with_breaks_and_a_bad_end(spark, write, tmp_path):
    write("a.csv", 'x;y\n1;"é\n2"\n', "latin-1")
    write("b.csv", '\ufeffx,y\n2,"b\n"\n\n3,"c\n\nd"\n')
    got = files.load_csv(spark, str(tmp_path / "*.csv")).orderBy("x").collect()
    assert [tuple(r) for r in got] == [(1, "é\n2"), (2, "b\n"), (3, "c\n\nd")]
    with pytest.raises(CorruptInputError, match="never closed"):
        files.load_csv(spark, write("z.csv", 'x,y\n1,"a\n2,b\n'))


def test_types_that_only_late_rows_rule_out(spark, tmp_path):
    """Rows beyond the first ones count as much: each column loses a type in its last row only, or gets its only value there."""
    columns = {
        "whole": ("7", "8"), "wide": ("7", "9" * 20), "text": ("7", "9" * 39), "number": ("7", "1e3"), "word": ("7", "x7"), "logic": ("true", "yes"),
        "truth": ("true", "FALSE"), "late": ("", "5"), "late_word": ("", "x"), "none": ("", "NA"), "mixed": ("true", "1"),
    }
    early, last = (",".join(v[i] for v in columns.values()) for i in (0, 1))
    (tmp_path / "late.csv").write_text("\n".join([",".join(columns), *[early] * 3000, last]) + "\n")
    found = {f.name: f.dataType.simpleString() for f in files.load_csv(spark, str(tmp_path / "late.csv")).schema}
    assert found == {"whole": "bigint", "wide": "decimal(38,0)", "text": "string", "number": "double", "word": "string", "logic": "string",
                     "truth": "boolean", "late": "bigint", "late_word": "string", "none": "double", "mixed": "string"}


def test_text_columns_are_not_tried_as_numbers_in_every_row(spark, tmp_path, monkeypatch):
    """One text rules out all other types, so that the pass over all rows asks only about the columns that may still be numbers."""
    asked = []
    kind = files._kind
    monkeypatch.setattr(files, "_kind", lambda value, *bits: asked.append(bits) or kind(value, *bits))
    (tmp_path / "t.csv").write_text("day,name,price\n" + "2024-01-02,a b,1.5\n" * 20)
    assert files.load_csv(spark, str(tmp_path / "t.csv")).count() == 20
    assert asked == [(), (), (), (files._IS_NUMBER,)]
