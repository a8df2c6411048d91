import os

from pyspark.sql import Observation

from larkspur.sources import files
from larkspur.sources.sinks import read_tsv, write_tsv

SCHEMA = "track_id STRING, title STRING, duration DOUBLE"


def test_csv_later_rows_replace_earlier(spark, tmp_path):
    (tmp_path / "a.csv").write_text('1,"one, first",1.5\n2,"two",2\n1,"one \\"again\\"",3\n')
    (tmp_path / "b.csv").write_text("2,newer,4\n" + "".join(f"x{i},filler,0\n" for i in range(500)))
    df = files.load_csv_upsert(spark, str(tmp_path), SCHEMA, "track_id")
    got = {r.track_id: (r.title, r.duration) for r in df.filter("title <> 'filler'").collect()}
    assert got == {"1": ('one "again"', 3.0), "2": ("newer", 4.0)}
    assert df.columns == ["track_id", "title", "duration"]


def test_csv_line_breaks_inside_quotes(spark, tmp_path):
    (tmp_path / "a.csv").write_text('1,"two\nlines",1\n')
    df = files.load_csv_upsert(spark, str(tmp_path), SCHEMA, "track_id", multi_line=True)
    assert df.first().title == "two\nlines"


def test_edges(spark, tmp_path):
    (tmp_path / "tab").write_text("1\t2\textra\n3\t4\nbad\tline\n")
    assert sorted(map(tuple, files.read_edges(spark, str(tmp_path / "tab")).collect())) == [(1, 2), (3, 4)]
    (tmp_path / "long").write_text("# head\n1 2\n3   4\n\n5\t6\n")
    got = files.read_edges(spark, str(tmp_path / "long"), sep=None, comments=True)
    assert sorted(map(tuple, got.collect())) == [(1, 2), (3, 4), (5, 6)]


def test_tsv_round_trips(spark, tmp_path):
    grams = spark.createDataFrame([("to be", 3), ("don't", 4), ('a"b', 5)], "gram string, cnt bigint")
    write_tsv(grams, str(tmp_path / "grams"))
    back = files.read_grams(spark, str(tmp_path / "grams"))
    assert sorted(map(tuple, back.collect())) == [('a"b', 1, 5), ("don't", 1, 4), ("to be", 2, 3)]
    write_tsv(spark.createDataFrame([(7, 0.25)], "id bigint, rank double"), str(tmp_path / "ranks"))
    assert files.read_ranks(spark, str(tmp_path / "ranks")).first() == (7, 0.25)


def test_posts_filter_reaches_the_scan(spark, tmp_path):
    from tests.conftest import plan_text

    spark.createDataFrame([(1, 2, "t", "c")], files.POSTS_SCHEMA).write.parquet(str(tmp_path / "p"))
    df = files.read_posts(spark, str(tmp_path / "p"), "parquet").filter("uid = 1")
    assert df.count() == 1 and "EqualTo(uid,1)" in plan_text(df)


def test_jdbc_reads_are_split_into_ranges():
    options = files.jdbc_options("songs", {"url": "jdbc:x"}, ("id", 0, 100, 8))
    assert options["dbtable"] == "songs" and options["numPartitions"] == "8"
    assert (options["partitionColumn"], options["lowerBound"], options["upperBound"]) == ("id", "0", "100")


def test_tsv_keeps_fields_as_they_are(spark, tmp_path):
    rows = [(" a ", "x\ty", 1), ('"q"', "", 2), (None, "back\\t\nline", None), ("z", "\\", 3)]
    df = spark.createDataFrame(rows, "a string, b string, n int")
    write_tsv(df, str(tmp_path / "t"))
    lines = {r.value for r in spark.read.text(str(tmp_path / "t")).collect()}
    assert " a \tx\\ty\t1" in lines and '"q"\t\t2' in lines
    back = {tuple(r) for r in read_tsv(spark, str(tmp_path / "t"), "a string, b string, n int").collect()}
    assert back == {tuple(v or None if isinstance(v, str) else v for v in r) for r in rows}


def test_csv_order_of_paths_and_numbered_files(spark, tmp_path):
    for name, title in (("b.csv", "first"), ("a.csv", "second")):
        (tmp_path / name).write_text(f"1,{title},1\n")
    paths = [str(tmp_path / "b.csv"), str(tmp_path / "a.csv")]
    assert files.load_csv_upsert(spark, paths, SCHEMA, "track_id").first().title == "second"
    assert files.load_csv_upsert(spark, paths[::-1], SCHEMA, "track_id").first().title == "first"
    folder = tmp_path / "loads"
    folder.mkdir()
    for n in (9, 10):
        (folder / f"load-{n}.csv").write_text(f"1,load {n},1\n")
        os.utime(folder / f"load-{n}.csv", (1000, 1000))
    assert files.load_csv_upsert(spark, str(folder), SCHEMA, "track_id").first().title == "load 10"
    os.utime(folder / "load-9.csv", (2000, 2000))
    assert files.load_csv_upsert(spark, str(folder), SCHEMA, "track_id").first().title == "load 9"


def test_text_ids_and_dropped_lines(spark, tmp_path):
    (tmp_path / "e").write_text("ann\tbob\nonly\n7\t8\n\tx\n")
    dropped = Observation("dropped")
    edges = files.read_edges(spark, str(tmp_path / "e"), ids="string", dropped=dropped)
    assert {tuple(r) for r in edges.collect()} == {("ann", "bob"), ("7", "8")}
    assert dropped.get["dropped"] == 2


def test_skipped_pages_are_counted(spark, tmp_path):
    page = "<Page><Revision><Text>Some text</Text></Revision></Page>"
    (tmp_path / "x").write_text(f"{page}\n{page[:-9]}\nplain\n{page}\n")
    skipped = Observation("skipped")
    assert files.read_xml_lines(spark, str(tmp_path / "x"), skipped).count() == 2
    rows = files.read_xml_lines(spark, str(tmp_path / "x"), obs := Observation("again")).collect()
    assert len(rows) == 2 and obs.get["skipped"] == 2


def test_messages(spark):
    from larkspur.sources.messages import decode_messages, encode_messages

    schema = "seq bigint, name string"
    df = spark.createDataFrame([(1, "a"), (2, None)], schema)
    sent = encode_messages(df, "seq")
    assert {r.key for r in sent.collect()} == {"1", "2"}
    odd = spark.createDataFrame([("3", "{broken"), ("4", None), ("5", '{"seq": "x"}')], "key string, value string")
    malformed = Observation("malformed")
    back = decode_messages(sent.unionByName(odd), schema, malformed).collect()
    assert {tuple(r) for r in back} == {(1, "a"), (2, None)} and malformed.get["malformed"] == 3
