import json
import os

import pytest
from pyspark.sql import functions as F

from clinicmart.sources import feed, landing, relational
from clinicmart.sources.landing import INGEST_ORDER
from clinicmart.sources.store import TierStore, work_root


def test_csv_with_mark_quotes_breaks_and_missing_values(spark, tmp_path):
    path = tmp_path / "c.csv"
    path.write_text(
        'id,texto,valor\n1,"a, b",NA\n2,"dos\nlineas",\n3,"dijo ""si""", x \n4,None,""\n',
        encoding="utf-8-sig",
    )
    df = landing.read_csv(spark, str(path))
    assert df.columns == ["id", "texto", "valor"]
    assert [tuple(r) for r in df.orderBy("id").collect()] == [
        ("1", "a, b", None), ("2", "dos\nlineas", None), ("3", 'dijo "si"', " x "),
        ("4", None, None),
    ]


def test_csv_file_order(spark, tmp_path):
    for name, ids in (("b.csv", range(100, 130)), ("a.csv", range(0, 400))):
        (tmp_path / name).write_text("id\n" + "\n".join(map(str, ids)) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "256")
    try:
        for multi_line in (True, False):
            df = landing.read_csv(spark, str(tmp_path), multi_line=multi_line, file_order=True)
            got = [int(r.id) for r in df.orderBy(INGEST_ORDER).collect()]
            assert got == [*range(0, 400), *range(100, 130)]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_csv_roundtrip_keeps_outer_blanks(spark, tmp_path):
    df = spark.createDataFrame([(1, "  a,\t"), (2, 'x "y"\nz'), (3, None)], "id int, t string")
    landing.write_csv(df, str(tmp_path / "out"))
    landing.write_csv(df, str(tmp_path / "out"))
    back = landing.read_csv(spark, str(tmp_path / "out")).orderBy("id").collect()
    assert [tuple(r) for r in back] == [("1", "  a,\t"), ("2", 'x "y"\nz'), ("3", None)]


RECORDS = [
    {"dim_29117": 29170, "value": "10.5", "iso3": "BOL", "src": {"id": 1, "n": {"x": "p"}}},
    {"dim_29117": 29171, "value": None, "iso3": "BOL", "src": {"id": 2, "n": {"x": "q"}}},
]


@pytest.mark.parametrize(
    "document", [{"body": {"data": RECORDS}}, {"data": RECORDS, "meta": 1}, RECORDS]
)
def test_feed_shapes(spark, tmp_path, document):
    path = tmp_path / "f.json"
    path.write_text(json.dumps(document, indent=1))
    df = feed.read_feed(spark, str(path))
    assert {"dim_29117", "value", "iso3", "src.id", "src.n.x", INGEST_ORDER} == set(df.columns)
    got = df.orderBy(INGEST_ORDER).select("dim_29117", "value", "`src.n.x`").collect()
    assert [tuple(r) for r in got] == [(29170, "10.5", "p"), (29171, None, "q")]


@pytest.mark.parametrize("document", [{"dim_1": 2000, "value": 1}, {"data": 5}, {"body": {"data": [1]}}])
def test_feed_of_unknown_shape_is_refused(spark, tmp_path, document):
    path = tmp_path / "f.json"
    path.write_text(json.dumps(document))
    with pytest.raises(ValueError, match="feed"):
        feed.read_feed(spark, str(path))


def test_feed_of_several_documents_with_schema(spark, tmp_path):
    for i in range(3):
        (tmp_path / f"{i}.json").write_text(json.dumps({"data": [{"anio": 2000 + i, "value": i}]}))
    from pyspark.sql.types import StructType

    schema = StructType.fromDDL("data array<struct<anio: bigint, value: double>>")
    df = feed.read_feed(spark, str(tmp_path), schema).orderBy(INGEST_ORDER)
    assert [(r.anio, r.value) for r in df.collect()] == [(2000, 0.0), (2001, 1.0), (2002, 2.0)]


def test_parse_records(spark):
    df = spark.createDataFrame([(1, '{"a": {"k": 3}}'), (2, "{bad")], "id int, doc string")
    got = feed.parse_records(df, "doc", "a struct<k: int>", "p")
    assert got.columns == ["id", "p.a.k"]
    assert [tuple(r) for r in got.orderBy("id").collect()] == [(1, 3), (2, None)]


def test_store_folder(spark, tmp_path):
    store = TierStore(spark, str(tmp_path))
    a = store.write("t", spark.range(5))
    assert a.count() == 5
    written = store.write_all({"t": spark.range(3), "u": spark.range(2)})
    assert {n: df.count() for n, df in written.items()} == {"t": 3, "u": 2}
    store.write_document("s", spark.createDataFrame([(1, None)], "a int, b string"))
    parts = [f for f in os.listdir(tmp_path / "s") if f.startswith("part")]
    text = "".join((tmp_path / "s" / part).read_text() for part in parts)
    assert json.loads(text) == {"a": 1, "b": None}


def test_store_needs_one_place(spark):
    with pytest.raises(ValueError):
        TierStore(spark)


def test_store_catalog(spark, tmp_path):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS mart LOCATION '{tmp_path}/mart'")
    try:
        store = TierStore(spark, database="mart")
        assert store.write("t", spark.range(5)).count() == 5
        assert store.write("t", spark.range(4)).count() == 4
        assert relational.load_tables(spark, ["mart.t"])["mart.t"].count() == 4
    finally:
        spark.sql("DROP DATABASE mart CASCADE")


def test_relational_folder(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "Paciente.parquet"))
    tables = relational.load_tables(spark, ["Paciente"], str(tmp_path))
    assert tables["Paciente"].agg(F.sum("id")).first()[0] == 3


def test_work_root_is_the_shared_folder(spark):
    base = spark.conf.get("spark.checkpoint.dir", None)
    root = work_root(spark)
    assert spark.sparkContext.applicationId in root
    assert base is None or root.startswith(base)


def test_documents_of_two_databases_stay_apart(spark, tmp_path):
    for name in ("doc_one", "doc_two"):
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {name} LOCATION '{tmp_path}/{name}'")
        TierStore(spark, database=name).write_document("summary", spark.createDataFrame([(name,)], "v string"))
    for name in ("doc_one", "doc_two"):
        assert spark.read.json(f"{tmp_path}/{name}/summary").first()["v"] == name
        spark.sql(f"DROP DATABASE {name}")


def test_a_run_is_seen_when_it_is_published(spark, tmp_path):
    store = TierStore(spark, str(tmp_path))
    store.write_all({"t": spark.range(1), "u": spark.range(2)})
    run = store.run()
    run.write("t", spark.range(10))
    run.write_document("d", spark.createDataFrame([(5,)], "n int"))
    assert (run.read("t").count(), run.read("u").count()) == (10, 2)
    held = store.read("t")
    assert held.count() == store.read("t").count() == 1 and not store.has("d")
    run.publish()
    # Who has opened the earlier table can go on reading it.
    assert (held.count(), store.read("t").count(), store.read("u").count()) == (1, 10, 2)
    assert store.read_document("d").first().n == 5
    assert {n: df.count() for n, df in TierStore(spark, str(tmp_path)).read_all(["t", "u"]).items()} == {"t": 10, "u": 2}


def test_pruning_keeps_what_is_published(spark, tmp_path):
    store = TierStore(spark, str(tmp_path))
    store.write_all({"t": spark.range(1), "u": spark.range(2)})
    old = store.published()["t"]
    store.write("t", spark.range(3))
    store.prune(keep=2)
    assert spark.read.parquet(old).count() == 1
    store.prune()
    assert not os.path.exists(old)
    assert (store.read("t").count(), store.read("u").count()) == (3, 2)


def test_runs_in_a_database(spark, tmp_path):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS runs_mart LOCATION '{tmp_path}/runs'")
    try:
        store = TierStore(spark, database="runs_mart")
        store.write("t", spark.range(2))
        failed = store.run()
        failed.write("t", spark.range(7))
        assert store.read("t").count() == spark.table("runs_mart.t").count() == 2
        store.write("t", spark.range(4))
        assert store.read("t").count() == spark.table("runs_mart.t").count() == 4
        store.prune()
        assert store.read("t").count() == 4
    finally:
        spark.sql("DROP DATABASE runs_mart CASCADE")


def test_a_table_without_a_manifest_is_read_by_its_name(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "t"))
    assert TierStore(spark, str(tmp_path)).read("t").count() == 3


# -------------------------------------------------------------------- headers


def write_files(folder, **files):
    folder.mkdir(exist_ok=True)
    for name, text in files.items():
        (folder / f"{name}.csv").write_text(text, encoding="utf-8")
    return str(folder)


@pytest.mark.parametrize("multi_line", [True, False])
def test_csv_columns_are_matched_by_name(spark, tmp_path, multi_line):
    path = write_files(tmp_path / "c", a="x,y\n1,2\n", b="\ufeffy,x\n20,10\n", c="", d='"x","y"\n3,"a,b"\n')
    df = landing.read_csv(spark, path, multi_line, file_order=True)
    assert df.columns == ["x", "y", INGEST_ORDER]
    assert [(r.x, r.y) for r in df.orderBy(INGEST_ORDER).collect()] == [("1", "2"), ("10", "20"), ("3", "a,b")]
    turned = landing.read_csv(spark, path, multi_line, columns=["y", "x"])
    assert turned.columns == ["y", "x"] and turned.count() == 3
    # One column is read as rightly as all of them.
    assert sorted(r.y for r in df.select("y").collect()) == ["2", "20", "a,b"]


@pytest.mark.parametrize("other", ["x,z\n1,2\n", "x\n1\n", "x,y,z\n1,2,3\n", "x,x\n1,2\n"])
def test_csv_with_another_header_is_refused(spark, tmp_path, other):
    path = write_files(tmp_path / "c", a="x,y\n1,2\n", b=other)
    with pytest.raises(landing.HeaderError, match="b.csv"):
        landing.read_csv(spark, path)
    with pytest.raises(landing.HeaderError, match="a.csv"):
        landing.read_csv(spark, write_files(tmp_path / "d", a="x,y\n1,2\n"), columns=["x", "w"])


@pytest.mark.parametrize("row", ["1", "1,2,3"])
@pytest.mark.parametrize("multi_line", [True, False])
def test_csv_rows_of_another_length_are_refused(spark, tmp_path, row, multi_line):
    path = write_files(tmp_path / "c", a=f"x,y\n1,2\n{row}\n")
    for columns in (["x", "y"], ["x"]):
        with pytest.raises(Exception, match="(?i)malformed"):
            landing.read_csv(spark, path, multi_line).select(*columns).collect()


def test_csv_of_nothing(spark, tmp_path):
    path = write_files(tmp_path / "c", a="")
    assert landing.read_csv(spark, path, columns=["x"]).count() == 0


def test_compressed_csv(spark, tmp_path):
    import gzip

    folder = tmp_path / "c"
    folder.mkdir()
    with gzip.open(folder / "a.csv.gz", "wt") as f:
        f.write("y,x\n2,1\n")
    (folder / "b.csv").write_text("x,y\n3,4\n")
    got = landing.read_csv(spark, str(folder)).select("x", "y").collect()
    assert sorted(tuple(r) for r in got) == [("1", "2"), ("3", "4")]


def test_files_are_ordered_by_their_numbers(spark, tmp_path):
    folder = tmp_path / "land ed"
    names = ["part-100000", "part-99999", "part-9", "part-10"]
    for name in names:
        write_files(folder, **{name: f"v\n{name}\n"})
    df = landing.read_csv(spark, str(folder), file_order=True)
    assert [r.v for r in df.orderBy(INGEST_ORDER).collect()] == ["part-9", "part-10", "part-99999", "part-100000"]
    # Rows carry numbers, not the names of their files.
    assert df.schema[INGEST_ORDER].dataType.simpleString() == "struct<file:int,block:bigint,row:bigint>"
    for name in names:
        (tmp_path / "feed").mkdir(exist_ok=True)
        (tmp_path / "feed" / f"{name}.json").write_text(json.dumps([{"year": 2000, "value": name}]))
    records = feed.read_feed(spark, str(tmp_path / "feed")).orderBy(INGEST_ORDER).collect()
    assert [r.value for r in records] == ["part-9", "part-10", "part-99999", "part-100000"]
