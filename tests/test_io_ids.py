import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from helpers import plan_text
from txpipe.functions.columns import replace_missing_marker
from txpipe.operators.ids import dense_id, place_in_group
from txpipe.session import work_path
from txpipe.sources import files as IO
from txpipe.sources.fixture import load_transactions


def test_partition_pruning_and_roundtrip(spark):
    tx = load_transactions(spark, "/root/testdata/sf0.001")
    path = work_path(spark, "t-daily")
    IO.save_daily(tx, path, "2024-01-01")
    df = IO.load_dataset(spark, path, "2024-01-05", "2024-01-06")
    scan = [ln for ln in plan_text(df).splitlines() if "FileScan" in ln or "Scan parquet" in ln][0]
    pf = scan[scan.index("PartitionFilters: [") :].split("]")[0]
    assert "tx_date" in pf and ">=" in pf and "<=" in pf, scan
    want = tx.where(F.to_date("TX_DATETIME").between("2024-01-05", "2024-01-06"))
    assert sorted(df.collect()) == sorted(want.select(*df.columns).collect())
    assert IO.load_dataset(spark, path, "2030-01-01", "2030-01-02").count() == 0  # Q12: empty, no error


def test_text_datetime_keeps_microseconds(spark):
    tx = load_transactions(spark, "/root/testdata/sf0.001")
    path = work_path(spark, "t-daily-text")
    IO.save_daily(tx, path, "2024-01-01", datetime_as_text=True)
    back = IO.load_dataset(spark, path)
    assert back.exceptAll(tx.select(*back.columns)).count() == 0


def test_replace_missing_marker(spark):
    df = spark.createDataFrame([(-1, -1.0, "-1"), (5, 2.0, "x")], "a long, b double, s string")
    assert [tuple(r) for r in replace_missing_marker(df).collect()] == [(0, 0.0, "-1"), (5, 2.0, "x")]


def test_dense_id_matches_row_number(spark):
    tx = load_transactions(spark, "/root/testdata/sf0.01").select("TRANSACTION_ID", "TX_DATETIME")
    want = tx.withColumn("rn", F.row_number().over(Window.orderBy("TX_DATETIME", "TRANSACTION_ID")) - 1)
    for parts in (None, 5):
        got = dense_id(tx, ["TX_DATETIME", "TRANSACTION_ID"], partitions=parts)
        joined = got.join(want, "TRANSACTION_ID")
        assert joined.where(F.col("dense_id") != F.col("rn")).count() == 0
        assert got.count() == 10000


def test_hash_sample_exact(spark):
    from txpipe.operators.stats import hash_sample

    tx = load_transactions(spark, "/root/testdata/sf0.01")
    order = [r[0] for r in tx.orderBy((F.col("TRANSACTION_ID") * 7919) % 1000003, "TRANSACTION_ID").select("TRANSACTION_ID").collect()]
    for n in (0, 1, 7, 5000, 10000, 50000):
        got = sorted(r[0] for r in hash_sample(tx, n).select("TRANSACTION_ID").collect())
        assert got == sorted(order[:n])


def test_hash_sample_keeps_its_size_with_null_ids(spark):
    from txpipe.operators.stats import hash_sample

    df = spark.range(1000).select(F.when(F.col("id") % 10 != 0, F.col("id") - 500).alias("TRANSACTION_ID"), F.col("id").alias("v"))
    for n in (1, 500, 900, 950, 1000, 2000):
        got = hash_sample(df, n)
        assert got.count() == min(n, 1000) and got.where("TRANSACTION_ID is null").count() == max(0, min(n, 1000) - 900)


def test_flat_daily_files_by_name_range(spark, tmp_path):
    from datetime import date, timedelta

    tx = load_transactions(spark, "/root/testdata/sf0.001")
    pdf = tx.withColumn("d", F.to_date("TX_DATETIME")).toPandas()
    for day, rows in pdf.groupby("d"):
        rows.drop(columns="d").to_parquet(tmp_path / f"{day}.parquet", index=False, coerce_timestamps="us")
    df = IO.load_dataset(spark, f"file://{tmp_path}", "2024-01-05", "2024-01-06")
    assert df.count() == tx.where(F.to_date("TX_DATETIME").between("2024-01-05", "2024-01-06")).count() and df.columns == tx.columns
    opened = {r[0] for r in df.select(F.input_file_name()).distinct().collect()}
    assert {n.rsplit("/", 1)[1] for n in opened} == {f"{date(2024, 1, 5) + timedelta(days=i)}.parquet" for i in range(2)}
    assert IO.load_dataset(spark, f"file://{tmp_path}", "2030-01-01", "2030-01-02").count() == 0
    assert IO.load_dataset(spark, f"file://{tmp_path}").count() == tx.count()


def test_union_is_one_read_and_matches_by_name(spark):
    path = work_path(spark, "t-union")
    spark.range(3).selectExpr("id", "id * 2 AS a").write.parquet(path + "/1")
    spark.range(2).selectExpr("id + 10 AS b", "id").write.parquet(path + "/2")
    out = IO.union_files(spark, [path + "/1", path + "/2"])
    assert out.count() == 5 and set(out.columns) == {"id", "a", "b"} and out.where("b is null").count() == 3
    assert plan_text(out).count("FileScan parquet") == 1


def test_feature_files_have_dictionaries(spark):
    import pyarrow.parquet as pq
    from pyarrow import fs

    path = work_path(spark, "t-footer")
    IO.write_features(load_transactions(spark, "/root/testdata/sf0.01"), path)
    store, root = fs.FileSystem.from_uri(path)
    name = next(f.path for f in store.get_file_info(fs.FileSelector(root)) if f.path.endswith(".parquet"))
    with store.open_input_file(name) as f:
        meta = pq.ParquetFile(f).metadata
        column = {meta.row_group(0).column(i).path_in_schema: meta.row_group(0).column(i) for i in range(meta.num_columns)}
        assert any("DICTIONARY" in e for e in column["CUSTOMER_ID"].encodings)


def test_point_lookups_skip_row_groups(spark):
    """By the Bloom filter where ids hardly repeat, and Parquet gives up the
    dictionary; by the dictionary, in whose stead no filter is written, where
    they do."""
    tx = load_transactions(spark, "/root/testdata/sf0.01")
    path = work_path(spark, "t-bloom")
    in_no_order = tx.repartition(200)  # least and greatest values skip nothing
    IO.write_features(in_no_order, path, bloom_columns=("CUSTOMER_ID", "TERMINAL_ID", "TRANSACTION_ID"))
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    folder = jvm.org.apache.hadoop.fs.Path(path)
    files = [f.getPath() for f in folder.getFileSystem(conf).listStatus(folder) if f.getPath().getName().endswith(".parquet")]
    reader = jvm.org.apache.parquet.hadoop.ParquetFileReader.open(jvm.org.apache.parquet.hadoop.util.HadoopInputFile.fromPath(files[0], conf))
    columns = {c.getPath().toDotString(): c for c in reader.getFooter().getBlocks().get(0).getColumns()}
    has_filter = {n: c.getBloomFilterOffset() > 0 for n, c in columns.items()}
    has_dictionary = {n: c.getEncodingStats().hasDictionaryPages() and not c.getEncodingStats().hasNonDictionaryEncodedPages() for n, c in columns.items()}
    reader.close()
    assert has_filter["TRANSACTION_ID"] and not has_dictionary["TRANSACTION_ID"] and not has_filter["TX_AMOUNT"]
    assert all(has_filter[c] or has_dictionary[c] for c in ("CUSTOMER_ID", "TERMINAL_ID"))

    def scans(node):
        kids = node.children()
        return [node] if node.getClass().getSimpleName() == "FileSourceScanExec" else [s for i in range(kids.size()) for s in scans(kids.apply(i))]

    for column in ("CUSTOMER_ID", "TRANSACTION_ID"):
        wanted = tx.groupBy(column).count().orderBy("count", column).first()[column]
        found = IO.read_features(spark, path).where(F.col(column) == wanted)
        rows = len(found.collect())
        (scan,) = scans(found._jdf.queryExecution().executedPlan())
        assert 0 < rows <= scan.metrics().apply("numOutputRows").value() <= 10000 / 2


def test_places_of_groups_that_span_partitions(spark):
    rng = random.Random(11)
    rows = [(g, rng.randrange(10**6) * 1000 + i) for i, g in enumerate([None] * 30 + [3] * 700 + [4] * 2 + [5] * 300)]
    df = spark.createDataFrame(rows, "g long, v long").repartition(5)
    for parts in (1, 2, 7):
        out = place_in_group(df, ["g"], ["v"], partitions=parts)
        got = sorted(((r["g"], r["v"], r["place"]) for r in out.collect()), key=str)
        want = [(g, v, i + 1) for k in {g for g, _ in rows} for i, (g, v) in enumerate(sorted((r for r in rows if r[0] == k), key=lambda r: r[1]))]
        assert got == sorted(want, key=str)
        assert "Window" not in plan_text(out)  # none over rows: the table of runs is stored
    assert place_in_group(df.limit(0), ["g"], ["v"]).count() == 0
