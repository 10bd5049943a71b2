import os

from pyspark.sql import functions as F

from tripkit.functions import geo
from tripkit.sources import loaders, readers, schemas, writers
from tripkit.operators import relational as Rel

ZONES = [(1, "a", "Manhattan"), (2, "b", "Queens"), (3, "c", "New Jersey")]


def test_yellow_rowstore_with_tract_lookup(spark):
    raw = spark.createDataFrame(
        [("CMT", 0.5, 0.5, "1", "Y", "Cash"), ("VTS", 0.0, 0.0, "7", "n", '"CRD"'), ("1", 5.0, 5.0, "2", "1.0", "dis")],
        "vendor_id string, pickup_longitude double, pickup_latitude double, rate_code_id string, "
        "store_and_fwd_flag string, payment_type string")
    for f in schemas.YELLOW_LEGACY.fields:
        if f.name not in raw.columns:
            raw = raw.withColumn(f.name, F.lit(None).cast(f.dataType))
    raw = raw.withColumn("dropoff_longitude", F.col("pickup_longitude")).withColumn("dropoff_latitude", F.col("pickup_latitude"))
    for c in ("improvement_surcharge", "congestion_surcharge", "airport_fee"):
        raw = raw.withColumn(c, F.lit(None).cast("double"))
    raw = raw.withColumn("pickup_location_id", F.lit(None).cast("int")).withColumn("dropoff_location_id", F.lit(None).cast("int"))
    tracts = spark.createDataFrame([(7, "POLYGON((0 0, 1 0, 1 1, 0 1, 0 0))")], "gid int, w string") \
        .select("gid", geo.parse_wkt("w").alias("rings"))
    tz = spark.createDataFrame([(7, 42)], "tract_id int, taxi_zone_location_id int")
    out = loaders.yellow_rowstore(raw, tracts, tz, cell=0.5).orderBy("vendor_id").collect()
    got = [(r.vendor_id, r.rate_code_id, r.store_and_fwd_flag, r.payment_type, r.pickup_longitude,
            r.pickup_location_id) for r in out]
    assert sorted(got, key=str) == sorted([(1, 1, True, 2, 0.5, 42), (2, None, False, 1, None, None),
                                           (1, 2, True, 4, 5.0, None)], key=str)


def test_fhv_loaders_and_company(spark):
    zones = spark.createDataFrame(ZONES, "location_id int, zone string, borough string")
    raw = spark.createDataFrame([(" b02510", "1", 1, 3), ("B99999", None, 2, 1)],
                                "dispatching_base_num string, legacy_shared_ride_flag string, "
                                "pickup_location_id int, dropoff_location_id int") \
        .withColumn("pickup_datetime", F.lit("2019-01-01 00:00:00").cast("timestamp_ntz")) \
        .withColumn("dropoff_datetime", F.lit("2019-01-01 00:10:00").cast("timestamp_ntz")) \
        .withColumn("filename", F.lit("fhv_tripdata_2019-01.parquet"))
    r = {x.dispatching_base_num: x for x in loaders.fhv_columnstore(raw, zones).collect()}
    assert r["B02510"].company == "lyft" and r["B02510"].hvfhs_license_num == "HV0005" and r["B02510"].legacy_shared_ride == 1
    assert r["B99999"].company == "other" and r["B02510"].dropoff_borough is None and r["B99999"].pickup_borough == "Queens"
    hv = spark.createDataFrame([("HV0003", "Y", " ", "N", " ", " "), ("HV9999", "N", "Y", " ", "N", "Y")],
                               "hvfhs_license_num string, shared_request_flag string, shared_match_flag string, "
                               "access_a_ride_flag string, wav_request_flag string, wav_match_flag string")
    for f in schemas.FHVHV.fields:
        if f.name not in hv.columns:
            hv = hv.withColumn(f.name, F.lit(None).cast(f.dataType))
    out = loaders.fhvhv_columnstore(hv.withColumn("filename", F.lit("f")), zones)
    rows = {x.hvfhs_license_num: x for x in out.collect()}
    assert rows["HV0003"].company == "uber" and rows["HV9999"].company is None
    assert rows["HV0003"].shared_match is False and rows["HV0003"].wav_match is None and rows["HV9999"].wav_match is True
    assert loaders.unmapped_company_count(out).first()[0] == 1
    rs = loaders.fhv_rowstore(hv.select("shared_request_flag", "access_a_ride_flag")
                              .withColumn("access_a_ride_flag", F.lit("")))
    assert {x.access_a_ride for x in rs.collect()} == {False}


def test_uber_2014_and_green(spark, tmpdir_path):
    p = os.path.join(tmpdir_path, "u.csv")
    with open(p, "w") as f:
        f.write("Date/Time,Lat,Lon,Base\n4/1/2014 0:11:00,0.5,0.5,B02512\n")
    raw = readers.read_csv(spark, p, schemas.UBER_2014_CSV)
    tracts = spark.createDataFrame([(7, "POLYGON((0 0, 1 0, 1 1, 0 1, 0 0))")], "gid int, w string") \
        .select("gid", geo.parse_wkt("w").alias("rings"))
    r = loaders.uber_2014(raw, tracts, cell=0.5).first()
    assert r.pickup_gid == 7 and str(r.pickup_datetime) == "2014-04-01 00:11:00"
    g = spark.createDataFrame([(2, "Y")], "vendor_id int, store_and_fwd_flag string") \
        .withColumn("lpep_pickup_datetime", F.lit(None).cast("timestamp_ntz")) \
        .withColumn("lpep_dropoff_datetime", F.lit(None).cast("timestamp_ntz"))
    row = loaders.green_rowstore(g).first()
    assert row.cab_type_id == 2 and row.store_and_fwd_flag is True


def test_writers_and_election_reader(spark, tmpdir_path):
    df = spark.createDataFrame([(i % 3, f"v{i}") for i in range(9)], "z int, v string")
    writers.write_csv(df, os.path.join(tmpdir_path, "one"), single_file=True)
    assert len([f for f in os.listdir(os.path.join(tmpdir_path, "one")) if f.endswith(".csv")]) == 1
    writers.write_partitioned_csv(df, "z", os.path.join(tmpdir_path, "parts"))
    assert sorted(d for d in os.listdir(os.path.join(tmpdir_path, "parts")) if d.startswith("z=")) == ["z=0", "z=1", "z=2"]
    writers.write_json_lines(df.select(F.to_json(F.struct("z", "v")).alias("json")), os.path.join(tmpdir_path, "j"))
    assert spark.read.json(os.path.join(tmpdir_path, "j")).count() == 9
    lay = writers.cluster_layout(df, ["z"], ["v"], partitions=3)
    assert lay.rdd.getNumPartitions() == 3
    assert writers.delete_where(spark.createDataFrame([(0.0005,), (0.3,)], "o double"), F.col("o") < 0.001).count() == 1
    p = os.path.join(tmpdir_path, "e.csv")
    with open(p, "w") as f:
        f.write("ad,ed,county,status,event,party,office,key,vote_for,unit,tally\n"
                "65,001,NY,x,e,p,o,k,1,Jill Stein (Green),\"1,234\"\n")
    e = readers.read_election_results(spark, p).first()
    assert e.election_district == 65001 and e.tally == 1234 and e.candidate == "Jill Stein"
    z = spark.createDataFrame(ZONES, "location_id int, zone string, borough string")
    z2 = readers.append_row_from(z, F.col("location_id") == 1, {"location_id": 99, "zone": "Newark Airport"})
    assert z2.count() == 4 and z2.filter("location_id = 99").first().borough == "Manhattan"


def test_not_in_scalable_path(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "z int")
    keys = spark.createDataFrame([(1,)], "z int")
    assert [r.z for r in Rel.not_in_set(df, "z", keys, keys_not_null=True).collect()] == [2]
    assert [r.z for r in Rel.not_in_set(df, "z", keys).collect()] == [2]


def test_yellow_loaders_accept_both_declared_schemas(spark):
    zones = spark.createDataFrame(ZONES, "location_id int, zone string, borough string")
    for schema in (schemas.YELLOW, schemas.YELLOW_LEGACY):
        raw = spark.createDataFrame([], schema)
        assert loaders.yellow_rowstore(raw).count() == 0
        assert "pickup_borough" in loaders.taxi_columnstore(raw, "yellow", zones).columns


def test_reload_without_rows_removes_the_old_ones(spark, tmpdir_path):
    table = os.path.join(tmpdir_path, "by_file")
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b")], "v int, filename string")
    writers.replace_by_file(df, table)
    writers.replace_by_file(df.filter("false"), table, files=["a"])
    assert [r.v for r in spark.read.parquet(table).collect()] == [3]


def test_row_key_tells_equal_names_in_two_folders_apart(spark, tmpdir_path):
    paths = [os.path.join(tmpdir_path, d) for d in ("x", "y")]
    for p in paths:
        spark.range(3).coalesce(1).write.parquet(p)
    keyed = readers.row_key(spark.read.parquet(*paths))
    assert keyed.select("row_id").distinct().count() == 6


def test_not_in_null_semantics(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "z int")
    keys = spark.createDataFrame([(1,), (None,)], "z int")
    assert Rel.not_in_set(df, "z", keys).count() == 0
    assert Rel.not_in_set(df, "z", keys.filter("false")).count() == 3


def test_files_per_key_of_partitioned_csv(spark, tmpdir_path):
    df = spark.range(400).selectExpr("id % 5 AS z", "id AS v").repartition(6)
    for n in (1, 3):
        folder = os.path.join(tmpdir_path, f"csv{n}")
        writers.write_partitioned_csv(df, "z", folder, files_per_key=n)
        files = {z: len([f for f in os.listdir(os.path.join(folder, f"z={z}")) if f.endswith(".csv")]) for z in range(5)}
        assert all(1 <= c <= n for c in files.values()) and (n > 1 or set(files.values()) == {1})
        assert spark.read.option("header", True).csv(folder).count() == 400


def test_clustered_layout_lets_readers_skip_row_groups(spark, tmpdir_path):
    """Most files' statistics exclude one type and a short time span, so a scan need not read them."""
    import pyarrow.parquet as pq
    rows = spark.range(4000).selectExpr("CASE WHEN id * 7919 % 3 = 0 THEN 'x' WHEN id * 7919 % 3 = 1 THEN 'y' ELSE 'z' END AS kind", "id * 104729 % 86400 AS t")
    admitted = {}
    for name, d in (("plain", rows.repartition(8)), ("clustered", writers.cluster_layout(rows, ["kind"], ["t"], 8))):
        folder = os.path.join(tmpdir_path, name)
        writers.write_table(d, folder)
        stats = [[g.column(c).statistics for c in range(2)] for f in os.listdir(folder) if f.endswith(".parquet")
                 for g in (lambda m: [m.row_group(i) for i in range(m.num_row_groups)])(pq.ParquetFile(os.path.join(folder, f)).metadata)]
        admitted[name] = sum(k.min <= "y" <= k.max and t.max >= 1000 and t.min <= 2000 for k, t in stats)
    assert admitted["plain"] == 8 and admitted["clustered"] <= 2
    back = spark.read.parquet(os.path.join(tmpdir_path, "clustered")).where("kind = 'y' AND t BETWEEN 1000 AND 2000")
    assert "PushedFilters: [IsNotNull(kind), IsNotNull(t), EqualTo(kind,y)" in back._jdf.queryExecution().toString()
    assert back.count() == rows.where("kind = 'y' AND t BETWEEN 1000 AND 2000").count()


def test_clustered_layout_adds_files_for_more_rows(spark, monkeypatch):
    """What a task sorts does not grow with the table, and the files stay in order."""
    monkeypatch.setattr(writers, "ROWS_A_FILE", 100, raising=False)
    rows = spark.range(1000).selectExpr("id % 3 AS kind", "id * 7919 % 1009 AS t")
    d = writers.cluster_layout(rows, ["kind"], ["t"], 4)
    files = {}
    for r in d.withColumn("file", F.spark_partition_id()).collect():
        files.setdefault(r["file"], []).append((r["kind"], r["t"]))
    assert len(files) == 10 and max(map(len, files.values())) < 200
    assert sum((files[f] for f in sorted(files)), []) == sorted((r["kind"], r["t"]) for r in rows.collect())


def test_managed_tables_show_whole_loads_only(spark, tmpdir_path):
    from tripkit.sources.managed import ManagedTables, replace_with_rollups
    t = ManagedTables(spark, tmpdir_path)
    facts = spark.createDataFrame([(f, d, 1) for f in ("a", "b", "c") for d in range(4)], "filename string, day int, n int")
    roll = {"daily": lambda d: d.groupBy("filename", "day").agg(F.sum("n").alias("n"))}
    replace_with_rollups(t, "facts", facts, roll)

    def seen():
        rows = t.read("facts").groupBy("filename").agg(F.sum("n").alias("n")).collect()
        days = t.read("daily").groupBy("day").agg(F.sum("n").alias("n")).collect()
        return {r["filename"]: r["n"] for r in rows}, {r["day"]: r["n"] for r in days}

    assert seen() == ({"a": 4, "b": 4, "c": 4}, {d: 3 for d in range(4)})
    evaluated = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            evaluated.add(len(b))
            yield b

    again = facts.where("filename = 'b' AND day < 2").mapInPandas(counted, facts.schema)
    load = t.write({"facts": again})              # dies before the commit
    assert seen() == ({"a": 4, "b": 4, "c": 4}, {d: 3 for d in range(4)}) and t.unused_loads("facts").count() == 1
    evaluated.value = 0
    replace_with_rollups(t, "facts", again, roll, files=["b", "c"])
    assert evaluated.value == 2                   # the input is evaluated once
    want = ({"a": 4, "b": 2}, {0: 2, 1: 2, 2: 1, 3: 1})
    assert seen() == want
    t.commit(load, ["facts"])                     # a replay of the first try holds the same rows
    assert seen() == want
    replace_with_rollups(t, "facts", facts.where("false"), roll, files=["a"])
    assert seen() == ({"b": 2}, {0: 1, 1: 1})
    assert t.unused_loads("facts").count() >= 2


def test_dense_ids_over_many_files(spark, tmpdir_path):
    for k, n in enumerate((5, 0, 7, 1, 12)):
        spark.range(n).selectExpr(f"id AS v", f"{k} AS f").repartition(2 if n > 6 else 1).write.parquet(os.path.join(tmpdir_path, f"m{k}"))
    df = spark.read.parquet(*[os.path.join(tmpdir_path, f"m{k}") for k in range(5)])
    ids = readers.dense_row_id(df)
    rows = [tuple(r) for r in ids.collect()]
    assert sorted(r[0] for r in rows) == list(range(1, 26)) and ids.columns == ["id", "v", "f"]
    assert sorted(rows) == sorted(tuple(r) for r in readers.dense_row_id(df.repartition(3) if False else spark.read.parquet(os.path.join(tmpdir_path, "m*"))).collect())


def test_schema_groups_without_a_job_a_file(spark, tmpdir_path):
    for m in range(6):
        d = spark.range(3).withColumn("x", F.lit(1) if m % 2 else F.lit(1.5))
        (d.withColumn("extra", F.lit("e")) if m == 4 else d).coalesce(1).write.parquet(os.path.join(tmpdir_path, f"yellow_tripdata_2020-0{m + 1}.parquet"))
    groups = readers.schema_groups(spark, tmpdir_path)
    assert sorted(map(len, groups)) == [1, 2, 3]
    df = readers.read_trips(spark, tmpdir_path, "", schema=schemas._schema(("id", schemas.L), ("x", schemas.D)), name=readers.data_set_name)
    assert df.count() == 18 and df.select("filename").distinct().count() == 6
    assert df.where("x IS NULL").count() == 0
