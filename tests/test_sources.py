"""CSV input, Parquet output, catalog tables and the whole run."""

import datetime as dt
import os
import shutil
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from reelmetrics.operators import clean
from reelmetrics.plans import star_etl
from reelmetrics.sources import readers, schemas, tables
from reelmetrics.sources.sample_star import SampleStar
from reelmetrics.sources.scratch import scratch_dir
from reelmetrics.sources.writers import write_curated

D = dt.date
AS_OF = D(2001, 11, 5)


def write(path, text):
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_csv_quotes(spark, tmp_path):
    path = write(tmp_path / "q.csv", 'a,b,c\n1,"say ""hi"", ok",2024-02-29\n2,"é, ""x""",\n')
    got = [tuple(r) for r in readers.read_csv(spark, path, "a int, b string, c date").orderBy("a").collect()]
    assert got == [(1, 'say "hi", ok', D(2024, 2, 29)), (2, 'é, "x"', None)]


def test_csv_line_break_in_quotes(spark, tmp_path):
    path = write(tmp_path / "m.csv", 'a,b\n1,"two\nlines"\n2,one\n')
    got = readers.read_csv(spark, path, "a int, b string", multi_line=True).orderBy("a").collect()
    assert [r.b for r in got] == ["two\nlines", "one"]


def test_csv_header_must_match(spark, tmp_path):
    path = write(tmp_path / "h.csv", "b,a\n1,2\n")
    with pytest.raises(Exception, match="CSV header does not conform to the schema"):
        readers.read_csv(spark, path, "a int, b int").collect()


def test_csv_rejects(spark, tmp_path):
    path = write(tmp_path / "r.csv", "a,d\n1,2024-01-31\n2,2020-13-45\nx,2024-01-01\n4,\n")
    schema = "a int, d date"
    plain = [tuple(r) for r in readers.read_csv(spark, path, schema).collect()]
    assert (2, None) in plain and len(plain) == 4
    good, bad = readers.split_rejects(readers.read_csv(spark, path, schema, keep_rejects=True))
    assert sorted(r.a for r in good.collect()) == [1, 4]
    assert bad.count() == 2
    assert sorted(r[0] for r in bad.select(readers.REJECT).collect()) == ["2,2020-13-45", "x,2024-01-01"]
    with pytest.raises(Exception, match="FAILFAST"):
        readers.read_csv(spark, path, schema, mode="FAILFAST").collect()


def test_csv_position_follows_the_files(spark, tmp_path):
    folder = tmp_path / "p"
    folder.mkdir()
    write(folder / "1.csv", "k,v\n" + "".join(f"{i % 7},{i}\n" for i in range(5000)))
    write(folder / "2.csv", "k,v\n" + "".join(f"{i % 11},{i}\n" for i in range(5000, 9000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        df = readers.read_csv(spark, str(folder), "k int, v int", with_position=True)
        assert df.rdd.getNumPartitions() > 5
        first = clean.dedup(df, "k", [readers.POSITION]).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    expected = {k: k for k in range(7)} | {k: next(i for i in range(5000, 9000) if i % 11 == k) for k in range(7, 11)}
    assert {r.k: r.v for r in first} == expected


@pytest.fixture(scope="module")
def csv_star(tmp_path_factory):
    folder = tmp_path_factory.mktemp("csv")
    files = {
        "movies.csv": 'show_id,type,title,director,cast,primary_country,all_countries,date_added,release_year,rating,duration_value,duration_unit,primary_genre,all_genres,description\n'
        's1,Movie," One ",,"A, B",US,"US, UK",2021-09-25,2001,PG-13,90,min,Drama,"Drama, Crime","He said ""no"".\nThe end."\n'
        "s1,Movie,One again,,,US,US,2021-09-25,2001,PG,90,min,Drama,Drama,copy\n"
        "s2,TV Show,Two,X,,,,,1990,,2,Season,Comedy,Comedy,\n",
        "users.csv": "user_id,name,email,gender,age,city,country,signup_date\n1,Ann,a@x.org,F,17,Oslo,NO,2020-01-01\n2,Ben,b@x.org,,,Rome,IT,2020-01-02\n",
        "subscription_plans.csv": "plan_id,plan_name,monthly_price,max_streams,video_quality\n1,Basic,199.0,1,SD\n2,Standard,499.0,2,HD\n3,Premium,649.0,4,Ultra HD\n",
        "subscriptions.csv": "subscription_id,user_id,plan_id,start_date,end_date,status,monthly_revenue\n1,1,1,2001-01-01,, active ,199.0\n2,1,3,2001-02-01,,Active,649.0\n3,2,2,2000-01-01,2000-02-01,Cancelled,499.0\n",
        "watch_history.csv": "watch_id,user_id,show_id,device,watch_date,watch_duration_minutes,completion_pct\n1,1,s1,Mobile,2001-11-01,30.5,120.0\n2,1,s2,Tablet,2000-01-05,10.0,50.0\n3,2,s1,Mobile,2001-09-01,-1.0,1.0\n4,2,s9,Laptop,2001-09-20,0.0,\n",
        "ratings.csv": "rating_id,user_id,show_id,rating,rating_date\n" + "".join(f"{i},1,s1,{i % 7},2001-01-01\n" for i in range(1, 15)),
    }
    for name, text in files.items():
        (folder / name).write_text(text, encoding="utf-8")
    return str(folder)


def test_read_star(spark, csv_star):
    star = readers.read_star(spark, csv_star)
    assert {t: df.count() for t, df in star.items()} == {"movies": 3, "users": 2, "plans": 3, "subscriptions": 3, "watch": 4, "ratings": 14}
    for table, df in star.items():
        assert df.columns == [c.name for c in schemas.TABLES[table]]
        assert [t for _, t in df.dtypes] == [c.type for c in schemas.TABLES[table]]
    first = star["movies"].where("title = ' One '").first()
    assert (first.cast_members, first.description) == ("A, B", 'He said "no".\nThe end.')
    assert star["plans"].agg(F.sum("monthly_price")).first()[0] == Decimal("1347.00")


def test_whole_run(spark, csv_star, tmp_path):
    out = str(tmp_path / "out")
    rows = star_etl.run_pipeline(spark, csv_star, out, AS_OF)
    assert len(rows) == 14
    assert rows == {name: spark.read.parquet(f"{out}/{name}").count() for name in rows}
    expected = {"dim_movies": 2, "dim_users": 2, "fact_subscriptions": 3, "fact_watch_history": 3, "watch_enriched": 3}
    expected |= {"kpi_top_watched_titles": 3, "kpi_user_engagement_churn": 3, "kpi_top_rated_movies": 1}
    assert {k: rows[k] for k in expected} == expected
    assert sorted(os.listdir(f"{out}/dim_movies"))[-2:] == ["type=Movie", "type=TV Show"]
    assert {"watch_year=2000", "watch_year=2001"} <= set(os.listdir(f"{out}/watch_enriched"))
    assert "watch_month" not in spark.read.parquet(f"{out}/fact_watch_history").columns
    assert {"watch_month", "watch_year", "city"} <= set(spark.read.parquet(f"{out}/watch_enriched").columns)
    def values(name, *cols):
        return sorted(map(tuple, spark.read.parquet(f"{out}/{name}").select(*cols).collect()), key=repr)

    minutes = Decimal("30.5"), Decimal("10.0"), Decimal("0.0")
    assert values("kpi_popular_genres", "primary_genre", "view_count", "total_minutes") == [
        ("Comedy", 1, minutes[1]), ("Drama", 1, minutes[0]), (None, 1, minutes[2])
    ]
    assert values("kpi_active_cities", "city", "watch_events", "active_users") == [("Oslo", 2, 1), ("Rome", 1, 1)]
    assert values("kpi_user_engagement_churn", "user_id", "plan_id", "days_since_last_watch", "churn_risk") == [
        (1, 1, 4, "Low"), (1, 3, 4, "Low"), (2, None, 46, "Medium")
    ]
    assert values("kpi_monthly_trend", "watch_month", "unique_viewers") == [("2000-01", 1), ("2001-09", 1), ("2001-11", 1)]
    assert values("dim_movies", "show_id", "title", "content_age_years", "type") == [
        ("s1", "One", 0, "Movie"), ("s2", "Two", 11, "TV Show")
    ]
    before = {n: sorted(map(repr, spark.read.parquet(f"{out}/{n}").collect())) for n in rows}
    assert star_etl.run_pipeline(spark, csv_star, out, AS_OF, persist=False) == rows
    assert before == {n: sorted(map(repr, spark.read.parquet(f"{out}/{n}").collect())) for n in rows}
    assert not spark.sparkContext._jsc.getPersistentRDDs()


def test_every_line_is_accounted_for(spark, csv_star, tmp_path):
    folder, out = tmp_path / "broken", str(tmp_path / "out")
    shutil.copytree(csv_star, folder)
    with open(folder / "watch_history.csv", "a") as f:
        f.write("9,1,s1,Laptop,2001-11-01,many,50.0\n10,1,s1,Laptop,2020-13-45,5.0,50.0\n11,1,s1,Laptop,2001-11-01,-5.0,50.0\n")
    before, _ = star_etl.run_from_csv(spark, str(csv_star), str(tmp_path / "first"), AS_OF)
    rows, accounts = star_etl.run_from_csv(spark, str(folder), out, AS_OF)
    watch = accounts["watch"]
    assert (watch.rejected, watch.written) == (2, before["fact_watch_history"])
    for name, a in accounts.items():
        assert spark.read.parquet(f"{out}/rejected/{name}").count() == a.rejected
        if a.written is not None:
            assert a.read == a.rejected + a.filtered + a.written and min(a) >= 0
    assert rows == before


def test_bucketed_load_writes_few_files(spark, tmp_path):
    hot = F.expr("CASE WHEN id % 3 = 0 THEN 7 ELSE id % 1000 END AS k")
    df = spark.range(0, 60_000, 1, 12).select("id", hot)
    for per_bucket in (1, 4):
        place = str(tmp_path / f"b{per_bucket}")
        tables.load_table(df, "bucketed", bucket_cols=["k"], buckets=16, location=place, files_per_bucket=per_bucket)
        files = [f for f in os.listdir(place) if f.endswith(".parquet")]
        assert 16 <= len(files) <= 16 * per_bucket
        stored = spark.read.parquet(place).where("k = 7").groupBy(F.input_file_name()).count().collect()
        assert len(stored) == per_bucket
        assert spark.table("bucketed").count() == 60_000
        spark.sql("DROP TABLE bucketed")


def test_session_views(spark, csv_star):
    star = readers.read_star(spark, csv_star)
    cleaned = star | {"users": clean.clean_users(star["users"]), "movies": clean.clean_movies(star["movies"], AS_OF)}
    tables.register_views(star_etl.star_views(cleaned))
    got = spark.sql("SELECT title, count(*) AS n FROM watch_enriched GROUP BY title ORDER BY title NULLS LAST").collect()
    assert [tuple(r) for r in got] == [("One", 2), ("Two", 1), (None, 1)]
    assert spark.sql("SELECT count(*) FROM subs_enriched JOIN dim_movies ON false").first()[0] == 0
    assert spark.table("ratings_enriched").count() == 14


def test_write_partitioned_and_counted(spark, tmp_path):
    path = str(tmp_path / "years")
    df = spark.range(1000).selectExpr("id", "CAST(2000 + id % 3 AS int) AS y")
    assert write_curated(df, path, ["y"]) == 1000
    assert sorted(d for d in os.listdir(path) if d.startswith("y=")) == ["y=2000", "y=2001", "y=2002"]
    pruned = spark.read.parquet(path).where("y = 2001")
    assert "PartitionFilters: [isnotnull(y" in pruned._jdf.queryExecution().executedPlan().toString()
    assert write_curated(df.where("y = 2001 AND id < 10"), path, ["y"], dynamic=True) == 3
    assert {r.y: r["count"] for r in spark.read.parquet(path).groupBy("y").count().collect()} == {2000: 334, 2001: 3, 2002: 333}
    assert write_curated(df.where("y = 2002"), path, ["y"]) == 333
    assert spark.read.parquet(path).count() == 333


def test_a_hot_partition_is_written_in_several_files(spark, tmp_path):
    path = str(tmp_path / "hot")
    hot = F.expr("CASE WHEN id % 3 > 0 THEN 2000 ELSE 2001 + id % 4 END AS y")
    df = spark.range(0, 400_000, 1, 6).select("id", F.xxhash64("id").alias("v"), hot)
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "512KB")
    try:
        assert write_curated(df, path, ["y"]) == 400_000
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    files = {d: len([f for f in os.listdir(f"{path}/{d}") if f.endswith(".parquet")]) for d in os.listdir(path) if d.startswith("y=")}
    assert files.pop("y=2000") >= 4
    # Without the shuffle each of the six tasks would write a file for each of the years.
    assert sum(files.values()) < 6 * 4


def test_write_without_partitions_does_not_shuffle(spark, tmp_path):
    path = str(tmp_path / "flat")
    assert write_curated(spark.range(0, 100, 1, 5), path) == 100
    assert len([f for f in os.listdir(path) if f.endswith(".parquet")]) == 5
    assert write_curated(spark.range(0, 100, 1, 5), path, rebalance=True) == 100
    assert len([f for f in os.listdir(path) if f.endswith(".parquet")]) == 1


def test_catalog_tables_and_views(spark, csv_star):
    place = scratch_dir(spark, "star")
    tables.create_star_tables(spark, "t_", place)
    star = readers.read_star(spark, csv_star)
    for name in schemas.LOAD_ORDER:
        tables.load_table(star[name], f"t_{name}")
        tables.load_table(star[name], f"t_{name}")
    assert spark.table("t_watch").count() == 4
    tables.load_table(star["watch"], "t_watch", mode="append")
    assert spark.table("t_watch").count() == 8
    views = tables.create_kpi_views(spark, "t_")
    assert [spark.table(v).count() for v in views] == [3, 3, 2]
    tables.create_kpi_views(spark, "t_")
    with pytest.raises(PySparkException):
        tables.load_table(star["movies"].withColumn("show_id", F.repeat("show_id", 20)), "t_movies")
    tables.drop_kpi_views(spark, "t_")
    tables.drop_kpi_views(spark, "t_")
    tables.drop_star_tables(spark, "t_")
    tables.drop_star_tables(spark, "t_")
    assert not spark.catalog.tableExists("t_watch")


def test_bucketed_tables_join_without_a_shuffle(spark):
    star = SampleStar(spark, "/root/testdata/sf0.001")
    for name, df in (("b_watch", star.watch()), ("b_subs", star.subscriptions())):
        tables.load_table(df, name, bucket_cols=["user_id"], buckets=4, location=scratch_dir(spark, name))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = spark.table("b_watch").join(spark.table("b_subs"), "user_id").groupBy("user_id").count()
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
        assert joined.count() > 0
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("DROP TABLE b_watch")
        spark.sql("DROP TABLE b_subs")


def test_scratch_is_below_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    one, two = scratch_dir(spark, "x"), scratch_dir(spark, "x")
    assert one != two and one.startswith(shared) and two.startswith(shared)
