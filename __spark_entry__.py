"""Every operator as a query over a folder of Parquet files, with SQL that checks it."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, IntegerType, ShortType

from reelmetrics.functions import age_bucket, exact_mean
from reelmetrics.functions.columns import AGE_GROUPS, CHURN_RISKS
from reelmetrics.operators import clean, enrich, key_checks, order_stats, quality, quarantine, shares
from reelmetrics.plans import kpi, star_etl, viewer_bitmaps
from reelmetrics.plans.rollups import RollupStore
from reelmetrics.sources import readers, releases, schemas, tables
from reelmetrics.sources.layout import write_clustered
from reelmetrics.sources.sample_star import SampleStar
from reelmetrics.sources.scratch import scratch_dir
from reelmetrics.sources.writers import write_curated

SMOKE_DIR = "/root/testdata/sf0.001"
AS_OF = dt.date(2001, 11, 5)

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}

# The roles of the tables, as the SQL sees them. `subs` and `fact_watch` are cleaned.
_ROLES = """
movies AS (
  SELECT p_partkey AS show_id, CASE WHEN p_size <= 25 THEN 'Movie' ELSE 'TV Show' END AS type, p_name AS title,
         CASE WHEN p_partkey % 10 = 0 THEN NULL ELSE p_brand END AS director,
         CASE WHEN p_size % 5 = 0 THEN NULL ELSE p_brand END AS primary_country,
         1952 + p_size AS release_year, p_type AS primary_genre
  FROM part),
movie_copies AS (
  SELECT * REPLACE ('  ' || title || ' ' AS title) FROM movies
  UNION ALL SELECT * REPLACE ('  ' || upper(title) || ' ' AS title) FROM movies),
users AS (
  SELECT c_custkey AS user_id, c_name AS name, CAST(floor((c_acctbal + 1000) / 100) AS INT) AS age,
         n_name AS city, r_name AS country
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
grouped_users AS (
  SELECT *, CASE WHEN age < 18 THEN 'Teen' WHEN age < 30 THEN 'Young Adult' WHEN age < 45 THEN 'Adult'
                 WHEN age IS NOT NULL THEN 'Senior' END AS age_group FROM users),
plans AS (
  SELECT DISTINCT CAST(substr(o_orderpriority, 1, 1) AS INT) AS plan_id, substr(o_orderpriority, 3) AS plan_name FROM orders),
raw_subs AS (
  SELECT o_orderkey AS subscription_id, o_custkey AS user_id, CAST(substr(o_orderpriority, 1, 1) AS INT) AS plan_id,
         CAST(o_orderdate AS DATE) AS start_date,
         CASE WHEN o_orderstatus = 'F' THEN CAST(o_orderdate AS DATE) + 180 END AS end_date,
         CASE WHEN o_orderstatus = 'O' THEN 'Active' ELSE 'Cancelled' END AS status,
         CAST(o_totalprice AS DECIMAL(8,2)) AS monthly_revenue
  FROM orders),
subs AS (
  SELECT *, status = 'Active' AS is_active,
         datediff('day', start_date, coalesce(end_date, DATE '2001-11-05')) AS tenure_days FROM raw_subs),
watch AS (
  SELECT o_custkey AS user_id, l_partkey AS show_id, l_returnflag || l_linestatus AS device,
         CAST(l_shipdate AS DATE) AS watch_date, CAST(l_quantity - 1 AS DECIMAL(8,1)) AS watch_duration_minutes,
         CAST(l_discount * 1200 - 5 AS DECIMAL(5,1)) AS completion_pct
  FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey),
fact_watch AS (
  SELECT * REPLACE (CASE WHEN completion_pct > 100 THEN 100 ELSE completion_pct END AS completion_pct),
         strftime(watch_date, '%Y-%m') AS watch_month
  FROM watch WHERE watch_duration_minutes >= 0),
all_ratings AS (
  SELECT o_custkey AS user_id, l_partkey AS show_id, l_linenumber AS rating
  FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey),
ratings AS (SELECT * FROM all_ratings WHERE rating BETWEEN 1 AND 5),
engagement AS (
  SELECT user_id, max(watch_date) AS last_watch_date, count(*) AS total_sessions,
         sum(watch_duration_minutes) AS minutes,
         datediff('day', max(watch_date), DATE '2001-11-05') AS days_since_last_watch
  FROM fact_watch GROUP BY user_id),
risk AS (
  SELECT *, CASE WHEN days_since_last_watch > 60 THEN 'High' WHEN days_since_last_watch > 30 THEN 'Medium'
                 ELSE 'Low' END AS churn_risk FROM engagement),
churn_active AS (
  SELECT a.user_id, e.last_watch_date, e.days_since_last_watch,
         CASE WHEN days_since_last_watch <= -1 THEN NULL WHEN days_since_last_watch <= 30 THEN 'Low'
              WHEN days_since_last_watch <= 60 THEN 'Medium' WHEN days_since_last_watch <= 100000 THEN 'High' END AS churn_risk
  FROM (SELECT DISTINCT user_id FROM subs WHERE is_active) a LEFT JOIN engagement e USING (user_id)),
titled AS (SELECT w.*, m.title, m.type, m.primary_genre, m.release_year FROM fact_watch w JOIN movies m USING (show_id))
"""


def _half_up(total: str, rows: str, scale: int, digits: int) -> str:
    """SQL for the mean of a non-negative sum, rounded half up in whole numbers."""
    units = f"CAST(({total}) * {10**scale} AS HUGEINT)"
    parts = f"(CAST({rows} AS HUGEINT) * {10**scale})"
    return f"CAST((2 * {10**digits} * {units} + {parts}) // (2 * {parts}) AS DOUBLE) / {float(10**digits)}"


def _percent(part: str, whole: str, scale: int) -> str:
    """SQL for a share in percent with one decimal, rounded half up in whole numbers."""
    x, y = (f"CAST(({v}) * {10**scale} AS HUGEINT)" for v in (part, whole))
    return f"CAST((2000 * {x} + {y}) // (2 * {y}) AS DOUBLE) / 10.0"


def _plain(df: DataFrame, text: list[str]) -> DataFrame:
    """Decimals as double, short integers as bigint and some columns as text.

    So two engines agree on types. Text are dates, and numbers that may be missing.
    """
    cols = []
    for field in df.schema.fields:
        col = F.col(f"`{field.name}`")
        if field.name in text:
            col = col.cast("string").alias(field.name)
        elif isinstance(field.dataType, DecimalType):
            col = col.cast("double").alias(field.name)
        elif isinstance(field.dataType, (IntegerType, ShortType)):
            col = col.cast("bigint").alias(field.name)
        cols.append(col)
    return df.select(*cols)


def _query(name: str, sql: str, text: str = ""):
    """Register a query and its SQL; ``text`` names the columns to compare as text."""
    names = text.split()
    if names:
        sql = f"SELECT * REPLACE ({', '.join(f'CAST({c} AS VARCHAR) AS {c}' for c in names)}) FROM ({sql})"

    def register(build: Callable[[SampleStar], DataFrame]):
        _QUERIES[name] = lambda spark, sf_dir: _plain(build(SampleStar(spark, sf_dir)), names)
        _SQL[name] = f"WITH {_ROLES} {sql}"
        return build

    return register


# -- cleaning ------------------------------------------------------------------------


@_query(
    "clean_movies",
    """SELECT show_id, type, trim(title) AS title, director, primary_country, CAST(release_year AS BIGINT) AS release_year,
              trim(primary_genre) AS primary_genre, CAST(2001 - release_year AS BIGINT) AS content_age_years,
              2001 - release_year <= 3 AS is_recent_release
       FROM movie_copies
       QUALIFY row_number() OVER (PARTITION BY show_id ORDER BY type NULLS LAST, title NULLS LAST, director NULLS LAST,
         primary_country NULLS LAST, release_year NULLS LAST, primary_genre NULLS LAST) = 1""",
)
def _(s: SampleStar) -> DataFrame:
    return clean.clean_movies(s.movies_with_copies(), AS_OF)


@_query("clean_users_lt", "SELECT * REPLACE (CAST(age AS BIGINT) AS age) FROM grouped_users")
def _(s: SampleStar) -> DataFrame:
    return clean.clean_users(s.users())


@_query(
    "clean_users_le",
    """SELECT user_id, name, CAST(age AS BIGINT) AS age, city, country,
              CASE WHEN age <= 0 THEN NULL WHEN age <= 18 THEN 'Teen' WHEN age <= 30 THEN 'Young Adult'
                   WHEN age <= 45 THEN 'Adult' WHEN age <= 100 THEN 'Senior' END AS age_group FROM users""",
)
def _(s: SampleStar) -> DataFrame:
    return clean.clean_users(s.users(), bounds="le")


@_query(
    "clean_subscriptions",
    """SELECT * REPLACE (CAST(plan_id AS BIGINT) AS plan_id, CAST(monthly_revenue AS DOUBLE) AS monthly_revenue) FROM subs""",
    text="start_date end_date",
)
def _(s: SampleStar) -> DataFrame:
    return clean.clean_subscriptions(s.subscriptions(), AS_OF)


@_query(
    "clean_watch",
    """SELECT * REPLACE (CAST(watch_duration_minutes AS DOUBLE) AS watch_duration_minutes,
                         CAST(completion_pct AS DOUBLE) AS completion_pct) FROM fact_watch""",
    text="watch_date",
)
def _(s: SampleStar) -> DataFrame:
    return clean.clean_watch(s.watch())


@_query(
    "clean_watch_strict",
    """SELECT user_id, show_id, device, watch_date, CAST(watch_duration_minutes AS DOUBLE) AS watch_duration_minutes,
              CAST(least(greatest(completion_pct, 0), 100) AS DOUBLE) AS completion_pct,
              strftime(watch_date, '%Y-%m') AS watch_month
       FROM watch WHERE watch_duration_minutes > 0""",
    text="watch_date",
)
def _(s: SampleStar) -> DataFrame:
    return clean.clean_watch(s.watch(), min_exclusive=True, clip="both")


@_query("clean_ratings", "SELECT * REPLACE (CAST(rating AS BIGINT) AS rating) FROM ratings")
def _(s: SampleStar) -> DataFrame:
    return clean.clean_ratings(s.ratings())


@_query(
    "dedup_first",
    """SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice,
              l_discount, l_tax, l_returnflag, l_linestatus, CAST(l_shipdate AS DATE) AS l_shipdate
       FROM lineitem
       QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate, l_partkey, l_suppkey,
         l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus) = 1""",
    text="l_shipdate",
)
def _(s: SampleStar) -> DataFrame:
    lines = s.parquet("lineitem").withColumn("l_shipdate", F.to_date("l_shipdate"))
    order = ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    return clean.dedup(lines, ["l_orderkey", "l_linenumber"], [*order, "l_returnflag", "l_linestatus"])


@_query(
    "fill_unknown",
    """SELECT * REPLACE (coalesce(director, 'Unknown') AS director, coalesce(primary_country, 'Unknown') AS primary_country,
                         CAST(release_year AS BIGINT) AS release_year) FROM movies""",
)
def _(s: SampleStar) -> DataFrame:
    return clean.fill_unknown(s.movies())


@_query("normalize_status", "SELECT subscription_id, status FROM raw_subs")
def _(s: SampleStar) -> DataFrame:
    return clean.normalize_status(s.subscriptions().select("subscription_id", "status"))


@_query(
    "binge_flag",
    """SELECT show_id, device, watch_date, CAST(completion_pct AS DOUBLE) AS completion_pct,
              completion_pct >= 90 AS is_binge FROM fact_watch""",
    text="watch_date",
)
def _(s: SampleStar) -> DataFrame:
    watch = clean.clean_watch(s.watch(with_user=False))
    return clean.binge_flag(watch).select("show_id", "device", "watch_date", "completion_pct", "is_binge")


# -- quality -------------------------------------------------------------------------


@_query(
    "table_row_counts",
    """SELECT 'movies' AS table_name, count(*) AS rows FROM movies UNION ALL SELECT 'users', count(*) FROM users
       UNION ALL SELECT 'plans', count(*) FROM plans UNION ALL SELECT 'subscriptions', count(*) FROM raw_subs
       UNION ALL SELECT 'watch', count(*) FROM watch UNION ALL SELECT 'ratings', count(*) FROM all_ratings""",
)
def _(s: SampleStar) -> DataFrame:
    return quality.table_row_counts(_without_viewers(s))


def _without_viewers(s: SampleStar) -> dict[str, DataFrame]:
    return s.tables() | {"watch": s.watch(with_user=False), "ratings": s.ratings(with_user=False)}


@_query(
    "null_profile",
    """SELECT * FROM (
         SELECT 'director' AS column_name, count(*) FILTER (director IS NULL) AS null_count FROM movies
         UNION ALL SELECT 'primary_country', count(*) FILTER (primary_country IS NULL) FROM movies
         UNION ALL SELECT 'primary_genre', count(*) FILTER (primary_genre IS NULL) FROM movies
         UNION ALL SELECT 'release_year', count(*) FILTER (release_year IS NULL) FROM movies
         UNION ALL SELECT 'show_id', count(*) FILTER (show_id IS NULL) FROM movies
         UNION ALL SELECT 'title', count(*) FILTER (title IS NULL) FROM movies
         UNION ALL SELECT 'type', count(*) FILTER (type IS NULL) FROM movies)
       ORDER BY null_count DESC, column_name LIMIT 5""",
)
def _(s: SampleStar) -> DataFrame:
    return quality.null_profile(s.movies())


@_query(
    "cleaning_report",
    """SELECT 'unique titles' AS step, count(*) AS rows_before, count(DISTINCT show_id) AS rows_after FROM movie_copies
       UNION ALL SELECT 'duration not negative', count(*), count(*) FILTER (watch_duration_minutes >= 0) FROM watch
       UNION ALL SELECT 'duration positive', count(*), count(*) FILTER (watch_duration_minutes > 0) FROM watch
       UNION ALL SELECT 'rating in scale', count(*), count(*) FILTER (rating BETWEEN 1 AND 5) FROM all_ratings""",
)
def _(s: SampleStar) -> DataFrame:
    minutes = F.col("watch_duration_minutes")
    reports = [
        quality.cleaning_report(s.movies_with_copies(), {"unique titles": "show_id"}),
        quality.cleaning_report(
            s.watch(with_user=False), {"duration not negative": minutes >= 0, "duration positive": minutes > 0}
        ),
        quality.cleaning_report(s.ratings(with_user=False), {"rating in scale": F.col("rating").between(1, 5)}),
    ]
    return reports[0].unionByName(reports[1]).unionByName(reports[2])


@_query(
    "dq_primary_key",
    """SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, count(*) AS rows FROM lineitem
       GROUP BY ALL HAVING count(*) > 1""",
)
def _(s: SampleStar) -> DataFrame:
    return quality.dq_primary_key(s.parquet("lineitem"), ["l_orderkey", "l_linenumber"])


@_query(
    "dq_foreign_key",
    """SELECT doc_id, count(*) AS rows FROM documents WHERE doc_id IS NOT NULL
       AND doc_id NOT IN (SELECT doc_id FROM labels WHERE doc_id IS NOT NULL) GROUP BY doc_id""",
)
def _(s: SampleStar) -> DataFrame:
    return quality.dq_foreign_key(s.parquet("documents"), s.parquet("labels"), "doc_id")


@_query(
    "dq_check",
    "SELECT * REPLACE (CAST(rating AS BIGINT) AS rating) FROM all_ratings WHERE NOT (rating BETWEEN 1 AND 5)",
)
def _(s: SampleStar) -> DataFrame:
    return quality.dq_check(s.ratings(), schemas.CHECKS["ratings"])


@_query(
    "dq_not_null",
    """SELECT 'show_id' AS column_name, count(*) FILTER (show_id IS NULL) AS null_count FROM movies
       UNION ALL SELECT 'title', count(*) FILTER (title IS NULL) FROM movies
       UNION ALL SELECT 'director', count(*) FILTER (director IS NULL) FROM movies
       UNION ALL SELECT 'primary_country', count(*) FILTER (primary_country IS NULL) FROM movies""",
)
def _(s: SampleStar) -> DataFrame:
    return quality.dq_not_null(s.movies(), ["show_id", "title", "director", "primary_country"])


@_query(
    "dq_max_length",
    """SELECT 'text' AS column_name, CAST(1000 AS BIGINT) AS max_length, max(length(text)) AS longest,
              count(*) FILTER (length(text) > 1000) AS too_long FROM documents
       UNION ALL SELECT 'lang', 10, max(length(lang)), count(*) FILTER (length(lang) > 10) FROM documents
       UNION ALL SELECT 'source', 5, max(length(source)), count(*) FILTER (length(source) > 5) FROM documents""",
)
def _(s: SampleStar) -> DataFrame:
    return quality.dq_max_length(s.parquet("documents"), {"text": 1000, "lang": 10, "source": 5})


def _length_sql(text: str, unit: str) -> str:
    """SQL for the length of a text in bytes of UTF-8, or in units of UTF-16."""
    if unit == "bytes":
        return f"octet_length(encode({text}))"
    return f"(length({text}) + len(regexp_extract_all({text}, '[\\x{{10000}}-\\x{{10FFFF}}]')))"


_SPELLED = "source || chr(128250) || ': ' || text"


@_query(
    "dq_max_length_units",
    f"""SELECT column_name, CAST(1000 AS BIGINT) AS max_length, max(n) AS longest, count(*) FILTER (n > 1000) AS too_long
        FROM (SELECT 'as_bytes' AS column_name, {_length_sql(_SPELLED, 'bytes')} AS n FROM documents
              UNION ALL SELECT 'as_units', {_length_sql(_SPELLED, 'utf16')} FROM documents
              UNION ALL SELECT 'as_characters', length({_SPELLED}) FROM documents) GROUP BY column_name""",
)
def _(s: SampleStar) -> DataFrame:
    spelled = F.concat("source", F.lit("\U0001f4fa: "), "text")
    docs = s.parquet("documents").select(*[spelled.alias(f"as_{unit}") for unit in ("bytes", "units", "characters")])
    limits = {"as_bytes": "bytes", "as_units": "utf16", "as_characters": "characters"}
    return quality.dq_max_length(docs, {c: quality.TextLimit(1000, unit) for c, unit in limits.items()})


@_query(
    "dq_decimal_fit",
    """SELECT 'l_extendedprice' AS column_name,
              count(*) FILTER (l_extendedprice IS NOT NULL AND TRY_CAST(l_extendedprice AS DECIMAL(6,2)) IS NULL) AS out_of_range,
              count(*) FILTER (CAST(TRY_CAST(l_extendedprice AS DECIMAL(6,2)) AS DOUBLE) <> l_extendedprice) AS rounded
       FROM lineitem
       UNION ALL
       SELECT 'l_discount', count(*) FILTER (l_discount IS NOT NULL AND TRY_CAST(l_discount AS DECIMAL(5,1)) IS NULL),
              count(*) FILTER (CAST(TRY_CAST(l_discount AS DECIMAL(5,1)) AS DOUBLE) <> l_discount) FROM lineitem""",
)
def _(s: SampleStar) -> DataFrame:
    return quality.dq_decimal_fit(s.parquet("lineitem"), {"l_extendedprice": "decimal(6,2)", "l_discount": "decimal(5,1)"})


@_query(
    "dq_decimal_fit_text",
    """SELECT 'v' AS column_name, count(*) FILTER (CAST(whole AS BIGINT) > 999) AS out_of_range,
              count(*) FILTER (CAST(whole AS BIGINT) <= 999 AND length(rtrim(part, '0')) > 2) AS rounded
       FROM (SELECT CAST(l_partkey AS VARCHAR) AS whole, repeat('0', 3 * l_linenumber) || CAST(l_suppkey % 3 AS VARCHAR) || '00' AS part
             FROM lineitem)""",
)
def _(s: SampleStar) -> DataFrame:
    zeros, last = F.expr("repeat('0', 3 * l_linenumber)"), (F.col("l_suppkey") % 3).cast("string")
    text = F.concat(F.col("l_partkey").cast("string"), F.lit("."), zeros, last, F.lit("00"))
    return quality.dq_decimal_fit(s.parquet("lineitem").select(text.alias("v")), {"v": "decimal(5,2)"})


@_query(
    "dq_row_count",
    """SELECT e.table_name, CAST(e.expected AS BIGINT) AS expected, c.rows,
              coalesce(abs(c.rows - e.expected) <= e.expected * 0.05::DOUBLE, false) AS ok
       FROM (VALUES ('users', 6000), ('plans', 5), ('subscriptions', 15400), ('absent', 1)) e(table_name, expected)
       LEFT JOIN (SELECT 'users' AS table_name, count(*) AS rows FROM users
                  UNION ALL SELECT 'plans', count(*) FROM plans
                  UNION ALL SELECT 'subscriptions', count(*) FROM raw_subs) c USING (table_name)""",
    text="rows",
)
def _(s: SampleStar) -> DataFrame:
    counts = quality.table_row_counts({"users": s.users(), "plans": s.plans(), "subscriptions": s.subscriptions()})
    return quality.dq_row_count(counts, {"users": 6000, "plans": 5, "subscriptions": 15400, "absent": 1}, tolerance=0.05)


_KEY_RULE = """SELECT 'primary key' AS rule, '{t}' AS table_name, '{k}' AS column_name,
    coalesce((SELECT sum(n) FROM (SELECT count(*) AS n FROM {v} GROUP BY {k} HAVING n > 1 OR {k} IS NULL)), 0)::BIGINT AS violations"""


def _constraint_sql() -> str:
    """SQL for every declared rule; a rule on a column that the sample tables lack is not checked."""
    views = {"movies": "movies", "users": "users", "plans": "plans", "subscriptions": "raw_subs", "watch": "watch", "ratings": "all_ratings"}
    present = {
        "movies": "show_id type title director primary_country release_year primary_genre",
        "users": "user_id name age city country",
        "plans": "plan_id plan_name",
        "subscriptions": "subscription_id user_id plan_id start_date end_date status monthly_revenue",
        "watch": "user_id show_id device watch_date watch_duration_minutes completion_pct",
        "ratings": "user_id show_id rating",
    }
    rules = []

    def count(rule: str, table: str, column: str | None, condition: str, known: bool = True) -> None:
        violations = f"(SELECT count(*) FROM {views[table]} WHERE {condition})" if known else "NULL::BIGINT"
        rules.append(f"SELECT '{rule}' AS rule, '{table}' AS table_name, '{column}' AS column_name, {violations} AS violations")

    for t, k in schemas.PRIMARY_KEYS.items():
        if k in present[t].split():
            rules.append(_KEY_RULE.format(t=t, k=k, v=views[t]))
        else:
            count("primary key", t, k, "", False)
    for t, k, parent in schemas.FOREIGN_KEYS:
        count("foreign key", t, k, f"{k} IS NOT NULL AND {k} NOT IN (SELECT {k} FROM {views[parent]})")
    for t, expr in schemas.CHECKS.items():
        count("check", t, expr, f"NOT ({expr})")
    for t, cols in schemas.REQUIRED.items():
        for c in cols:
            count("not null", t, c, f"{c} IS NULL", c in present[t].split())
    for t, limits in schemas.MAX_LENGTHS.items():
        for c, limit in limits.items():
            count("max length", t, c, f"{_length_sql(f'CAST({c} AS VARCHAR)', limit.unit)} > {limit.most}", c in present[t].split())
    for t, types in schemas.DECIMALS.items():
        for c, decimal in types.items():
            cast = f"TRY_CAST({c} AS {decimal})"
            count("decimal", t, c, f"{c} IS NOT NULL AND ({cast} IS NULL OR {cast} <> {c})", c in present[t].split())
    for t, n in schemas.EXPECTED_ROWS.items():
        rules.append(
            f"SELECT 'row count', '{t}', NULL, CASE WHEN abs(n - {n}) > {n} * 0.05 THEN abs(n - {n}) ELSE 0 END::BIGINT FROM (SELECT count(*) AS n FROM {views[t]})"
        )
    return f"""SELECT *, CASE WHEN violations IS NULL THEN 'not checked' WHEN violations > 0 THEN 'violated' ELSE 'ok' END AS status
        FROM ({" UNION ALL ".join(rules)})"""


@_query("constraint_report", _constraint_sql(), text="violations")
def _(s: SampleStar) -> DataFrame:
    return quality.constraint_report(
        s.tables(),
        schemas.PRIMARY_KEYS,
        schemas.FOREIGN_KEYS,
        schemas.CHECKS,
        schemas.REQUIRED,
        schemas.MAX_LENGTHS,
        schemas.DECIMALS,
        schemas.EXPECTED_ROWS,
        tolerance=0.05,
    )


# -- enriched facts ------------------------------------------------------------------


def _grouped_users(s: SampleStar) -> DataFrame:
    """Users are unique by key, so the age group is added without a deduplication."""
    return s.users().withColumn("age_group", age_bucket(F.col("age")))


_WATCH_ENRICHED = """SELECT w.user_id, w.show_id, w.device, w.watch_date,
       CAST(w.watch_duration_minutes AS DOUBLE) AS watch_duration_minutes, CAST(w.completion_pct AS DOUBLE) AS completion_pct,
       w.watch_month, m.title, m.type, m.primary_genre, CAST(m.release_year AS BIGINT) AS release_year,
       u.city, u.country, u.age_group{more}
       FROM fact_watch w LEFT JOIN movies m USING (show_id) LEFT JOIN grouped_users u USING (user_id)"""


@_query("watch_enriched", _WATCH_ENRICHED.format(more=""), text="watch_date")
def _(s: SampleStar) -> DataFrame:
    return enrich.watch_enriched(clean.clean_watch(s.watch()), s.movies(), _grouped_users(s))


@_query(
    "subs_enriched",
    """SELECT s.* REPLACE (CAST(s.plan_id AS BIGINT) AS plan_id, CAST(s.monthly_revenue AS DOUBLE) AS monthly_revenue),
              p.plan_name, u.city, u.country
       FROM subs s LEFT JOIN plans p USING (plan_id) LEFT JOIN users u USING (user_id)""",
    text="start_date end_date",
)
def _(s: SampleStar) -> DataFrame:
    return enrich.subs_enriched(clean.clean_subscriptions(s.subscriptions(), AS_OF), s.plans(), s.users())


@_query(
    "ratings_enriched",
    """SELECT r.user_id, r.show_id, CAST(r.rating AS BIGINT) AS rating, m.title, m.primary_genre
       FROM ratings r LEFT JOIN movies m USING (show_id)""",
)
def _(s: SampleStar) -> DataFrame:
    return enrich.ratings_enriched(clean.clean_ratings(s.ratings()), s.movies())


# -- business questions --------------------------------------------------------------


def _events(s: SampleStar) -> DataFrame:
    """Cleaned events for questions that do not ask who watched."""
    return clean.clean_watch(s.watch(with_user=False))


def _viewer_events(s: SampleStar) -> DataFrame:
    return clean.clean_watch(s.watch())


def _clean_subs(s: SampleStar) -> DataFrame:
    return clean.clean_subscriptions(s.subscriptions(), AS_OF)


@_query(
    "kpi_top_watched_titles",
    """SELECT title, type, primary_genre, count(*) AS total_views,
              CAST(sum(watch_duration_minutes) AS DOUBLE) AS total_watch_minutes
       FROM titled GROUP BY title, type, primary_genre
       ORDER BY total_views DESC, title NULLS LAST, type NULLS LAST, primary_genre NULLS LAST LIMIT 10""",
)
def _(s: SampleStar) -> DataFrame:
    return kpi.kpi_top_watched_titles(_events(s), s.movies())


@_query(
    "kpi_top_titles_by_name",
    """SELECT title, count(show_id) AS total_views, CAST(sum(watch_duration_minutes) AS DOUBLE) AS total_minutes
       FROM titled WHERE title IS NOT NULL GROUP BY title ORDER BY total_views DESC, title LIMIT 10""",
)
def _(s: SampleStar) -> DataFrame:
    return kpi.kpi_top_titles_by_name(_events(s), s.movies(), count_col="show_id")


_GENRES = """SELECT primary_genre, count(*) AS view_count, CAST(sum(watch_duration_minutes) AS DOUBLE) AS total_minutes
       FROM titled GROUP BY primary_genre"""


@_query("kpi_popular_genres", _GENRES)
def _(s: SampleStar) -> DataFrame:
    return kpi.kpi_popular_genres(_events(s), s.movies())


@_query("kpi_popular_genres_top10", f"{_GENRES} ORDER BY total_minutes DESC, primary_genre NULLS LAST LIMIT 10")
def _(s: SampleStar) -> DataFrame:
    return kpi.kpi_popular_genres(_events(s), s.movies(), k=10)


_CITIES = """SELECT u.city, u.country, count(*) AS watch_events, count(DISTINCT w.user_id) AS active_users
       FROM fact_watch w JOIN users u USING (user_id) GROUP BY u.city, u.country"""


@_query("kpi_active_cities", _CITIES)
def _(s: SampleStar) -> DataFrame:
    return kpi.kpi_active_cities(_viewer_events(s), s.users())


@_query(
    "kpi_active_cities_top10",
    f"{_CITIES} ORDER BY watch_events DESC, u.city NULLS LAST, u.country NULLS LAST LIMIT 10",
)
def _(s: SampleStar) -> DataFrame:
    return kpi.kpi_active_cities(_viewer_events(s), s.users(), k=10)


@_query(
    "kpi_revenue_by_plan",
    f"""SELECT plan_name, count(*) AS subscription_count, CAST(sum(monthly_revenue) AS DOUBLE) AS total_revenue,
               {_half_up('sum(monthly_revenue)', 'count(monthly_revenue)', 2, 2)} AS avg_revenue_per_sub
        FROM subs JOIN plans USING (plan_id) GROUP BY plan_name""",
)
def _(s: SampleStar) -> DataFrame:
    return kpi.kpi_revenue_by_plan(s.subscriptions(), s.plans())


@_query(
    "kpi_device_usage",
    f"""SELECT device, count(*) AS sessions, CAST(sum(watch_duration_minutes) AS DOUBLE) AS total_minutes,
               {_half_up('sum(watch_duration_minutes)', 'count(watch_duration_minutes)', 1, 1)} AS avg_minutes_per_session
        FROM fact_watch GROUP BY device""",
)
def _(s: SampleStar) -> DataFrame:
    return kpi.kpi_device_usage(_events(s))


@_query(
    "kpi_top_rated",
    f"""SELECT *, row_number() OVER (ORDER BY avg_rating DESC, num_ratings DESC, show_id, title) AS rank FROM (
          SELECT show_id, title, count(*) AS num_ratings, {_half_up('sum(rating)', 'count(rating)', 0, 2)} AS avg_rating
          FROM ratings JOIN movies USING (show_id) GROUP BY show_id, title HAVING count(*) >= 5)
        QUALIFY rank <= 20""",
)
def _(s: SampleStar) -> DataFrame:
    return kpi.kpi_top_rated(clean.clean_ratings(s.ratings(with_user=False)), s.movies())


@_query(
    "kpi_top_rated_raw_mean",
    f"""SELECT show_id, title, count(*) AS num_ratings, {_half_up('sum(rating)', 'count(rating)', 0, 2)} AS avg_rating
        FROM ratings JOIN movies USING (show_id) WHERE title IS NOT NULL GROUP BY show_id, title HAVING count(*) >= 5
        ORDER BY CAST(sum(rating) AS DOUBLE) / count(rating) DESC, num_ratings DESC, show_id, title LIMIT 10""",
)
def _(s: SampleStar) -> DataFrame:
    return kpi.kpi_top_rated_raw_mean(clean.clean_ratings(s.ratings(with_user=False)), s.movies())


_TREND = """SELECT watch_month, count(*) AS total_views, CAST(sum(watch_duration_minutes) AS DOUBLE) AS total_minutes,
       count(DISTINCT user_id) AS unique_viewers FROM fact_watch GROUP BY watch_month"""


@_query("kpi_monthly_trend", _TREND)
def _(s: SampleStar) -> DataFrame:
    return kpi.kpi_monthly_trend(_viewer_events(s))


@_query(
    "kpi_monthly_trend_last12",
    f"SELECT * FROM ({_TREND}) WHERE watch_month IS NOT NULL ORDER BY watch_month DESC LIMIT 12",
)
def _(s: SampleStar) -> DataFrame:
    return kpi.kpi_monthly_trend(_viewer_events(s), last=12)


@_query(
    "kpi_churn_users",
    """SELECT user_id, name, last_watch_date, days_since_last_watch, total_sessions,
              CAST(minutes AS DOUBLE) AS total_watch_minutes, churn_risk FROM risk JOIN users USING (user_id)""",
    text="last_watch_date",
)
def _(s: SampleStar) -> DataFrame:
    return kpi.kpi_churn_users(_viewer_events(s), s.users(), AS_OF)


_CHURN = """SELECT r.user_id, r.last_watch_date, r.total_sessions, CAST(r.minutes AS DOUBLE) AS total_watch_minutes,
       CAST(s.plan_id AS BIGINT) AS plan_id, s.start_date, r.days_since_last_watch, r.churn_risk
       FROM risk r LEFT JOIN {subs} s ON s.user_id = r.user_id"""


@_query("kpi_user_engagement_churn", _CHURN.format(subs="(SELECT * FROM subs WHERE is_active)"), text="last_watch_date start_date plan_id")
def _(s: SampleStar) -> DataFrame:
    return kpi.kpi_user_engagement_churn(_viewer_events(s), _clean_subs(s), AS_OF)


@_query(
    "kpi_user_engagement_churn_one_row",
    _CHURN.format(
        subs="""(SELECT * FROM subs WHERE is_active
                 QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY start_date DESC, plan_id) = 1)"""
    ),
    text="last_watch_date start_date plan_id",
)
def _(s: SampleStar) -> DataFrame:
    return kpi.kpi_user_engagement_churn(_viewer_events(s), _clean_subs(s), AS_OF, one_row_per_user=True)


@_query("kpi_churn_active_subscribers", "SELECT * FROM churn_active", text="last_watch_date")
def _(s: SampleStar) -> DataFrame:
    return kpi.kpi_churn_active_subscribers(_viewer_events(s), _clean_subs(s), AS_OF)


@_query("kpi_churn_distribution", "SELECT churn_risk, count(*) AS users FROM churn_active GROUP BY churn_risk")
def _(s: SampleStar) -> DataFrame:
    return kpi.kpi_churn_distribution(kpi.kpi_churn_active_subscribers(_viewer_events(s), _clean_subs(s), AS_OF))


@_query(
    "kpi_churn_distribution_rows",
    """SELECT churn_risk, count(*) AS users
       FROM risk r LEFT JOIN (SELECT user_id FROM subs WHERE is_active) s ON s.user_id = r.user_id GROUP BY churn_risk""",
)
def _(s: SampleStar) -> DataFrame:
    return kpi.kpi_churn_distribution_of_rows(_viewer_events(s), _clean_subs(s), AS_OF)


_TOP_GENRES = """SELECT user_id, primary_genre, count(*) AS genre_view_count,
       row_number() OVER (PARTITION BY user_id ORDER BY count(*) DESC, primary_genre NULLS LAST) AS genre_rank
       FROM titled GROUP BY user_id, primary_genre QUALIFY genre_rank <= {k}"""


@_query("kpi_user_top_genres_3", _TOP_GENRES.format(k=3))
def _(s: SampleStar) -> DataFrame:
    return kpi.kpi_user_top_genres(_viewer_events(s), s.movies(), k=3)


@_query("kpi_user_top_genres_5", _TOP_GENRES.format(k=5))
def _(s: SampleStar) -> DataFrame:
    return kpi.kpi_user_top_genres(_viewer_events(s), s.movies(), k=5)


@_query(
    "kpi_avg_watch_per_user",
    f"""SELECT count(*) AS viewers, {_half_up('sum(minutes)', 'count(*)', 1, 1)} AS mean_watch_minutes,
               floor(median(CAST(minutes * 10 AS BIGINT)) + 0.5) / 10 AS median_watch_minutes
        FROM engagement WHERE user_id IS NOT NULL""",
)
def _(s: SampleStar) -> DataFrame:
    return kpi.kpi_avg_watch_per_user(_viewer_events(s))


@_query(
    "vw_top_watched_titles",
    """SELECT show_id, title, type, primary_genre, count(*) AS total_views,
              CAST(sum(watch_duration_minutes) AS DOUBLE) AS total_watch_minutes
       FROM titled GROUP BY show_id, title, type, primary_genre""",
)
def _(s: SampleStar) -> DataFrame:
    return kpi.vw_top_watched_titles(_events(s), s.movies())


@_query(
    "vw_revenue_by_plan",
    """SELECT plan_name, count(*) AS subscription_count, CAST(sum(monthly_revenue) AS DOUBLE) AS total_revenue
       FROM subs JOIN plans USING (plan_id) GROUP BY plan_name""",
)
def _(s: SampleStar) -> DataFrame:
    return kpi.vw_revenue_by_plan(s.subscriptions(), s.plans())


@_query(
    "vw_user_engagement",
    """SELECT user_id, total_sessions, CAST(minutes AS DOUBLE) AS total_watch_minutes, last_watch_date FROM engagement""",
    text="last_watch_date",
)
def _(s: SampleStar) -> DataFrame:
    return kpi.vw_user_engagement(_viewer_events(s))


# -- left joins with orphans, groups without a key, display order --------------------------

# Events whose numbers of titles and viewers are moved up, so that the last ones have no row in the dimension.
_MOVED = 20
_MOVED_WATCH = f"(SELECT * REPLACE (user_id + {_MOVED} AS user_id, show_id + {_MOVED} AS show_id) FROM fact_watch)"


def _moved(watch: DataFrame) -> DataFrame:
    return watch.withColumns({"user_id": F.col("user_id") + _MOVED, "show_id": F.col("show_id") + _MOVED})


_GENRES_LEFT = f"""SELECT primary_genre, count(*) AS view_count, CAST(sum(watch_duration_minutes) AS DOUBLE) AS total_minutes
    FROM {_MOVED_WATCH} LEFT JOIN movies USING (show_id) GROUP BY primary_genre"""


@_query("kpi_popular_genres_left", _GENRES_LEFT)
def _(s: SampleStar) -> DataFrame:
    return kpi.kpi_popular_genres(_moved(_events(s)), s.movies(), how="left")


@_query("kpi_popular_genres_drop_null", f"SELECT * FROM ({_GENRES_LEFT}) WHERE primary_genre IS NOT NULL")
def _(s: SampleStar) -> DataFrame:
    return kpi.kpi_popular_genres(_moved(_events(s)), s.movies(), how="left", drop_null=True)


@_query(
    "kpi_active_cities_left",
    f"""SELECT city, country, count(*) AS watch_events, count(DISTINCT user_id) AS active_users
        FROM {_MOVED_WATCH} LEFT JOIN users USING (user_id) GROUP BY city, country""",
)
def _(s: SampleStar) -> DataFrame:
    return kpi.kpi_active_cities(_moved(_viewer_events(s)), s.users(), how="left")


@_query(
    "watch_enriched_orphans",
    _WATCH_ENRICHED.format(more="").replace("FROM fact_watch w", f"FROM {_MOVED_WATCH} w"),
    text="watch_date release_year",
)
def _(s: SampleStar) -> DataFrame:
    return enrich.watch_enriched(_moved(clean.clean_watch(s.watch())), s.movies(), _grouped_users(s))


@_query(
    "watch_enriched_raw_attributes",
    """SELECT w.user_id, w.show_id, w.device, w.watch_date, CAST(w.watch_duration_minutes AS DOUBLE) AS watch_duration_minutes,
              CAST(w.completion_pct AS DOUBLE) AS completion_pct, w.watch_month, m.title, m.type, m.primary_genre,
              CAST(m.release_year AS BIGINT) AS release_year, u.city, u.country, CAST(u.age AS BIGINT) AS age,
              DATE '2000-01-01' + CAST(u.user_id % 1000 AS INT) AS signup_date
       FROM fact_watch w LEFT JOIN movies m USING (show_id) LEFT JOIN users u USING (user_id)""",
    text="watch_date signup_date",
)
def _(s: SampleStar) -> DataFrame:
    signup = F.date_add(F.lit(dt.date(2000, 1, 1)), (F.col("user_id") % 1000).cast("int"))
    users = s.users().withColumn("signup_date", signup)
    return enrich.watch_enriched(clean.clean_watch(s.watch()), s.movies(), users, user_attributes=enrich.USER_ATTRIBUTES_RAW)


@_query(
    "clean_users_null_as_senior",
    """SELECT user_id, name, CAST(nullif(age, 50) AS BIGINT) AS age, city, country,
              CASE WHEN age = 50 THEN 'Senior' ELSE age_group END AS age_group FROM grouped_users""",
    text="age",
)
def _(s: SampleStar) -> DataFrame:
    users = s.users().withColumn("age", F.nullif("age", F.lit(50)))
    return clean.clean_users(users, null_as_senior=True)


def _positions(ordered: DataFrame, *keys: Column) -> DataFrame:
    """A report in display order with the place of each row."""
    return ordered.withColumn("position", F.row_number().over(Window.orderBy(*keys)) - 1)


@_query("kpi_device_usage_ordered", f"SELECT *, row_number() OVER (ORDER BY sessions DESC, device) - 1 AS position FROM ({_SQL['kpi_device_usage']})")
def _(s: SampleStar) -> DataFrame:
    return _positions(kpi.kpi_device_usage(_events(s), ordered=True), F.desc("sessions"), F.asc("device"))


@_query("kpi_monthly_trend_ordered", f"SELECT *, row_number() OVER (ORDER BY watch_month) - 1 AS position FROM ({_SQL['kpi_monthly_trend']})")
def _(s: SampleStar) -> DataFrame:
    return _positions(kpi.kpi_monthly_trend(_viewer_events(s), ordered=True), F.asc("watch_month"))


# -- shares and fixed category orders ------------------------------------------------


@_query(
    "share_revenue_by_plan",
    f"""SELECT plan_name, CAST(revenue AS DOUBLE) AS total_revenue,
               {_percent('revenue', 'sum(revenue) OVER ()', 2)} AS share_pct
        FROM (SELECT plan_name, sum(monthly_revenue) AS revenue FROM subs JOIN plans USING (plan_id) GROUP BY plan_name)""",
)
def _(s: SampleStar) -> DataFrame:
    return shares.share_of_total(kpi.vw_revenue_by_plan(s.subscriptions(), s.plans()), "plan_name", "total_revenue")


@_query(
    "share_watch_by_type",
    f"""SELECT type, watch_events, {_percent('watch_events', 'sum(watch_events) OVER ()', 0)} AS share_pct
        FROM (SELECT type, count(*) AS watch_events FROM titled WHERE type IS NOT NULL GROUP BY type)""",
)
def _(s: SampleStar) -> DataFrame:
    return shares.share_of_total(kpi.watch_events_by_type(_events(s), s.movies()), "type", "watch_events")


_FINE = """SELECT l_returnflag, CAST(l_discount AS DECIMAL(4,2)) * CAST(l_tax AS DECIMAL(4,2)) AS x FROM lineitem"""


def _fine(s: SampleStar) -> DataFrame:
    x = F.col("l_discount").cast("decimal(4,2)") * F.col("l_tax").cast("decimal(4,2)")
    return s.parquet("lineitem").select("l_returnflag", x.cast("decimal(8,4)").alias("x"))


@_query(
    "share_of_total_4dp",
    f"""SELECT l_returnflag, CAST(total AS DOUBLE) AS x, {_percent('total', 'sum(total) OVER ()', 4)} AS share_pct
        FROM (SELECT l_returnflag, sum(x) AS total FROM ({_FINE}) GROUP BY l_returnflag)""",
)
def _(s: SampleStar) -> DataFrame:
    return shares.share_of_total(_fine(s), "l_returnflag", "x")


@_query("mean_4dp", f"SELECT l_returnflag, {_half_up('sum(x)', 'count(*)', 4, 4)} AS mean FROM ({_FINE}) GROUP BY l_returnflag")
def _(s: SampleStar) -> DataFrame:
    mean = exact_mean(F.sum("x"), F.count("x"), 4).alias("mean")
    return _fine(s).groupBy("l_returnflag").agg(mean)


@_query(
    "users_by_age_group",
    """SELECT CAST(position AS BIGINT) AS position, age_group, count(u.age) AS users
       FROM (VALUES (0, 'Teen', 0, 18), (1, 'Young Adult', 18, 30), (2, 'Adult', 30, 45), (3, 'Senior', 45, 100))
            g(position, age_group, above, up_to)
       LEFT JOIN users u ON u.age > above AND u.age <= up_to GROUP BY position, age_group""",
)
def _(s: SampleStar) -> DataFrame:
    grouped = s.users().select(age_bucket(F.col("age"), "le").alias("age_group"))
    return shares.ordered_counts(grouped, "age_group", AGE_GROUPS, "users")


@_query(
    "churn_distribution_ordered",
    """SELECT CAST(position AS BIGINT) AS position, churn_risk, count(c.user_id) AS users
       FROM (VALUES (0, 'Low'), (1, 'Medium'), (2, 'High')) g(position, churn_risk)
       LEFT JOIN churn_active c USING (churn_risk) GROUP BY position, churn_risk""",
)
def _(s: SampleStar) -> DataFrame:
    churn = kpi.kpi_churn_active_subscribers(_viewer_events(s), _clean_subs(s), AS_OF)
    return shares.ordered_counts(churn, "churn_risk", CHURN_RISKS, "users")


# -- sources and sinks: written to the shared folder, then read again ------------------


@_query(
    "read_csv",
    """SELECT * REPLACE ('say "' || title || '", or' || chr(10) || type AS title, CAST(release_year AS BIGINT) AS release_year)
       FROM movies""",
)
def _(s: SampleStar) -> DataFrame:
    quoted = F.concat(F.lit('say "'), "title", F.lit('", or\n'), "type")
    movies = s.movies().withColumn("title", quoted)
    path = scratch_dir(s.spark, "titles-csv")
    movies.write.options(header=True, quote='"', escape='"').csv(path)
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in movies.schema.fields)
    return readers.read_csv(s.spark, path, schema, multi_line=True)


@_query(
    "read_csv_rejects",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 10 <> 0 THEN CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS o_orderdate,
              CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS DOUBLE) AS o_totalprice, o_orderkey % 10 = 0 AS rejected FROM orders""",
    text="o_orderdate",
)
def _(s: SampleStar) -> DataFrame:
    day = F.when(F.col("o_orderkey") % 10 == 0, "2020-13-45").otherwise(F.to_date("o_orderdate").cast("string"))
    path = scratch_dir(s.spark, "orders-csv")
    lines = s.parquet("orders").select("o_orderkey", day.alias("o_orderdate"), F.col("o_totalprice").cast("decimal(12,2)").alias("o_totalprice"))
    lines.write.options(header=True).csv(path)
    read = readers.read_csv(s.spark, path, "o_orderkey bigint, o_orderdate date, o_totalprice decimal(12,2)", keep_rejects=True)
    return read.withColumn("rejected", F.col(readers.REJECT).isNotNull()).drop(readers.REJECT)


@_query("write_curated", _WATCH_ENRICHED.format(more=", CAST(year(w.watch_date) AS BIGINT) AS watch_year"), text="watch_date")
def _(s: SampleStar) -> DataFrame:
    enriched = clean.add_watch_year(enrich.watch_enriched(_viewer_events(s), s.movies(), _grouped_users(s)))
    path = scratch_dir(s.spark, "watch-by-year")
    write_curated(enriched, path, ["watch_year"])
    return s.spark.read.parquet(path)


@_query(
    "load_table",
    "SELECT * EXCLUDE (is_active, tenure_days) REPLACE (CAST(plan_id AS BIGINT) AS plan_id, CAST(monthly_revenue AS DOUBLE) AS monthly_revenue) FROM subs",
    text="start_date end_date",
)
def _(s: SampleStar) -> DataFrame:
    prefix = _loaded_star(s, ["subscriptions"])
    loaded = s.spark.table(f"{prefix}subscriptions")
    tables.drop_star_tables(s.spark, prefix)
    return loaded


@_query(
    "load_table_bucketed",
    """SELECT s.user_id, s.subscription_id, u.name FROM subs s JOIN users u USING (user_id)""",
)
def _(s: SampleStar) -> DataFrame:
    prefix = f"reel_{scratch_dir(s.spark, 'bucketed')[-12:]}_"
    for name, df in (("subscriptions", s.subscriptions()), ("users", s.users())):
        tables.load_table(
            df, prefix + name, bucket_cols=["user_id"], buckets=8, location=scratch_dir(s.spark, name), files_per_bucket=2
        )
    subs, users = (s.spark.table(prefix + name) for name in ("subscriptions", "users"))
    joined = subs.select("user_id", "subscription_id").join(users.select("user_id", "name"), "user_id")
    for name in ("subscriptions", "users"):
        s.spark.sql(f"DROP TABLE {prefix}{name}")
    return joined


@_query(
    "stored_views",
    """SELECT 'vw_TopWatchedTitles' AS view_name, count(DISTINCT show_id) AS rows,
              CAST(sum(watch_duration_minutes) AS DOUBLE) AS total FROM watch
       UNION ALL SELECT 'vw_RevenueByPlan', count(DISTINCT plan_id), CAST(sum(monthly_revenue) AS DOUBLE) FROM subs
       UNION ALL SELECT 'vw_UserEngagement', count(DISTINCT user_id), CAST(sum(watch_duration_minutes) AS DOUBLE) FROM watch""",
)
def _(s: SampleStar) -> DataFrame:
    prefix = _loaded_star(s, ["movies", "plans", "subscriptions", "watch"])
    totals = ["total_watch_minutes", "total_revenue", "total_watch_minutes"]
    reports = [
        s.spark.table(view).agg(F.count(F.lit(1)).alias("rows"), F.sum(total).cast("double").alias("total")).select(
            F.lit(view.removeprefix(prefix)).alias("view_name"), "rows", "total"
        )
        for view, total in zip(tables.create_kpi_views(s.spark, prefix), totals)
    ]
    tables.drop_kpi_views(s.spark, prefix)
    tables.drop_star_tables(s.spark, prefix)
    return reports[0].unionByName(reports[1]).unionByName(reports[2])


@_query(
    "register_views",
    """SELECT 'watch_enriched' AS view_name, count(*) AS rows, count(DISTINCT title) AS titles FROM fact_watch LEFT JOIN movies USING (show_id)
       UNION ALL SELECT 'subs_enriched', count(*), 0 FROM subs
       UNION ALL SELECT 'ratings_enriched', count(*), count(DISTINCT title) FROM ratings LEFT JOIN movies USING (show_id)
       UNION ALL SELECT 'dim_movies', count(*), count(DISTINCT title) FROM movies""",
)
def _(s: SampleStar) -> DataFrame:
    cleaned = {
        "movies": clean.clean_movies(s.movies(), AS_OF),
        "users": clean.clean_users(s.users()),
        "plans": s.plans(),
        "subscriptions": _clean_subs(s),
        "watch": _viewer_events(s),
        "ratings": clean.clean_ratings(s.ratings()),
    }
    tables.register_views(star_etl.star_views(cleaned))
    return s.spark.sql(
        """SELECT 'watch_enriched' AS view_name, count(*) AS rows, count(DISTINCT title) AS titles FROM watch_enriched
           UNION ALL SELECT 'subs_enriched', count(*), 0 FROM subs_enriched
           UNION ALL SELECT 'ratings_enriched', count(*), count(DISTINCT title) FROM ratings_enriched
           UNION ALL SELECT 'dim_movies', count(*), count(DISTINCT title) FROM dim_movies"""
    )


def _loaded_star(s: SampleStar, names: list[str]) -> str:
    """Load tables into the catalog under names of their own and return the prefix.

    The data lies in the shared folder, so a result that is already defined on a table
    can be read after its name was dropped.
    """
    place = scratch_dir(s.spark, "star")
    prefix = f"reel_{place[-12:]}_"
    tables.create_star_tables(s.spark, prefix, place)
    for name in names:
        df = s.tables()[name]
        df = clean.normalize_status(df) if name == "subscriptions" else df
        absent = {c.name: F.lit(None).cast(c.type) for c in schemas.TABLES[name] if c.name not in df.columns}
        tables.load_table(df.withColumns(absent) if absent else df, prefix + name)
    return prefix


@_query(
    "curated_outputs",
    """SELECT 'dim_movies' AS dataset, count(*) AS rows FROM movies UNION ALL SELECT 'dim_users', count(*) FROM users
       UNION ALL SELECT 'fact_subscriptions', count(*) FROM subs UNION ALL SELECT 'fact_watch_history', count(*) FROM fact_watch
       UNION ALL SELECT 'watch_enriched', count(*) FROM fact_watch
       UNION ALL SELECT 'kpi_top_watched_titles', least(10, count(*)) FROM (SELECT DISTINCT title, type, primary_genre FROM titled)
       UNION ALL SELECT 'kpi_popular_genres', count(DISTINCT primary_genre) FROM titled
       UNION ALL SELECT 'kpi_active_cities', count(*) FROM (SELECT DISTINCT city, country FROM fact_watch JOIN users USING (user_id))
       UNION ALL SELECT 'kpi_revenue_by_plan', count(*) FROM plans
       UNION ALL SELECT 'kpi_device_usage', count(DISTINCT device) FROM fact_watch
       UNION ALL SELECT 'kpi_top_rated_movies', least(20, count(*)) FROM (SELECT show_id FROM ratings GROUP BY show_id HAVING count(*) >= 5)
       UNION ALL SELECT 'kpi_monthly_trend', count(DISTINCT watch_month) FROM fact_watch
       UNION ALL SELECT 'kpi_user_engagement_churn', count(*) FROM engagement e LEFT JOIN (SELECT user_id FROM subs WHERE is_active) s ON s.user_id = e.user_id
       UNION ALL SELECT 'kpi_user_recommendation_genres', CAST(sum(least(5, genres)) AS BIGINT) FROM (SELECT user_id, count(DISTINCT primary_genre) AS genres FROM titled GROUP BY user_id)""",
)
def _(s: SampleStar) -> DataFrame:
    path = scratch_dir(s.spark, "curated")
    rows = star_etl.run_pipeline(s.spark, s.tables(), path, AS_OF)
    return _stored_rows({name: s.spark.read.parquet(f"{path}/{name}") for name in rows})


def _stored_rows(datasets: dict[str, DataFrame]) -> DataFrame:
    return quality.table_row_counts(datasets).withColumnRenamed("table_name", "dataset")


# The stored KPI datasets: the query with the same rows, what names a row, and a value of it.
_STORED_KPIS = {
    "kpi_top_watched_titles": ("kpi_top_watched_titles", "title type primary_genre", "total_views"),
    "kpi_popular_genres": ("kpi_popular_genres", "primary_genre", "total_minutes"),
    "kpi_active_cities": ("kpi_active_cities", "city country", "active_users"),
    "kpi_revenue_by_plan": ("kpi_revenue_by_plan", "plan_name", "avg_revenue_per_sub"),
    "kpi_device_usage": ("kpi_device_usage", "device", "avg_minutes_per_session"),
    "kpi_top_rated_movies": ("kpi_top_rated", "show_id title rank", "avg_rating"),
    "kpi_monthly_trend": ("kpi_monthly_trend", "watch_month", "unique_viewers"),
    "kpi_user_engagement_churn": ("kpi_user_engagement_churn", "user_id plan_id start_date churn_risk", "total_watch_minutes"),
    "kpi_user_recommendation_genres": ("kpi_user_top_genres_5", "user_id primary_genre genre_rank", "genre_view_count"),
}


# The other datasets: all columns of a row name it, and equal rows are counted.
_STORED_TABLES = {
    "dim_movies": (
        """SELECT *, CAST(2001 - release_year AS INT) AS content_age_years, 2001 - release_year <= 3 AS is_recent_release
           FROM (SELECT * REPLACE (trim(title) AS title, trim(primary_genre) AS primary_genre) FROM movies)""",
        "show_id type title director primary_country release_year primary_genre content_age_years is_recent_release",
    ),
    "dim_users": ("SELECT * FROM grouped_users", "user_id name age city country age_group"),
    "fact_subscriptions": (
        "SELECT * FROM subs",
        "subscription_id user_id plan_id start_date end_date status monthly_revenue is_active tenure_days",
    ),
    "fact_watch_history": (
        "SELECT * FROM fact_watch",
        "user_id show_id device watch_date watch_duration_minutes completion_pct",
    ),
    "watch_enriched": (
        """SELECT w.*, m.title, m.type, m.primary_genre, m.release_year, u.city, u.country, u.age_group, year(watch_date) AS watch_year
           FROM fact_watch w LEFT JOIN movies m USING (show_id) LEFT JOIN grouped_users u USING (user_id)""",
        """user_id show_id device watch_date watch_duration_minutes completion_pct watch_month title type primary_genre
           release_year city country age_group watch_year""",
    ),
}


def _stored_sql(kpis: dict[str, tuple[str, str, str]], tables_too: bool) -> str:
    parts = []
    for dataset, (query, keys, value) in kpis.items():
        named = " || ':' || ".join(f"coalesce(CAST({k} AS VARCHAR), '-')" for k in keys.split())
        parts.append(f"SELECT '{dataset}' AS dataset, {named} AS row_key, CAST({value} AS DOUBLE) AS value FROM ({_SQL[query]})")
    for dataset, (query, keys) in _STORED_TABLES.items() if tables_too else ():
        named = " || ':' || ".join(f"coalesce(CAST({k} AS VARCHAR), '-')" for k in keys.split())
        parts.append(f"SELECT '{dataset}', {named} AS row_key, CAST(count(*) AS DOUBLE) FROM ({query}) GROUP BY row_key")
    return "SELECT * FROM (" + " UNION ALL ".join(parts) + ")"


def _stored_contents(datasets: dict[str, DataFrame]) -> DataFrame:
    def named(keys: str) -> Column:
        return F.concat_ws(":", *[F.coalesce(F.col(k).cast("string"), F.lit("-")) for k in keys.split()]).alias("row_key")

    stored = []
    for dataset, rows in datasets.items():
        name = F.lit(dataset).alias("dataset")
        if dataset in _STORED_KPIS:
            _, keys, value = _STORED_KPIS[dataset]
            stored.append(rows.select(name, named(keys), F.col(value).cast("double").alias("value")))
        else:
            keys = rows.select(named(_STORED_TABLES[dataset][1]))
            counted = key_checks.rows_by_wide_key(keys, "row_key", scratch_dir(rows.sparkSession, "doubled"))
            stored.append(counted.select(name, "row_key", F.col("rows").cast("double").alias("value")))
    return reduce(DataFrame.unionByName, stored)


@_query("curated_contents", _stored_sql(_STORED_KPIS, True))
def _(s: SampleStar) -> DataFrame:
    path = scratch_dir(s.spark, "curated")
    rows = star_etl.run_pipeline(s.spark, s.tables(), path, AS_OF)
    return _stored_contents({name: s.spark.read.parquet(f"{path}/{name}") for name in rows})


_ROLLED = {k: v for k, v in _STORED_KPIS.items() if k in ("kpi_top_watched_titles", "kpi_popular_genres", "kpi_active_cities", "kpi_user_engagement_churn")}


@_query("curated_with_kept_rollups", _stored_sql(_ROLLED, False))
def _(s: SampleStar) -> DataFrame:
    path = scratch_dir(s.spark, "curated")
    star_etl.run_pipeline(s.spark, s.tables(), path, AS_OF, persist=True)
    return _stored_contents({name: s.spark.read.parquet(f"{path}/{name}") for name in _ROLLED})


@_query(
    "curated_release",
    f"""SELECT CAST(2 AS BIGINT) AS number, dataset, row_key, value FROM ({_stored_sql(_STORED_KPIS, True)})""",
)
def _(s: SampleStar) -> DataFrame:
    """Two runs are published; the second, with other dates, is what readers get."""
    base = scratch_dir(s.spark, "releases")
    star_etl.publish_run(s.spark, s.tables(), base, AS_OF - dt.timedelta(days=400))
    number = star_etl.publish_run(s.spark, s.tables(), base, AS_OF)
    contents = _stored_contents(releases.open_release(s.spark, base))
    return contents.select(F.lit(number).cast("bigint").alias("number"), "*")


# -- viewers from stored bitmaps -------------------------------------------------------


def _bitmaps(s: SampleStar, of_cities: bool = False) -> DataFrame:
    path = scratch_dir(s.spark, "bitmaps")
    events = _viewer_events(s)
    viewer_bitmaps.store_bitmaps(viewer_bitmaps.city_bitmaps(events, s.users()) if of_cities else viewer_bitmaps.viewer_bitmaps(events), path)
    return s.spark.read.parquet(path)


@_query("bitmap_monthly_trend", _TREND)
def _(s: SampleStar) -> DataFrame:
    return viewer_bitmaps.monthly_trend(_bitmaps(s))


@_query("bitmap_monthly_trend_of_range", f"SELECT * FROM ({_TREND}) WHERE watch_month BETWEEN '1996-03' AND '1997-02'")
def _(s: SampleStar) -> DataFrame:
    return viewer_bitmaps.monthly_trend(_bitmaps(s), "1996-03", "1997-02")


@_query(
    "bitmap_viewers_by_quarter",
    """SELECT year(watch_date) || '-Q' || quarter(watch_date) AS quarter, count(*) AS total_views,
              CAST(sum(watch_duration_minutes) AS DOUBLE) AS total_minutes, count(DISTINCT user_id) AS unique_viewers
       FROM fact_watch GROUP BY quarter""",
)
def _(s: SampleStar) -> DataFrame:
    first = F.to_date(F.concat("watch_month", F.lit("-01")))
    quarter = F.concat(F.year(first).cast("string"), F.lit("-Q"), F.quarter(first).cast("string"))
    return viewer_bitmaps.distinct_viewers(_bitmaps(s), [quarter.alias("quarter")])


@_query("bitmap_viewers_in_all", "SELECT count(*) AS total_views, CAST(sum(watch_duration_minutes) AS DOUBLE) AS total_minutes, count(DISTINCT user_id) AS unique_viewers FROM fact_watch")
def _(s: SampleStar) -> DataFrame:
    return viewer_bitmaps.distinct_viewers(_bitmaps(s))


@_query("bitmap_active_cities", _CITIES)
def _(s: SampleStar) -> DataFrame:
    return viewer_bitmaps.active_cities(_bitmaps(s, of_cities=True))


@_query(
    "bitmap_active_cities_of_range",
    """SELECT city, country, count(*) AS watch_events, count(DISTINCT user_id) AS active_users
       FROM fact_watch LEFT JOIN users USING (user_id) WHERE watch_month >= '1999-01' GROUP BY city, country""",
)
def _(s: SampleStar) -> DataFrame:
    return viewer_bitmaps.active_cities(_bitmaps(s, of_cities=True), first="1999-01", how="left")


# -- views that are kept up to date ----------------------------------------------------


def _rollups(s: SampleStar, fact: str, rows: DataFrame, late: Column) -> RollupStore:
    """A store that got most rows first and the late ones of one month afterwards."""
    store = RollupStore(s.spark, scratch_dir(s.spark, "rollups"))
    store.add(fact, rows.where(~late))
    store.add(fact, rows.where(late))
    return store


def _watch_rollups(s: SampleStar, events: DataFrame) -> RollupStore:
    return _rollups(s, "watch", events, (F.col("watch_month") == "1998-06") & F.col("device").startswith("R"))


@_query("refreshed_top_watched_titles", f"SELECT * FROM ({_SQL['vw_top_watched_titles']})")
def _(s: SampleStar) -> DataFrame:
    return _watch_rollups(s, _events(s)).vw_top_watched_titles(s.movies())


@_query("refreshed_user_engagement", f"SELECT * FROM ({_SQL['vw_user_engagement']})", text="last_watch_date")
def _(s: SampleStar) -> DataFrame:
    return _watch_rollups(s, _viewer_events(s)).vw_user_engagement()


@_query("refreshed_revenue_by_plan", f"SELECT * FROM ({_SQL['vw_revenue_by_plan']})")
def _(s: SampleStar) -> DataFrame:
    late = (F.date_format("start_date", "yyyy-MM") == "1996-01") & (F.col("status") == "Active")
    return _rollups(s, "subscriptions", _clean_subs(s), late).vw_revenue_by_plan(s.plans())


@_query(
    "refreshed_engagement_of_a_year",
    """SELECT user_id, count(*) AS total_sessions, CAST(sum(watch_duration_minutes) AS DOUBLE) AS total_watch_minutes,
              max(watch_date) AS last_watch_date FROM fact_watch WHERE year(watch_date) = 1998 GROUP BY user_id""",
    text="last_watch_date",
)
def _(s: SampleStar) -> DataFrame:
    return _watch_rollups(s, _viewer_events(s)).vw_user_engagement(since="1998-01", until="1998-12")


@_query(
    "refreshed_stored_views",
    """SELECT 'vw_TopWatchedTitles' AS view_name, count(DISTINCT show_id) AS rows,
              CAST(sum(watch_duration_minutes) AS DOUBLE) AS total FROM fact_watch
       UNION ALL SELECT 'vw_RevenueByPlan', count(DISTINCT plan_id), CAST(sum(monthly_revenue) AS DOUBLE) FROM subs
       UNION ALL SELECT 'vw_UserEngagement', count(DISTINCT coalesce(user_id, -1)), CAST(sum(watch_duration_minutes) AS DOUBLE) FROM fact_watch""",
)
def _(s: SampleStar) -> DataFrame:
    """The catalog's views over the sums. A batch that comes after their creation is seen, too."""
    prefix = _loaded_star(s, ["movies", "plans"])
    events, subs = _viewer_events(s), _clean_subs(s)
    store = _watch_rollups(s, events.where("watch_month <> '2000-02' OR watch_month IS NULL"))
    store.add("subscriptions", subs)
    store.create_views(prefix)
    store.add("watch", events.where("watch_month = '2000-02'"))
    totals = {"vw_TopWatchedTitles": "total_watch_minutes", "vw_RevenueByPlan": "total_revenue", "vw_UserEngagement": "total_watch_minutes"}
    reports = [
        s.spark.table(view).agg(F.count(F.lit(1)).alias("rows"), F.sum(totals[view.removeprefix(prefix)]).cast("double").alias("total")).select(
            F.lit(view.removeprefix(prefix)).alias("view_name"), "rows", "total"
        )
        for view in store.create_views(prefix)
    ]
    # The tables of the sums are partitioned in the catalog, so they must be there while they are read.
    path = scratch_dir(s.spark, "view-totals")
    reduce(DataFrame.unionByName, reports).write.parquet(path)
    store.drop_views(prefix)
    tables.drop_star_tables(s.spark, prefix)
    return s.spark.read.parquet(path)


# -- layout, keys, quarantine, quantiles -----------------------------------------------


@_query("clustered_watch", _WATCH_ENRICHED.format(more=", CAST(year(w.watch_date) AS BIGINT) AS watch_year"), text="watch_date")
def _(s: SampleStar) -> DataFrame:
    enriched = clean.add_watch_year(enrich.watch_enriched(_viewer_events(s), s.movies(), _grouped_users(s)))
    path = scratch_dir(s.spark, "watch-clustered")
    write_clustered(enriched, path, ["user_id", "show_id", "watch_date"], ["watch_year"], files=24)
    return s.spark.read.parquet(path)


@_query("duplicate_keys_of_two", f"SELECT * FROM ({_SQL['dq_primary_key']})")
def _(s: SampleStar) -> DataFrame:
    return key_checks.duplicate_keys(s.parquet("lineitem"), ["l_orderkey", "l_linenumber"])


@_query("duplicate_ids", "SELECT o_custkey, count(*) AS rows FROM orders GROUP BY o_custkey HAVING count(*) > 1 OR o_custkey IS NULL")
def _(s: SampleStar) -> DataFrame:
    return key_checks.duplicate_keys(s.parquet("orders"), "o_custkey")


def _orphan_sql() -> str:
    views = {"movies": "movies", "users": "users", "plans": "plans", "subscriptions": "raw_subs", "watch": _MOVED_WATCH, "ratings": "all_ratings"}
    return " UNION ALL ".join(
        f"""SELECT '{child}' AS child, '{key}' AS key, '{parent}' AS parent, CAST({key} AS VARCHAR) AS value, count(*) AS rows
            FROM {views[child]} WHERE {key} IS NOT NULL AND {key} NOT IN (SELECT {key} FROM {views[parent]}) GROUP BY {key}"""
        for child, key, parent in schemas.FOREIGN_KEYS
    )


@_query("orphan_keys", _orphan_sql())
def _(s: SampleStar) -> DataFrame:
    return key_checks.orphan_keys(s.tables() | {"watch": _moved(_viewer_events(s))}, schemas.FOREIGN_KEYS)


_RULES = {
    "not null: director": "director IS NULL",
    "not null: title": "title IS NULL",
    "max length: title": "octet_length(encode(title)) > 30",
    "max length: primary_genre": "length(primary_genre) > 20",
    "check: release_year < 1990": "NOT release_year < 1990",
}


def _ruled_movies(s: SampleStar) -> DataFrame:
    movies = s.movies()
    rules = quarantine.row_rules(
        movies,
        required=["director", "title", "absent"],
        max_lengths={"title": quality.TextLimit(30, "bytes"), "primary_genre": quality.TextLimit(20, "utf16")},
        checks=["release_year < 1990", "absent > 3"],
    )
    path = scratch_dir(s.spark, "quarantine")
    quarantine.write_with_quarantine(movies, rules, path)
    return s.spark.read.parquet(path)


@_query(
    "quarantined_rows",
    f"""SELECT show_id, title, concat_ws('; ', {", ".join(f"CASE WHEN {broken} THEN '{name}' END" for name, broken in _RULES.items())}) AS broken
        FROM movies WHERE {" OR ".join(_RULES.values())}""",
)
def _(s: SampleStar) -> DataFrame:
    written = _ruled_movies(s)
    return quarantine.read_quarantine(written).select("show_id", "title", F.concat_ws("; ", quarantine.BROKEN).alias("broken"))


@_query(
    "quarantine_counts",
    " UNION ALL ".join(f"SELECT '{name}' AS rule, count(*) AS rows FROM movies WHERE {broken} HAVING count(*) > 0" for name, broken in _RULES.items())
    + f" UNION ALL SELECT 'accepted', count(*) FROM movies WHERE NOT ({' OR '.join(f'coalesce({b}, false)' for b in _RULES.values())})",
)
def _(s: SampleStar) -> DataFrame:
    written = _ruled_movies(s)
    accepted = quarantine.read_accepted(written).agg(F.lit("accepted").alias("rule"), F.count(F.lit(1)).alias("rows"))
    return quarantine.broken_rule_counts(quarantine.read_quarantine(written)).unionByName(accepted)


@_query(
    "avg_watch_per_user_in_two_scans",
    f"SELECT * FROM ({_SQL['kpi_avg_watch_per_user']})",
)
def _(s: SampleStar) -> DataFrame:
    totals = kpi.vw_user_engagement(_viewer_events(s)).where("user_id IS NOT NULL")
    found = order_stats.exact_quantiles(totals, "total_watch_minutes", [0.5], digits=1)
    return found.select(F.col("n").alias("viewers"), F.col("mean").alias("mean_watch_minutes"), F.col("quantile").alias("median_watch_minutes"))


@_query(
    "watch_duration_quantiles",
    """SELECT CAST(share AS DOUBLE) AS share, max(n) AS n,
              floor(sum(CASE WHEN k = low AND k = high THEN u WHEN k = low THEN u * (1 - part) WHEN k = high THEN u * part END) * 10 + 0.5) / 100 AS quantile
       FROM (SELECT *, floor(share * (n - 1)) AS low, ceil(share * (n - 1)) AS high, share * (n - 1) - floor(share * (n - 1)) AS part
             FROM (SELECT CAST(watch_duration_minutes * 10 AS BIGINT) AS u, row_number() OVER (ORDER BY watch_duration_minutes) - 1 AS k, count(*) OVER () AS n
                   FROM fact_watch), (VALUES (0.0::DECIMAL(3,2)), (0.1), (0.25), (0.5), (0.75), (0.99), (1)) q(share))
       GROUP BY share""",
)
def _(s: SampleStar) -> DataFrame:
    shares_ = [0, 0.1, 0.25, 0.5, 0.75, 0.99, 1]
    return order_stats.exact_quantiles(_events(s), "watch_duration_minutes", shares_, digits=2).drop("mean")


# -- driver contract -----------------------------------------------------------------


def entry(spark: SparkSession) -> DataFrame:
    return queries()["kpi_top_watched_titles"](spark, SMOKE_DIR)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return _QUERIES | _text_queries()[0]


def oracle_sql() -> dict[str, str]:
    return _SQL | _text_queries()[1]


def _text_queries() -> tuple[dict[str, Callable[[SparkSession, str], DataFrame]], dict[str, str]]:
    """Queries and SQL of the text operators and their pipeline, where these are installed."""
    try:
        import corpus_pipeline
        from reelmetrics.llm import queries as text
    except ModuleNotFoundError as e:
        if e.name not in ("corpus_pipeline", "reelmetrics.llm"):
            raise
        return {}, {}
    sql = {"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {}
    return text.QUERIES | {"pipeline": corpus_pipeline.run}, text.ORACLE_SQL | sql
