"""Sieved duplicates, foreign keys in one scan, the quarantine, and quantiles from brackets."""

import random
import re
import statistics
from collections import Counter
from decimal import Decimal
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from reelmetrics.operators import key_checks, order_stats, quality, quarantine
from reelmetrics.operators.quality import TextLimit
from reelmetrics.sources import schemas
from reelmetrics.sources.sample_star import SampleStar

SF_DIR = "/root/testdata/sf0.001"


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def _exchanges(df):
    text = df._jdf.queryExecution().executedPlan().toString().split("+- == Initial Plan ==")[0]
    return text.count("Exchange hashpartitioning")


# -- duplicates --------------------------------------------------------------------------


IDS = [1, 2, 2, 2, None, None, 0, -1, -1, 32768, 32769, 32769, 65537, 2**62, 2**62, -(2**62), 5, 6, 7]


@pytest.mark.parametrize("sieve", ["ids", "hash", None])
def test_duplicate_ids(spark, sieve):
    df = spark.createDataFrame([(i, "x") for i in IDS], "id bigint, t string").repartition(4)
    assert _rows(key_checks.duplicate_keys(df, "id", sieve)) == _rows(quality.dq_primary_key(df, "id"))


def test_duplicates_of_several_columns(spark):
    rng = random.Random(1)
    rows = [(rng.choice([None, "a", "b", ""]), rng.choice([None, *range(30)]), 1) for _ in range(80)]
    df = spark.createDataFrame(rows, "a string, b int, _sieve2 int")
    assert _rows(key_checks.duplicate_keys(df, ["a", "b"])) == _rows(quality.dq_primary_key(df, ["a", "b"]))
    assert key_checks.duplicate_keys(df.limit(0), ["a", "b"]).collect() == []
    with pytest.raises(ValueError):
        key_checks.duplicate_keys(df, ["a", "b"], "ids")


def test_the_sieve_passes_candidates_only(spark):
    """Two doubled ids among a million: a few ranges of ids are grouped, the others end as bitmaps."""
    df = spark.range(0, 1_000_000, 1, 8).union(spark.createDataFrame([(17,), (700_000,)], "id bigint"))
    assert _rows(key_checks._doubled_ranges(df, "id")) == _rows(spark.sql("SELECT bitmap_bucket_number(id) FROM VALUES 17L, 700000L t(id)"))
    assert _rows(key_checks.duplicate_keys(df, "id")) == [(17, 2), (700_000, 2)]


@pytest.mark.parametrize("few", [100, 0])
def test_wide_keys_are_counted_behind_a_sieve(spark, tmp_path, few):
    """Texts that occur once are not grouped; with too many hashes to broadcast, all are."""
    texts = [f"text {i}" for i in range(500)] + ["text 7", "text 7", "", "", None, None, "only"]
    df = spark.createDataFrame([(t,) for t in texts], "row_key string")
    got = key_checks.rows_by_wide_key(df, "row_key", str(tmp_path / "doubled"), few)
    assert _rows(got) == sorted(Counter(texts).items(), key=repr)
    assert spark.read.parquet(str(tmp_path / "doubled")).count() == 3
    assert ("LeftAnti" in got._jdf.queryExecution().optimizedPlan().toString()) == (few > 0)


# -- foreign keys ------------------------------------------------------------------------


def test_orphans_of_all_rules(spark):
    star = SampleStar(spark, SF_DIR)
    moved = star.watch().withColumn("show_id", F.col("show_id") + 150).cache()
    data = star.tables() | {"watch": moved}
    got = key_checks.orphan_keys(data, schemas.FOREIGN_KEYS)
    want = []
    for child, key, parent in schemas.FOREIGN_KEYS:
        found = quality.dq_foreign_key(data[child], data[parent], key).collect()
        want += [(child, key, parent, str(r[0]), r[1]) for r in found]
    assert want and _rows(got) == sorted(want, key=repr)
    moved.unpersist()


def test_each_table_is_read_once(spark, tmp_path):
    frames = {}
    for name, columns in {"movies": "show_id", "users": "user_id", "plans": "plan_id", "subscriptions": "user_id plan_id", "watch": "user_id show_id", "ratings": "user_id show_id"}.items():
        spark.range(5).select(*[F.col("id").alias(c) for c in columns.split()]).write.parquet(str(tmp_path / name))
        frames[name] = spark.read.parquet(str(tmp_path / name))
    plan = key_checks.orphan_keys(frames, schemas.FOREIGN_KEYS)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 6


def test_odd_keys(spark):
    child = spark.createDataFrame([("1", 1), ("1", None), ("x", 2), (None, 7), ("2", 9)], "a string, b int")
    parent = spark.createDataFrame([(1,), (2,), (None,), (2,)], "id bigint")
    got = key_checks.orphan_keys({"c": child, "p": parent}, [("c", "b", "p"), ("c", "b", "p"), ("c", "no", "p"), ("d", "b", "p")], {"p": "id"})
    assert _rows(got) == [("c", "b", "p", "7", 1), ("c", "b", "p", "9", 1)]
    with pytest.raises(ValueError):
        key_checks.orphan_keys({"c": child}, [("c", "b", "p")])


def test_a_map_task_holds_narrow_keys(spark):
    """Of a key that is counted only its rule's number and its value are held; names are added to orphans."""
    child = spark.createDataFrame([(1, 5), (2, 5), (None, 9)], "a bigint, b int")
    parent = spark.createDataFrame([(1, 7)], "id int, code bigint")
    rules = [("c", "a", "p"), ("c", "b", "q")]
    found = key_checks.orphan_keys({"c": child, "p": parent, "q": parent}, rules, {"p": "id", "q": "code"})
    assert _rows(found) == [("c", "a", "p", "2", 1), ("c", "b", "q", "5", 2), ("c", "b", "q", "9", 1)]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    (keys,) = re.findall(r"Aggregate \[(.*?)\], \[", plan)
    assert [re.sub(r"#\d+L?", "", k) for k in keys.split(", ")] == ["rule", "value"]
    mixed = key_checks.orphan_keys(
        {"c": spark.createDataFrame([(1, "01"), (3, "x")], "a bigint, t string"), "p": parent, "q": spark.createDataFrame([("x",)], "t string")},
        [("c", "a", "p"), ("c", "t", "q")], {"p": "id"},
    )
    assert _rows(mixed) == [("c", "a", "p", "3", 1), ("c", "t", "q", "01", 1)]


# -- quarantine --------------------------------------------------------------------------


def test_quarantine_agrees_with_the_report(spark, tmp_path):
    rows = [("s1", "Movie", "T", Decimal("1.00")), (None, "Movie", None, Decimal("1.234")), ("s" * 20, "é" * 6, "ok", None), ("s4", None, "\U0001f4fa" * 101, Decimal("99999999.99"))]
    df = spark.createDataFrame(rows, "show_id string, type string, title string, monthly_price decimal(12,3)")
    rules = quarantine.row_rules(df, schemas.REQUIRED["movies"], schemas.MAX_LENGTHS["movies"], {"monthly_price": "decimal(8,2)"}, ["length(title) < 50", "no > 1"])
    counts = quarantine.write_with_quarantine(df, rules, str(tmp_path / "q"))
    written = spark.read.parquet(str(tmp_path / "q"))
    report = quality.constraint_report(
        {"movies": df}, {}, [], {"movies": "length(title) < 50"}, schemas.REQUIRED, schemas.MAX_LENGTHS, {"movies": {"monthly_price": "decimal(8,2)"}}
    ).where("violations IS NOT NULL").collect()
    assert {f"{r.rule}: {r.column_name}": r.violations for r in report} == {k: v for k, v in counts.items() if ": " in k}
    assert (counts["accepted"], counts["quarantine"]) == (1, 3)
    assert _rows(quarantine.read_accepted(written)) == _rows(df.limit(1))
    aside = {r.title: r.broken_rules for r in quarantine.read_quarantine(written).collect()}
    assert aside == {
        None: ["not null: show_id", "not null: title", "decimal: monthly_price"],
        "ok": ["max length: show_id", "max length: type"],
        "\U0001f4fa" * 101: ["not null: type", "max length: title", "decimal: monthly_price", "check: length(title) < 50"],
    }
    broken = {r["rule"]: r["rows"] for r in quarantine.broken_rule_counts(quarantine.read_quarantine(written)).collect()}
    assert broken == {k: v for k, v in counts.items() if ": " in k and v}


def test_more_rules_than_a_bitmap_holds(spark, tmp_path):
    df = spark.range(150).select("id")
    rules = [quarantine.Rule("check", f"id <> {k}", F.col("id") == k) for k in range(0, 140, 2)]
    assert len(rules) > quarantine.RULES_PER_BITMAP
    counts = quarantine.write_with_quarantine(df, rules, str(tmp_path / "q"))
    assert (counts["accepted"], counts["quarantine"]) == (80, 70)
    aside = quarantine.read_quarantine(spark.read.parquet(str(tmp_path / "q"))).collect()
    assert {r.id: r.broken_rules for r in aside} == {k: [f"check: id <> {k}"] for k in range(0, 140, 2)}
    assert quarantine.write_with_quarantine(df, [], str(tmp_path / "none")) == {"accepted": 150, "quarantine": 0}
    with pytest.raises(ValueError):
        quarantine.marked(df.withColumn("row_state", F.lit(1)), rules)


# -- lengths -----------------------------------------------------------------------------


def test_lengths_in_declared_units(spark):
    df = spark.createDataFrame([("a\U0001f4fa",), ("é",), (None,), ("",)], "t string")
    for unit, longest in (("characters", 2), ("bytes", 5), ("utf16", 3)):
        assert _rows(quality.dq_max_length(df, {"t": TextLimit(2, unit)})) == [("t", 2, longest, int(longest > 2))]
    assert schemas.MAX_LENGTHS["movies"]["title"] == (200, "utf16")
    assert schemas.MAX_LENGTHS["movies"]["show_id"] == (10, "bytes")
    with pytest.raises(ValueError):
        quality.text_length(F.col("t"), "words")


# -- quantiles ---------------------------------------------------------------------------


def _quantile(values, share):
    values = sorted(values)
    place = Fraction(str(share)) * (len(values) - 1)
    low, rest = divmod(place, 1)
    high = min(low + 1, len(values) - 1)
    return values[low] + (values[high] - values[low]) * rest


def _half_up(x, digits):
    sign = 1 if x >= 0 else -1
    return sign * Fraction(int(abs(x) * 10**digits + Fraction(1, 2)), 10**digits)


@pytest.mark.parametrize("n", [1, 2, 3, 10, 101, 5000])
@pytest.mark.parametrize("accuracy", [20, 10_000])
def test_quantiles(spark, n, accuracy):
    rng = random.Random(n)
    values = [Decimal(rng.choice([-5, 0, 3, rng.randrange(-10**6, 10**6)])) / 10 for _ in range(n)]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v decimal(12,1)").repartition(5)
    shares = [0, 0.01, 0.25, Decimal("0.333"), 0.5, 0.9, 1]
    got = {r.share: r for r in order_stats.exact_quantiles(df, "v", shares, digits=2, accuracy=accuracy).collect()}
    assert len(got) == 7
    for share in shares:
        r = got[Decimal(str(share)).quantize(Decimal(1).scaleb(-17))]
        assert Fraction(r["quantile"]) == _half_up(_quantile([Fraction(v) for v in values], share), 2)
        assert r.n == n and Fraction(r["mean"]) == _half_up(Fraction(sum(map(Fraction, values)), n), 2)


def test_median_as_before(spark):
    df = spark.range(1, 1001).select((F.col("id") * F.col("id")).alias("v"))
    (old,) = order_stats.mean_and_median(df, "v", digits=1).collect()
    (new,) = order_stats.exact_quantiles(df, "v", [0.5]).collect()
    assert (new.n, new["mean"], new["quantile"]) == (old.n, old["mean"], old["median"])
    assert float(new["quantile"]) == statistics.median(i * i for i in range(1, 1001))


def test_quantiles_of_nothing(spark):
    df = spark.createDataFrame([(None,)], "v int")
    assert [tuple(r)[1:] for r in order_stats.exact_quantiles(df, "v", [0.5, 1]).collect()] == [(0, None, None)] * 2
    with pytest.raises(ValueError):
        order_stats.exact_quantiles(df, "v", [1.5])
    with pytest.raises(TypeError):
        order_stats.exact_quantiles(df.withColumn("v", F.col("v").cast("double")), "v")


def test_two_scans(spark, tmp_path):
    spark.range(1000).write.parquet(str(tmp_path / "v"))
    df = spark.read.parquet(str(tmp_path / "v"))
    found = order_stats.exact_quantiles(df, "id", [0.1, 0.5, 0.9])
    assert len(found.collect()) == 3
    # The summary is one subquery, used twice.
    text = found._jdf.queryExecution().executedPlan().toString()
    final = text.split("+- == Initial Plan ==")[0]
    assert final.count("FileScan parquet") <= 3
