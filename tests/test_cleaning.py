"""Raw text to clean rows."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from seriesprep.functions import scalars as fn
from seriesprep.operators import cleaning as op
from seriesprep.plans.preprocess import preprocess, preprocess_file
from seriesprep.operators.validate import passed, validation_summary
from seriesprep.sources import io
from seriesprep.spec import SeriesSpec, safe_names

SPEC = SeriesSpec(ts="timestamp", targets=("co_gt", "nox_gt"), features=("pt08_s1_co", "t"), layout="direct")

RAW = """Date;Time; CO(GT) ;NOx(GT);PT08.S1(CO);T;Note;;
10/03/2004;20.00.00;2,2;103;1402;11,9;ok;;
10/03/2004;18.00.00;2,6;166;-200;13,6;ok;;
10/03/2004;19.00.00;2;-200;1292;13,3;ok;;
31/02/2004;19.00.00;9;9;9;9;bad;;
;;;;;;;;
10/03/2004;20.00.00;9,9;999;9999;99,9;again;;
10/03/2004;23.00.00;-200;-200;1197;NaN;gap;;
11/03/2004;00.00.00;NA;x;1185;11,2;odd;;
"""


@pytest.fixture(scope="module")
def raw_path(tmp_path_factory):
    path = tmp_path_factory.mktemp("raw") / "raw.csv"
    path.write_text(RAW)
    return str(path)


def rows(df, *cols):
    return [tuple(r) for r in df.orderBy(*cols).collect()]


def test_read_delimited_keeps_text_and_nulls_tokens(spark, raw_path):
    raw = io.read_delimited(spark, raw_path)
    assert raw.count() == 8
    df, empty = io.drop_empty_columns(raw)
    assert len(empty) == 2 and all(e.startswith("Unnamed") for e in empty)
    df, mapping = io.normalize_names(df, safe=True)
    assert df.columns == ["date", "time", "co_gt", "nox_gt", "pt08_s1_co", "t", "note"]
    assert mapping[" CO(GT) "] == "co_gt"
    assert df.filter("t is null").count() == 2


def test_preprocess_chain_and_report(spark, raw_path):
    done = preprocess_file(spark, raw_path, SPEC, safe=True, impute="ffill")
    got = rows(done.table.drop("note"), "timestamp")
    day = datetime(2004, 3, 10)
    assert got == [
        (day.replace(hour=18), 2.6, 166.0, None, 13.6),  # a leading null stays
        (day.replace(hour=19), 2.0, None, 1292.0, 13.3),
        (day.replace(hour=20), 2.2, 103.0, 1402.0, 11.9),  # first of two rows
        (day.replace(hour=23), None, None, 1197.0, 11.9),
        (datetime(2004, 3, 11), None, None, 1185.0, 11.2),
    ]
    report = {(r["phase"], r["column"], r["metric"]): r["value"] for r in done.report.collect()}
    assert report["timestamp", None, "rows_before"] == 8
    assert report["timestamp", None, "rows_bad_timestamp"] == 2
    assert report["timestamp", None, "duplicates_removed"] == 1
    assert report["sentinel", "pt08_s1_co", "replaced"] == 1
    assert report["sentinel", "nox_gt", "replaced"] == 2
    assert report["imputation", "t", "filled"] == 1
    assert report["summary", None, "rows_final"] == 5
    assert report["summary", "co_gt", "target_known"] == 3
    assert done.non_numeric_columns == ["note"] and "t" in done.coerced_columns


def test_preprocess_can_drop_rows_without_targets(spark, raw_path):
    done = preprocess_file(spark, raw_path, SPEC, safe=True, drop_missing_targets=True)
    assert done.table.count() == 3
    assert {r["value"] for r in done.report.filter("metric = 'rows_dropped'").collect()} == {2}


def test_fill_options_agree(spark, raw_path):
    a = preprocess_file(spark, raw_path, SPEC, safe=True, impute="ffill").table
    b = preprocess_file(spark, raw_path, SPEC, safe=True, impute="ffill+rolling").table
    assert rows(a, "timestamp") == rows(b, "timestamp")


def test_clean_table_passes_and_faults_are_caught(spark, raw_path):
    raw, _ = io.normalize_names(io.drop_empty_columns(io.read_delimited(spark, raw_path))[0], safe=True)
    clean = preprocess(raw, SPEC, date="date", time="time").table

    def check(df, **options):
        out = validation_summary(raw, df, SPEC, date="date", time="time", **options)
        return passed(out), {(r["check"], r["column"]) for r in out.filter("status = 'fail'").collect()}

    assert check(clean) == (True, set())
    assert check(clean.drop("t")) == (False, {("column_present", "t")})
    assert check(clean.union(clean))[1] >= {("unique_times", "timestamp")}
    assert check(clean.fillna(-200.0, ["nox_gt"])) == (False, {("sentinel", "nox_gt")})
    assert check(clean.withColumn("co_gt", F.col("co_gt") + 0.1)) == (False, {("drift", "co_gt")})
    moved = clean.withColumn("t", F.col("t") + 1)
    assert check(moved) == (False, {("drift", "t")})
    assert check(moved, allow_imputation=True)[0]
    assert check(moved, rtol=0.2)[0]
    lost = clean.withColumn("co_gt", F.lit(None).cast("double"))
    assert check(lost)[0]  # a missing clean value is no drift
    later = clean.withColumn("timestamp", F.col("timestamp") + F.expr("INTERVAL '900' DAY"))
    assert ("common_times", "timestamp") in check(later)[1]


def test_dedup_takes_the_first_of_any_number_of_copies(spark):
    df = spark.range(1000).select(
        (F.col("id") % 3).alias("k"), F.lit(datetime(2024, 1, 1)).cast("timestamp_ntz").alias("ts"),
        (1000 - F.col("id")).alias("seq"), F.when(F.col("id") % 7 == 0, F.col("id")).alias("v"))
    out = op.dedup_first(df, SeriesSpec(ts="ts", by=("k",), tiebreak=("seq",)))
    assert out.columns == df.columns
    assert rows(out.select("k", "seq", "v"), "k") == [(0, 1, None), (1, 3, None), (2, 2, None)]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "partial_min" in plan


def test_dedup_keeps_null_keys(spark):
    df = spark.createDataFrame([(None, 1, 5), (None, 1, 3), ("x", 1, 4)], "k string, ts int, seq int")
    out = op.dedup_first(df, SeriesSpec(ts="ts", by=("k",), tiebreak=("seq",)))
    assert rows(out, "k") == [(None, 1, 3), ("x", 1, 4)]


@pytest.mark.parametrize("text,number", [
    (" 2,6 ", 2.6), ("1360", 1360.0), ("-200", -200.0), ("1e3", 1000.0), (".5", 0.5), ("nan", None), ("1d", None),
    ("0x10", None), ("", None), ("1 2", None), ("-inf", float("-inf")), (None, None),
])
def test_to_number(spark, text, number):
    got = spark.createDataFrame([(text,)], "s string").select(fn.to_number(F.col("s"))).first()[0]
    assert got == number


def test_bins_differ_at_the_edges(spark):
    df = spark.createDataFrame([(1.4,), (1.5,), (2.5,), (2.6,), (None,)], "v double")
    left = [r[0] for r in df.select(fn.bin_left_closed(F.col("v"), (1.5, 2.5))).collect()]
    right = [r[0] for r in df.select(fn.bin_right_closed(F.col("v"), (1.5, 2.5))).collect()]
    assert left == [0, 1, 2, 2, None] and right == [0, 0, 1, 2, None]


def test_names_with_dots(spark):
    df = spark.createDataFrame([(1.0, -200.0)], ["PT08.S1(CO)", "CO(GT)"])
    out = op.sentinel_to_null(df)
    assert tuple(out.first()) == (1.0, None)
    assert safe_names(["PT08.S1(CO)", "CO(GT)", "T", "t "]) == {
        "PT08.S1(CO)": "pt08_s1_co", "CO(GT)": "co_gt", "T": "t", "t ": "t_2"}


def test_interactions_need_their_inputs(spark):
    df = spark.createDataFrame([(2.0, None)], "a double, b double")
    assert fn.interactions(df, {"ab": ("a", "b")}).first()["ab"] is None
    with pytest.raises(ValueError):
        fn.interactions(df, {"ac": ("a", "c")})


def test_feature_columns(spark):
    df = spark.createDataFrame([(1, 2, 3, 4)], ["ts", "CO(GT)", "hour", "y"])
    assert op.feature_columns(df, ["ts", "y"]) == ["CO(GT)", "hour"]
    assert op.feature_columns(df, ["ts", "y"], tokens=["T"]) == ["CO(GT)"]
    assert op.feature_columns(df, ["ts", "y"], tokens=["zz"]) == ["CO(GT)", "hour"]
    with pytest.raises(ValueError):
        op.feature_columns(df, columns=["hour", "gone"])


def test_write_and_read_table(spark, tmp_path):
    times = [datetime(2024, 1, 1, h) for h in range(20)]
    df = spark.createDataFrame([(t, float(t.hour)) for t in times] * 2, "timestamp timestamp_ntz, v double")
    spec = SeriesSpec(ts="timestamp")
    paths = io.write_table(df, str(tmp_path / "t"), "both", spec)
    assert [p.rsplit(".", 1)[1] for p in paths] == ["parquet", "csv"]
    for path in (*paths, str(tmp_path / "t")):
        back = io.read_table(spark, path, spec)
        assert rows(back, "timestamp") == [(t, float(t.hour)) for t in times]
    with pytest.raises(ValueError):
        io.write_table(df, str(tmp_path / "t"), "xls")
    with pytest.raises(FileNotFoundError):
        io.read_table(spark, str(tmp_path / "absent"), spec)
    with pytest.raises(ValueError):
        io.prepare_table(df, SeriesSpec(ts="when"))


def test_nan_becomes_null_on_read(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 1), float("nan"))], "timestamp timestamp_ntz, v double")
    assert io.prepare_table(df, SeriesSpec()).first()["v"] is None


def test_header_with_quotes_and_repeats(spark, tmp_path):
    from seriesprep.sources.io import read_delimited

    (tmp_path / "t.csv").write_text('"a;b";c;c;;c\n1;2;3;4;5\n')
    df = read_delimited(spark, str(tmp_path / "t.csv"))
    assert df.columns == ["a;b", "c", "c.1", "Unnamed: 3", "c.2"] and tuple(df.first()) == ("1", "2", "3", "4", "5")
