import pytest
from pyspark.sql import functions as F

from ledgerline import ValidationError
from ledgerline.operators.checks import (
    cast_features,
    check_rows,
    invalid_row_report,
    invalid_rows,
    row_validation_errors,
    validated_cast,
)
from groups_for_tests import READINGS

NAMES = [name for name, _ in READINGS.features]
TEXTS = ", ".join(f"`{n}` string" for n in NAMES)
SOUND = {"station": "N-4", "measured-at": "1699000000.5", "sky": "grey", "gusts": "12",
         "rain mm": "0.25"}
NAN = float("nan")


def readings(spark, *changes, columns=NAMES):
    """One sound reading per entry, with the values of the entry instead."""
    rows = [tuple({**SOUND, **c}[n] for n in columns) for c in changes]
    return spark.createDataFrame(rows, ", ".join(f"`{n}` string" for n in columns))


def errors(df):
    return [r[1] for r in row_validation_errors(df, READINGS).collect()]


def faults(*names):
    return ",".join(f"{n} not valid" for n in names)


def test_texts_become_the_declared_types(spark):
    # The order of the input stays, whatever order the features are declared in.
    out = validated_cast(readings(spark, {}, columns=NAMES[::-1]), READINGS)
    assert out.dtypes == [("rain mm", "double"), ("gusts", "bigint"), ("sky", "string"),
                          ("measured-at", "double"), ("station", "string")]
    assert tuple(out.first()) == (0.25, 12, "grey", 1699000000.5, "N-4")


NAME_FAULTS = {
    "a forbidden character": (["station", "measured-at", "gusts(max)"], "Invalid char"),
    "a reserved name": (["station", "measured-at", "write_time"], "reserved feature name"),
    "an unknown column": (["station", "measured-at", "snow"], "unknown columns: 'snow'"),
    "no identifier": (["measured-at", "sky"], "Missing feature names 'station'"),
    "no event time": (["station", "sky"], "Missing feature names 'measured-at'"),
    "an unknown column besides": (["station", "measured-at", "sky", "Sky2"], "Sky2"),
}


@pytest.mark.parametrize("case", NAME_FAULTS)
def test_faulty_names_refuse_the_frame_before_any_row(spark, case):
    names, message = NAME_FAULTS[case]
    empty = spark.createDataFrame([], ", ".join(f"`{n}` string" for n in names))
    with pytest.raises(ValidationError, match=message) as caught:
        validated_cast(empty, READINGS)
    assert caught.value.report == [] and caught.value.total == 0


ROW_FAULTS = {
    "identifier absent": ({"station": None}, ["station"]),
    "identifier reads as NaN": ({"station": " nan"}, ["station"]),
    "event time absent": ({"measured-at": None}, ["measured-at"]),
    "event time no number": ({"measured-at": "noon"}, ["measured-at"]),
    "event time NaN": ({"measured-at": "NaN"}, ["measured-at"]),
    "event time without end": ({"measured-at": "-Infinity"}, ["measured-at"]),
    "whole number in words": ({"gusts": "twelve"}, ["gusts"]),
    "whole number with exponent": ({"gusts": "1e1"}, ["gusts"]),
    "fraction in words": ({"rain mm": "none"}, ["rain mm"]),
    "fraction NaN": ({"rain mm": "nan"}, ["rain mm"]),
    "text NaN": ({"sky": "NAN"}, ["sky"]),
    "two faults": ({"rain mm": "?", "station": None}, ["station", "rain mm"]),
    "all faults": (dict(zip(NAMES, [None, "x", "NaN", "x", "x"])), NAMES),
}
ROW_SOUND = {
    "optional features absent": {"sky": None, "gusts": None, "rain mm": None},
    "digits after the point are dropped": {"gusts": "12.9"},
    "no end to the rain": {"rain mm": "inf"},
    "empty text": {"sky": ""},
    "NaN within a text": {"sky": "nano"},
}


def test_each_fault_is_found_and_named_in_declared_order(spark):
    given = readings(spark, *[change for change, _ in ROW_FAULTS.values()])
    assert errors(given) == [faults(*names) for _, names in ROW_FAULTS.values()]
    for change, names in list(ROW_FAULTS.values())[::6]:
        with pytest.raises(ValidationError, match="records values equal to NaN") as caught:
            validated_cast(readings(spark, {}, change), READINGS)
        assert [r[1] for r in caught.value.report] == [faults(*names)]


def test_sound_rows_have_no_fault(spark):
    given = readings(spark, {}, *ROW_SOUND.values())
    assert errors(given) == [""] * (1 + len(ROW_SOUND))
    cast = {r["sky"]: r for r in validated_cast(given, READINGS).collect()}
    assert cast["nano"]["gusts"] == 12 and cast[None]["rain mm"] is None
    assert sorted(r["gusts"] or 0 for r in validated_cast(given, READINGS).collect()) == [
        0, 12, 12, 12, 12, 12,
    ]


def test_numbers_as_input(spark):
    df = spark.createDataFrame(
        [("a", 1.5, -3.99, 7), ("b", NAN, NAN, 7), ("c", float("inf"), 1e20, None)],
        "station string, `measured-at` double, gusts double, `rain mm` int",
    )
    assert errors(df) == ["", faults("measured-at", "gusts"), faults("measured-at")]
    assert [tuple(r)[2:] for r in cast_features(df, READINGS).collect()] == [
        (-3, 7.0), (0, 7.0), (2**63 - 1, None)
    ]


def test_decimals_as_input(spark):
    df = spark.sql(
        "select 'a' as station, cast(1699000000 as decimal(12,0)) as `measured-at`, "
        "cast('12.90' as decimal(6,2)) as gusts, cast('0.125' as decimal(6,3)) as `rain mm`"
    )
    assert errors(df) == [""]
    assert tuple(validated_cast(df, READINGS).first()) == ("a", 1699000000.0, 12, 0.125)


@pytest.mark.parametrize("data_type", ["binary", "timestamp", "map<string,int>", "boolean"])
def test_types_that_are_neither_text_nor_number_are_refused(spark, data_type):
    df = spark.createDataFrame([], f"station string, `measured-at` double, sky {data_type}")
    with pytest.raises(ValidationError, match="unsupported data type"):
        check_rows(df, READINGS)


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_ansi_mode_makes_no_difference(spark, conf, ansi):
    conf("spark.sql.ansi.enabled", ansi)
    given = readings(spark, {"gusts": "9" * 30}, {"rain mm": "z"}, {"measured-at": "z"})
    assert errors(given) == [faults("gusts"), faults("rain mm"), faults("measured-at")]


def test_report_is_short_and_the_total_is_not(spark):
    given = readings(spark, *[{"station": f"S{i:03}", "gusts": "calm"} for i in range(60)], {})
    first = [(f"S{i:03}", faults("gusts")) for i in range(60)]
    assert [tuple(r) for r in invalid_row_report(given, READINGS).collect()] == first[:20]
    assert [tuple(r) for r in invalid_row_report(given, READINGS, rows=3).collect()] == first[:3]
    with pytest.raises(ValidationError) as caught:
        check_rows(given, READINGS, rows=45)
    assert [tuple(r) for r in caught.value.report] == first[:45] and caught.value.total == 60
    assert invalid_rows(given, READINGS).count() == 60


def test_only_checked_columns_are_read_and_nothing_is_shuffled(spark, tmp_path, plan):
    path = str(tmp_path / "in")
    spark.range(10).select(
        F.col("id").cast("string").alias("station"),
        F.col("id").cast("double").alias("measured-at"),
        F.lit("x").alias("unchecked"),
    ).write.parquet(path)
    text = plan(row_validation_errors(spark.read.parquet(path), READINGS))
    assert "unchecked" not in text and "Exchange" not in text and "Python" not in text
