import pytest
from pyspark.sql import functions as F

from ledgerline import FeatureGroup, ValidationError
from ledgerline.operators.names import RESERVED_NAMES, check_names, name_problems
from groups_for_tests import READINGS

ID, AT = "station", "measured-at"


def test_any_order_and_subset_passes():
    check_names([AT, "gusts", ID], READINGS)


@pytest.mark.parametrize(
    "names, message",
    [
        (["{station}"], "Cannot proceed. Invalid char among '[,;{}()\n\t=]' "
                                  "detected in '{station}'."),
        (["a=b", "year"], "Invalid char"),
        ([ID, AT, "is_deleted"], "Cannot proceed. Detected column with reserved feature "
                                 "name 'is_deleted'."),
        ([ID, AT, "x", "y"], "Cannot proceed. Schema contains unknown columns: 'x,y'"),
        ([ID], "Cannot proceed. Missing feature names 'measured-at' in schema."),
        ([AT], "Cannot proceed. Missing feature names 'station' in schema."),
        ([], "Missing feature names 'station,measured-at'"),
        ([ID, AT, AT], "Column 'measured-at' occurs more than once"),
        ([ID, AT, "Event-Time"], "unknown columns: 'Event-Time'"),
    ],
)
def test_bad_names_are_refused(names, message):
    with pytest.raises(ValidationError) as caught:
        check_names(names, READINGS)
    assert message in str(caught.value)


@pytest.mark.parametrize("name", sorted(RESERVED_NAMES))
def test_reserved_names_are_refused_even_if_declared(name):
    group = FeatureGroup("g", "id", "at", (("id", "String"), ("at", "String"), (name, "String")))
    with pytest.raises(ValidationError, match="reserved feature name"):
        check_names(["id", "at", name], group)


def test_case_variants_that_are_both_declared_are_refused():
    group = FeatureGroup("g", "id", "at", (("id", "String"), ("at", "String"), ("ID", "String")))
    with pytest.raises(ValidationError, match="'ID' occurs more than once"):
        check_names(["id", "at", "ID"], group)


def test_column_form_agrees_with_the_check(spark):
    schemas = [
        [ID, AT], [AT], ["{x}", ID, AT], [ID, AT, "hour"], [ID, AT, "zz"],
        [ID, AT, "EVENT-TIME"], [], ["a\tb", "year", "q"], [ID, AT, ID],
        [ID, AT, "sky", "gusts"],
    ]
    df = spark.createDataFrame(list(enumerate(schemas)), "i int, names array<string>")
    found = df.select("i", name_problems(F.col("names"), READINGS).alias("p")).orderBy("i").collect()
    for names, row in zip(schemas, found):
        try:
            check_names(names, READINGS)
            assert row["p"] == [], names
        except ValidationError:
            assert row["p"], names
    assert [tuple(p) for p in found[7]["p"]] == [
        ("a\tb", "invalid character"), ("year", "reserved"), ("q", "unknown"),
        (ID, "missing"), (AT, "missing"),
    ]
