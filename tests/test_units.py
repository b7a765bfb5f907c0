import pytest

from cohortloom.operators import units as U
from cohortloom.operators.units import in_common_unit, numeric_column_days, read_unit, segment_unit, shape_rule, times_in_days, unit_of_name, with_unit_days

VALUES = "row_id long, gse_id string, gsm_id string, column_name string, raw_time string, shape string, told double"
PLANS = "gse_id string, time_column string, time_unit string"
UNITS = "gse_id string, column_name string, unit string"


@pytest.mark.parametrize(("text", "size"), [("d", 1), ("dys", 1), ("Months", 30.4375), ("mths", 30.4375), ("m", 30.4375), ("wks", 7), ("yr.", 365.25), ("kg", None), ("unknown", None), ("ca", None), ("", None)])
def test_units(text, size):
    assert (segment_unit(text) or (None,))[0] == size


@pytest.mark.parametrize(("name", "size"), [("os_days", 1), ("relapse.d", 1), ("EFS (mo)", 30.4375), ("pfs_yr", 365.25), ("months to os", 30.4375), ("time to death", None), ("fup_TTP", None), ("os", None)])
def test_names(name, size):
    assert unit_of_name(name) == size


@pytest.mark.parametrize(
    ("raw", "days"),
    [
        ("12 days", 12), ("1,101 d", 1101), ("0,5 yr", 183), ("ca. 2 weeks", 14), (">3 mths", 91), ("3+ [months]", 91), ("P1Y2M", 426), ("1y 2m", 426), ("1 years, 2 months", 426), ("1 yr + 2 mths", 426),
        ("two days", 2), ("Eleven months", 335), ("OS months: 10", 304), ("days=103", 103), ("last visit, in years: 0.18", 66), ("10 days after diagnosis", 10), ("24 months", 731),
        ("lost", None), ("n.d.", None), ("NA", None), ("---", None), ("", None), (None, None), ("2020-01-02", None), ("7", None),
    ],
)
def test_values_with_their_own_unit(spark, raw, days):
    df = spark.createDataFrame([(1, "G", None, "event", raw, "clash", 1.0)], VALUES)
    got = times_in_days(df, spark.createDataFrame([], PLANS), spark.createDataFrame([], UNITS)).collect()
    assert [r.time_days for r in got] == ([] if days is None else [days])


def test_precedence_of_units(spark):
    plans = spark.createDataFrame([("g1 ", "t", "weeks"), ("G2", "t", "unknown"), ("G3", "os_days", "months"), ("G1", "t", "wk"), (None, "t", "days")], PLANS)
    units = spark.createDataFrame([("G1", "t", "days"), ("G2", "t", "years"), ("G4", "t", "---")], UNITS)
    rows = [(1, "G1", "t", "2"), (2, "g2", "t", "2"), (3, "G3", "os_days", "2"), (4, "G4", "t", "2"), (5, "G5", "os_days", "2"), (6, "G1", "t", "2 d"), (6, "G1", "t", "2 d"), (7, None, "os_days", "3")]
    df = spark.createDataFrame([(i, g, None, c, v, "", 0.0) for i, g, c, v in rows], VALUES)
    got = sorted((r.row_id, r.time_days) for r in times_in_days(df, plans, units).collect())
    assert got == [(1, 14), (2, 731), (3, 61), (5, 2), (6, 2), (6, 2), (7, 3)]


def test_shapes_that_hold_no_time():
    assert shape_rule("not reached") is None
    assert shape_rule("#-#-#") is None
    assert shape_rule("#") == "0.0;1.0;0"


@pytest.mark.parametrize(
    ("shape", "rule"),
    [
        ("# kg", None), ("# mg/kg", None), ("# mg per kg", None), ("#/day", None), ("# m²", None), ("# d⁻¹", None), ("# cycles", None), ("kg: #", None), ("# days at # kg", None), ("events: #/#", None),
        ("twenty one days", "21.0;;1"), ("thirty-two weeks", "224.0;;1"), ("one and a half years", "547.875;;1"), ("half a year", "182.625;;1"), ("a couple of weeks", "14.0;;1"), ("a month and a half", "45.65625;;1"),
        ("one hundred and five days", "105.0;;1"), ("# and a half years", "182.625;365.25;1"), ("# year and two months", "60.875;365.25;1"), ("# months after a relapse", "0.0;30.4375;1"), ("mm relapse # months", "0.0;30.4375;1"), ("# men", "0.0;1.0;0"),
    ],
)
def test_other_dimensions_and_number_words(shape, rule):
    assert shape_rule(shape) == rule


@pytest.mark.parametrize(
    ("text", "dimension", "size"),
    [
        ("m", "time", 30.4375), ("m", "length", 1), ("m", "amount_concentration", 1000), ("mm", "length", 1e-3), ("mM", "amount_concentration", 1), ("mg", "mass", 1e-3), ("mg", "time", None), ("mg/dL", "mass_concentration", 10), ("µg mL⁻¹", "mass_concentration", 1),
        ("mg per m2", "area_dose", 1e-3), ("mg/kg/d", "daily_dose", 1e-6), ("cm³", "volume", 1e-6), ("mL", "volume", 1e-6), ("d-1", "rate", 1), ("kg/m²", "mass", None), ("millimetres", "length", 1e-3),
    ],
)
def test_compound_units_of_every_dimension(text, dimension, size):
    got = segment_unit(text, dimension)
    assert (got is None) if size is None else got[0] == pytest.approx(size)


def test_tries_and_priors_decide(monkeypatch):
    """Without one of them another reading is taken."""

    def without(name, value):
        read_unit.cache_clear()
        with monkeypatch.context() as m:
            m.setattr(U, name, value)
            out = shape_rule("# mg/kg"), shape_rule("# m²"), segment_unit("mm", "length"), segment_unit("m", "length"), segment_unit("kg/m²", "area_dose")
        read_unit.cache_clear()
        return out

    flat = {d: dict.fromkeys(U.DIMENSIONS, 0.0) for d in U.DIMENSIONS}
    usual = without("BROADCAST_RULES", 1)
    assert usual[:2] == (None, None) and all(usual[2:])
    assert without("_PREFIX_TRIE", {})[0] is not None
    assert without("_EXPONENT_TRIE", {})[1] is not None
    assert without("PRIORS", flat) != usual


@pytest.mark.parametrize(("raw", "days"), [("5 kg", None), ("12 mg/kg", None), ("5 m2", None), ("12 d-1", None), ("twenty one days", 21), ("2 and a half weeks", 18), ("day 3", 3), ("9", 9)])
def test_values_in_a_column_of_days(spark, raw, days):
    df = spark.createDataFrame([(1, "G", None, "os_days", raw, "clash", 1.0)], VALUES)
    got = times_in_days(df, spark.createDataFrame([], PLANS), spark.createDataFrame([], UNITS)).collect()
    assert [r.time_days for r in got] == ([] if days is None else [days])


def test_any_dimension(spark):
    rows = [(1, "G", None, "weight_kg", "70", "", 0.0), (2, "G", None, "weight", "70 kg", "", 0.0), (3, "G", None, "weight", "150 lb", "", 0.0), (4, "G", None, "w", "5", "", 0.0), (5, "G", None, "weight", "3 days", "", 0.0)]
    units = spark.createDataFrame([("G", "w", "mg")], UNITS)
    got = {r.row_id: r.amount for r in in_common_unit(spark.createDataFrame(rows, VALUES), [(units, "column_name", "unit")], "mass").collect()}
    assert got == {1: 70000.0, 2: 70000.0, 4: pytest.approx(0.005)}


def test_columns_with_a_plain_unit(spark):
    rows = [(1, "G", "S", "OS time", "10", "", 0.0), (2, "G", "S", "OS time", "about 2.5 m", "", 0.0), (3, "G", "S", "OS time", None, "", 0.0), (4, "G", "S", "x", "1", "", 0.0), (5, "H", "S", "OS time", "1", "", 0.0)]
    units = spark.createDataFrame([("G", "OS time", "months"), ("G", "x", "unknown"), ("H", "OS time", "years"), ("H", "OS time", "years")], UNITS)
    got = {r.row_id: (r.derived_name, r.days) for r in numeric_column_days(spark.createDataFrame(rows, VALUES), units).collect()}
    assert got == {1: ("llm_os_time_days", 304.375), 2: ("llm_os_time_days", 2.5 * 30.4375), 3: ("llm_os_time_days", None), 5: ("llm_os_time_days", 365.25)}
    wide = with_unit_days(spark.createDataFrame([("1", "2 yr", "c")], "`OS time` string, pfs string, `a.b` string"), [("OS time", "months"), ("pfs", "years"), ("a.b", "unknown"), ("gone", "days")])
    assert wide.columns == ["OS time", "pfs", "a.b", "llm_os_time_days", "llm_pfs_days"] and wide.first()[3:] == (30.4375, 730.5)
