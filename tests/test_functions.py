"""Edge values of the cleaning functions."""

import random
import re

import pytest
from pyspark.sql import functions as F

from visitgrid.functions import checks, convert, identity, names, normalize, text, units


def values(spark, inputs, expression, schema="v string"):
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"i int, {schema}")
    return [r["out"] for r in frame.select("i", expression(F.col("v")).alias("out")).sort("i").collect()]


def test_to_float(spark):
    cases = {
        " 12,5 ": 12.5, "1.234,5": None, "12.5 %": 12.5, "NVT": None, "NGEMETEN": None, "n/a": None, "na": None, "12d": None,
        "0x1p3": None, "1_000": None, "\u00a07\t": 7.0, "-.5e1": -5.0, "": None, "1 234,5": 1234.5, "1 234": None,
        "+3.": 3.0, "True": None, "1,2,3": None, "inf": float("inf"), "12.5%%": 12.5,
    }
    assert values(spark, list(cases), convert.to_float) == list(cases.values())
    assert values(spark, ["1 234", "1\u00a0234.5"], lambda c: convert.to_float(c, True)) == [1234.0, 1234.5]
    assert values(spark, ["nan"], lambda c: F.isnan(convert.to_float(c))) == [True]


def test_to_int(spark):
    assert values(spark, ["-2.7", "2.7", "1e300", "nan", "x", None], convert.to_int) == [-2, 2, None, None, None, None]


def test_to_bool(spark):
    got = values(spark, ["Ja", "1", "1.0", " FAUX ", "misschien", None], convert.to_bool)
    assert got == [True, True, None, False, None, None]
    mapped = values(spark, ["Ja", "x"], lambda c: convert.to_bool(c, bool_map={" JA": False, "X": True}))
    assert mapped == [False, True]
    assert values(spark, ["True", "False"], lambda c: convert.to_bool(c, F.lit("bool"), {"true": False})) == [True, False]


@pytest.mark.parametrize(("raw", "ctype", "date", "stamp"), [
    ("45000", "int", "2023-03-15", "2023-03-15T00:00:00"),
    ("45000.75", "float", "2023-03-15", "2023-03-15T18:00:00"),
    ("1", "int", "1900-01-01", "1900-01-01T00:00:00"),
    ("60", "int", "1900-02-28", "1900-02-28T00:00:00"),
    ("61", "int", "1900-03-01", "1900-03-01T00:00:00"),
    ("0.5", "float", "12:00:00", "12:00:00"),
    ("1e12", "float", None, None),
    ("03/04/2024", "text", "2024-04-03", "2024-04-03T00:00:00"),
    ("13/04/2024 8:05", "text", "2024-04-13", "2024-04-13T08:05:00"),
    ("04/13/2024", "text", "2024-04-13", "2024-04-13T00:00:00"),
    ("2024-04-03T10:11:12.5", "text", "2024-04-03", "2024-04-03T10:11:12.500000"),
    ("15 March 2023", "text", "2023-03-15", "2023-03-15T00:00:00"),
    ("Mar 5, 2023", "text", "2023-03-05", "2023-03-05T00:00:00"),
    ("31/02/2024", "text", "31/02/2024", "31/02/2024"),
    ("01.02.69", "text", "1969-02-01", "1969-02-01T00:00:00"),
    ("01.02.68", "text", "2068-02-01", "2068-02-01T00:00:00"),
    ("onbekend", "text", "onbekend", "onbekend"),
    ("45000", "text", "45000", "45000"),
    ("2023-03-15 00:00:00", "date", "2023-03-15", "2023-03-15T00:00:00"),
    ("08:30:00", "time", "08:30:00", "08:30:00"),
])
def test_dates(spark, raw, ctype, date, stamp):
    kind = F.lit(ctype)
    assert values(spark, [raw], lambda c: convert.to_date(c, kind)) == [date]
    assert values(spark, [raw], lambda c: convert.to_datetime(c, kind)) == [stamp]


def test_text(spark):
    assert values(spark, ["o'neil mc-donald", "ABC def"], text.title_case) == ["O'Neil Mc-Donald", "Abc Def"]
    assert values(spark, ["  A\u2003\x1f", None], text.norm) == ["a", ""]
    assert values(spark, ["C:\\in\\x.xlsm", "/a/b.xlsx", "c"], text.base_name) == ["x.xlsm", "b.xlsx", "c"]


def test_hash(spark):
    import hashlib

    want = hashlib.sha256("A|é".encode()).hexdigest()[:16]
    assert values(spark, ["é"], lambda c: text.sheet_list_hash(F.array(F.lit("A"), c))) == [want]


def test_normalize(spark):
    rule = {"Ja": "yes", "^n.*": "no", "default": "?"}
    assert values(spark, [" JA ", "Nee", "x", "default"], lambda c: normalize.apply_map(c, rule)) == ["yes", "no", "?", "?"]
    assert values(spark, [" x "], lambda c: normalize.apply_map(c, {"a": "b"})) == [" x "]
    swap = values(spark, ["ab12", "zab12"], lambda c: normalize.apply_regex(c, r"([a-y]+)(\d+)", r"\2-\1$"))
    assert swap == ["12-ab$", "zab12"]
    assert values(spark, ["x"], lambda c: normalize.apply_regex(c, "(", "y")) == ["x"]
    assert values(spark, [None, "q"], lambda c: normalize.normalize(c, {"default": "d", "case": "upper"})) == ["d", "Q"]
    assert values(spark, ["false", "", " ", "abc"], normalize.boolean_text) == [False, False, True, True]


def test_checks(spark):
    assert values(spark, [None], lambda c: checks.check(c, {"required": True})) == [False]
    assert values(spark, [None], lambda c: checks.check(c, {"range": [0, 1]})) == [True]
    assert values(spark, ["nan", "1", "1d"], lambda c: checks.check(c, {"range": [0, 1]})) == [False, True, False]
    assert values(spark, ["a"], lambda c: checks.check(c, {"range": [0]})) == [False]
    got = values(spark, [-950.0, 11.0, 0.0], lambda c: checks.within_limits(
        c, F.element_at(F.array(F.lit("air"), F.lit("water"), F.lit("gold")), F.col("i") + 1), checks.HU_LIMITS), "v double")
    assert got == [True, False, True]


def test_units(spark):
    dose = values(spark, [5.0], lambda c: units.convert_dose(c, F.lit("mGy"), F.lit("cGy")), "v double")
    assert dose == [0.5]
    assert values(spark, [5.0], lambda c: units.convert_dose(c, F.lit("mGy"), F.lit("Sv")), "v double") == [5.0]


def test_identity(spark):
    name = "QC300_0624_01504CT-CT11.xlsm"
    assert values(spark, [name], identity.normalize_device_number) == ["1504"]
    assert values(spark, ["01504", "12.0", "1.5", "abc", "", "7 ct", "7 CTX"], identity.normalize_device_number) == [
        "1504", "12", "1.5", None, None, "7", None]
    assert values(spark, [name], identity.hospital_id) == [300]
    assert values(spark, [name, "x_123CT_AB7.xlsm", "x_12CT7.xlsm"], identity.system_id) == [11, 7, None]
    years = values(spark, ["2024-05-06", "06/05/2024", "mei", ""], lambda c: identity.visit_year(c, F.lit("2022-01-01")))
    assert years == ["2024", "2024", "2022", "2022"]


def test_names(spark):
    raw = ["a", "a", "1 é", "", "__x__", "µV/ﬁ", "½ kV"]
    assert names.sanitize_all(["a", "a", "1 é", ""]) == ["a", "a_2", "c_1_e", "column"]
    assert values(spark, raw, names.sanitize_col) == [names.sanitize(n) for n in raw]
    assert names.standardize("a b-c(d).e/f") == "a_b_cd_e_f"
    assert names.table_stems(["a/b", "a_b", "a b", "a_b_2"]) == {"a/b": "a_b", "a_b": "a_b_2", "a b": "a_b_3", "a_b_2": "a_b_2_2"}
    assert names.suffix_repeats(["a", "a_2", "a", "b", "a"]) == ["a", "a_2", "a_3", "b", "a_4"]
    assert names.suffix_repeats(["a", "a", "a_2", "a_2", "a"]) == ["a", "a_2", "a_2_2", "a_2_3", "a_3"]


def test_both_forms_of_names_know_all_of_unicode(spark):
    rng = random.Random(4)
    texts = ["Ελληνικά άλφα", "Tiếng Việt ệ", "ｆｕｌｌ　ｗｉｄｔｈ１", "𝐁𝐨𝐥𝐝 𝟗", "㎏/㎥ ½", "Ⅷ ǆ ŉ", "ﷺ 漢字 한글", "😀 a", "K Å Ω ℡", "", "__", "9½", "\x1c x", "a\u0301"]
    points = [chr(rng.choice((rng.randrange(0x80, 0x3000), rng.randrange(0xF900, 0x10000), rng.randrange(0x1D400, 0x1F200)))) for _ in range(3000)]
    texts += ["x".join(points[i : i + 5]) for i in range(0, len(points), 5)]
    frame = spark.createDataFrame(list(enumerate(texts)), "n int, name string")
    got = [r["s"] for r in frame.select("n", names.sanitize_col(F.col("name")).alias("s")).orderBy("n").collect()]
    assert got == [names.sanitize(x) for x in texts]


def test_folding_tests_no_long_class_of_characters(spark):
    """A class of thousands of characters costs as many comparisons for each character."""
    shown = str(names.sanitize_col(F.col("name")))
    assert "rlike(name, " in shown and not re.search(r"rlike\(name, '\[[^\]]{60}", shown)


def test_usual_numbers_and_others_give_the_same(spark):
    raw = ["1", "-1.50", "007", "12\n", "12\u2028", " 3", "1,5", "1.", ".5", "1e3", "5%", "1.2.3", "--1", "1_0", "nan", "", None]
    wanted = [1.0, -1.5, 7.0, 12.0, 12.0, 3.0, 1.5, 1.0, 0.5, 1000.0, 5.0, None, None, None, "nan", None, None]
    assert [str(v) for v in values(spark, raw, convert.to_float)] == [str(v) for v in wanted]
