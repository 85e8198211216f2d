import datetime

from pyspark.sql import functions as F

from kindred.functions import numbers, text
from kindred.functions.dates import birth_window, overlap_days


def one(spark, *columns):
    return spark.range(1).select(*(c.alias(f"c{i}") for i, c in enumerate(columns))).first()


def window(day, age):
    return birth_window(F.lit(day).cast("date"), F.lit(age))


def test_birth_window_of_one_person_over_two_elections(spark):
    lo, hi = window("2018-10-05", 39)
    assert tuple(one(spark, lo, hi)) == (datetime.date(1978, 10, 7), datetime.date(1979, 10, 6))
    days = {age: one(spark, overlap_days(lo, hi, *window("2022-09-23", age)))[0] for age in (42, 43, 44)}
    assert days[43] > 300 and 1 <= days[42] <= 13 and days[44] <= 0


def test_double_surnames_have_one_form(spark):
    forms = ("Nováková - Svobodová", "Nováková-Svobodová", "Nováková Svobodová", " NOVÁKOVÁ–SVOBODOVÁ ")
    assert set(one(spark, *(text.name_norm(F.lit(f)) for f in forms))) == {"novakova svobodova"}


def test_fold_exact_agrees_on_latin_letters(spark):
    rows = spark.createDataFrame([("Žluťoučký KŮŇ",), ("éàüñç",), (None,), ("",)], "t string")
    assert all(r.a == r.b for r in rows.select(text.fold("t").alias("a"), text.fold_exact("t").alias("b")).collect())


def test_text_functions(spark):
    row = one(spark, text.titles(F.lit("Ing. Mgr."), F.lit("Ph.D.")), text.first_token(F.lit("  Jan Karel ")), text.first_token(F.lit(None)), text.stems(F.lit("učitel ZŠ učitelka"), expand={"zs": "zakladni skola"}), text.squeezed(F.lit(" -OSVČ,  kovář. ")), text.slug(F.lit("Šéf & kuchař")), text.shard_keys(F.lit("O'Brien - Nová")), text.shard_keys(F.lit("")), text.thousands(F.lit(1234567)))
    assert row.c0 == ["ing", "mgr", "phd"] and row.c1 == "Jan" and row.c2 == ""
    assert row.c3 == ["skola", "ucite", "zakla"] and row.c4 == "osvč, kovář" and row.c5 == "sef-kuchar"
    assert row.c6 == ["ob", "no"] and row.c7 == ["_"] and row.c8 == "1 234 567"


def test_search_and_parts(spark):
    row = one(spark, text.contains_all_words(F.lit("Jana Nováková Brno"), "novak BRN"), text.contains_all_words(F.lit("Jana"), "jan x"), text.parts(F.lit("kovář, truhlář - mistr; ")), text.same_start(F.lit("Brno-město"), F.lit("Brno")), text.same_start(F.lit(""), F.lit("Brno")))
    assert tuple(row) == (True, False, ["kovář", "truhlář", "mistr"], True, False)


def test_weights_are_finite_and_clipped(spark):
    row = one(spark, numbers.bits(F.lit(0.0), F.lit(0.5)), numbers.bits(F.lit(None).cast("double"), F.lit(None).cast("double")), numbers.odds(F.lit(1e6)), numbers.concentration(F.lit(1000), F.lit(0)), numbers.share_among(F.lit(1.0), F.lit(1.0), F.lit(1.0)))
    assert row.c0 < -12 and row.c1 == 0 and row.c2 == 2.0**60 and row.c3 == 50 and row.c4 == 0.5


def test_sets(spark):
    a, b = F.array(F.lit(1), F.lit(2)), F.array(F.lit(1), F.lit(2), F.lit(3))
    empty = F.array().cast("array<int>")
    assert tuple(one(spark, numbers.jaccard(a, b), numbers.jaccard(empty, empty), numbers.proper_subset(a, b), numbers.proper_subset(a, a))) == (2 / 3, None, True, False)
