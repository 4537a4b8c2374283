from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerlark.functions import text, values, vocabulary


def one(spark, expression, **given):
    kinds = {str: "string", type(None): "string", int: "long"}
    df = spark.createDataFrame([tuple(given.values())], ", ".join(f"{k} {kinds[type(v)]}" for k, v in given.items()))
    return df.select(expression.alias("x")).first().x



def S():
    return F.col("s")


@pytest.mark.parametrize(
    ("fn", "given", "want"),
    [
        (text.fix_homoglyphs, "рокiв", "років"),
        (text.fix_homoglyphs, "УHР", "УНР"),
        (text.fix_homoglyphs, "Христовe ", "Христове "),
        (text.fix_homoglyphs, "Sea Baby", "Sea Baby"),
        (text.fix_homoglyphs, None, None),
        (text.strip_quotes, '"Назва"', "Назва"),
        (text.strip_quotes, "Криголам `Капітан`", "Криголам `Капітан`"),
        (text.strip_quotes, '"', '"'),
        (text.fix_stray_apostrophe, "Catherine`s `Glory`", "Catherine’s `Glory`"),
        (text.fold_apostrophes, "пам`ятки 'x' CHILDREN’S", "пам’ятки x CHILDREN’S"),
        (text.match_key, " «Конґрес»  Пам'яткИ", "конгрес пам’ятки"),
        (text.slug, "Місто Щастя'", "misto-shchastia"),
        (text.slug, "Éa 1!", "ea-1"),
        (text.slug, "!!", "series"),
        (text.vocabulary_key, " Срiбло ", "срібло"),
        (text.caption_role, "Аверс монети", "obverse"),
        (text.caption_role, "Reverse", "reverse"),
        (text.caption_role, "?", None),
        (text.url_extension, "http://a.b/c.d/e.PNG?x=1.gif", ".PNG"),
        (text.url_extension, "http://a.b/c", ".jpg"),
        (text.shortened, "x" * 50, "x" * 45 + "..."),
        (text.shortened, "x" * 48, "x" * 48),
        (text.id_as_path, "abc:88", "abc_88"),
        (text.id_number, "abc:88", 88),
        (values.grouped_decimal, "1 234,50", Decimal("1234.5")),
        (values.grouped_decimal, "12 345", Decimal("12345")),
        (values.grouped_decimal, "no", None),
        (values.digits, "1 000 шт", 1000),
        (values.digits, "", None),
        (values.leading_float, "28,3 мм", 28.3),
        (values.leading_float, "1 234", 1.0),
        (values.leading_float, "1,2,3", None),
        (values.dotted_date, "05.04.2021", date(2021, 4, 5)),
        (values.dotted_date, "31.02.2021", None),
        (values.date_in_text, "від 2021-13-01 та 05.04.2021", None),
        (values.date_in_text, "на 05.04.2021 року", date(2021, 4, 5)),
    ],
)
def test_scalar(spark, fn, given, want):
    assert one(spark, fn(S()), s=given) == want


@pytest.mark.parametrize(
    ("given", "title", "suffix"),
    [
        ('"Рік Кота" (c)', "Рік Кота", "с"),
        ("Рік Кота (Кролика)", "Рік Кота (Кролика)", None),
        ('"Зброярам!" (н) у сувенірному пакованні', "Зброярам! у сувенірному пакованні", "н"),
        ("Зброярам у сувенірній упаковці (бн)", "Зброярам у сувенірній упаковці", "бн"),
        ("  Два   слова ", "Два слова", None),
    ],
)
def test_titles(spark, given, title, suffix):
    assert tuple(one(spark, text.normalize_title(S()), s=given)) == (title, suffix)


def test_packaging(spark):
    assert tuple(one(spark, text.split_packaging(S()), s="Захисниці у Сувенірній упаковці")) == ("Захисниці", "у Сувенірній упаковці", "сувенірн")
    assert tuple(one(spark, text.split_packaging(S()), s="Захисниці у футлярі")) == ("Захисниці у футлярі", None, None)


def test_structs_and_lists(spark):
    assert tuple(one(spark, values.mintage(S()), s="1 000/0")) == (1000, 0)
    assert tuple(one(spark, values.mintage(S()), s="500")) == (500, None)
    assert tuple(one(spark, values.face_value(S()), s="5 грн")) == (5.0, "грн")
    assert one(spark, text.names(S()), s="A, B; ") == ["A", "B"]
    assert [tuple(p) for p in one(spark, text.paired_names(S(), F.col("t")), s="A,B", t="C")] == [("A", "C"), ("B", None)]
    assert one(spark, text.preferred(S(), F.col("t")), s="", t="x") == "x"
    assert tuple(one(spark, text.three_parts(F.split(S(), "#")), s="a## c")) == ("a", None, "c", False)
    assert one(spark, text.three_parts(F.split(S(), "#")), s="a#b").wrong_count
    assert len(one(spark, text.apostrophe_variants(S()), s="Пам'ятки")) == 4


def test_price_bounds_and_points(spark):
    rows = spark.sql("SELECT explode(array('0', '0.01', '999999999999.994', '999999999999.999', '-1')) AS s").select(values.price_fits(F.col("s").cast("decimal(38,6)")).alias("x")).collect()
    assert [r.x for r in rows] == [False, True, True, False, False]
    for body, want in (('{"price": 568}', Decimal(568)), ('{"price": "27.5"}', Decimal("27.5")), ('{"price": true}', None), ('{"price": "true"}', None), ("{}", None)):
        assert one(spark, values.point_price(F.try_parse_json(S())), s=body) == want


def test_vocabulary_flags_unknown_labels(spark):
    df = spark.createDataFrame([("Срібло",), ("дерево",), ("",), (None,)], "raw string")
    rows = vocabulary.coded(df, "raw", "material", "code").collect()
    assert {r.raw: (r.code, r.code_unknown) for r in rows} == {"Срібло": ("silver", False), "дерево": (None, True), "": (None, False), None: (None, False)}
