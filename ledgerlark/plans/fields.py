"""Queries of the field functions over whole tables: inputs spelt from columns, with SQL that computes; or a function's cases around a row's own word, with SQL that states the results."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlark.functions import text, values, vocabulary
from ledgerlark.operators import pick, report, validate
from ledgerlark.plans.catalogue import read, registered
from ledgerlark.sources import landing, markup

#: Stands for the row's own word, the part's name.
WORD = "{}"


def quoted(s: str | None) -> str:
    return "NULL" if s is None else "'" + s.replace("'", "''") + "'"


def chosen(items: list[str | None]) -> Column:
    """The row's case of a list, with its word put in."""
    return F.replace(F.get(F.array(*(F.lit(i).cast("string") for i in items)), (F.col("p_partkey") % len(items)).cast("int")), F.lit(WORD), F.col("p_name"))


def shown(c: Column) -> Column:
    return c.cast("string")


def parts(*fields: Column) -> Column:
    """Several fields as one text, nulls as a dash."""
    return F.concat_ws("|", *(F.coalesce(f.cast("string"), F.lit("-")) for f in fields))


def golden(name: str, does: str, function: Callable[[Column], Column], cases: list[tuple[str | None, str | None]]) -> None:
    """Register a query over all parts, and as its SQL the results that the cases state."""
    expected = " ".join(f"WHEN {i} THEN {quoted(out)}" for i, (_, out) in enumerate(cases))

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = read(spark, sf_dir, "part").select("p_partkey", chosen([given for given, _ in cases]).alias("given"))
        return rows.select("p_partkey", shown(function(F.col("given"))).alias("result"))

    query.__doc__ = does
    query.__name__ = name
    registered(name, f"SELECT p_partkey, replace(CASE p_partkey % {len(cases)} {expected} END, '{WORD}', p_name) AS result FROM part")(query)


# ---- text ---------------------------------------------------------------------------------------------

golden("homoglyphs", "Latin look-alikes in Cyrillic words (FN1).", text.fix_homoglyphs, [
    ("Мoнета {}", "Монета {}"), ("Київ i Львів {}", "Київ i Львів {}"), ("срiбло {}", "срібло {}"), ("MIT {}", "MIT {}"), ("рiк, pік {}", "рік, рік {}"), (None, None),
])
golden("wrapping_quotes", "A pair of quotation marks around the whole (FN2).", text.strip_quotes, [
    ("«{}»", "{}"), ('"{}"', "{}"), ("«{}", "«{}"), ("„ {} “", "{}"), ("{} «x»", "{} «x»"), ("", ""), (None, None),
])
golden("stray_apostrophe", "A backtick between letters (FN3).", text.fix_stray_apostrophe, [
    ("п`ять {}", "п’ять {}"), ("`{}", "`{}"), ("a` {}", "a` {}"), ("об`єкт`", "об’єкт`"), (None, None),
])
golden("packaging_phrase", "A packaging phrase at the end (FN4).", lambda s: parts(text.split_packaging(s)["base"], text.split_packaging(s)["key"]), [
    ("{} у сувенірній упаковці", "{}|сувенірн"), ("{} у подарунковому пакованні ", "{}|подарунков"), ("{} у сувенірній упаковці 2", "{} у сувенірній упаковці 2|-"), ("{}", "{}|-"), ("{} У СУВЕНІРНІЙ УПАКОВЦІ", "{}|сувенірн"),
])
golden("title_parts", "Suffix code, packaging phrase and quotes of a title (FN5).", lambda s: parts(text.normalize_title(s)["title"], text.normalize_title(s)["suffix"]), [
    ("«{}» (с)", "{}|с"), ("{} (бн)", "{}|бн"), ("{}  x", "{} x|-"), ("{} (н) у сувенірній упаковці", "{} у сувенірній упаковці|н"), ("{} у сувенірній упаковці (н)", "{} у сувенірній упаковці|н"), (" {} (c) ", "{}|с"), ("{} (два слова)", "{} (два слова)|-"),
])
golden("folded_apostrophes", "One apostrophe between letters, none elsewhere (FN6).", text.fold_apostrophes, [
    ("п'ять {}", "п’ять {}"), ("пʼять {}", "п’ять {}"), ("'{}'", "{}"), ("об`єкт {}", "об’єкт {}"), ("5' {}", "5 {}"), (None, None),
])
golden("title_key", "The comparison key of a title (FN7).", text.match_key, [
    ("  Ґанок  {}", "ганок {}"), ("«П'ЯТЬ» {}", "п’ять {}"), ("Мoнета {}", "монета {}"), ("{}", "{}"), (None, None),
])
golden("label_key", "What a label is looked up by (FN9).", text.vocabulary_key, [
    (" СРIБЛО {} ", "срібло {}"), ("Золото {}", "золото {}"), (" Proof {}", "proof {}"), (None, None),
])
golden("name_list", "Names split at commas and semicolons (FN16).", lambda s: F.concat_ws("/", text.names(s)), [
    ("{}, Б; В", "{}/Б/В"), (" ;, {}", "{}"), ("", ""), (None, ""), ("{} і Б", "{} і Б"),
])
golden("role_of_caption", "The side that a caption or file name tells (FN20).", text.caption_role, [
    ("{} Аверс", "obverse"), ("{}_reverse.png", "reverse"), ("РЕВЕРС {}", "reverse"), ("{}", None), ("obverse and reverse", "obverse"), (None, None),
])
golden("extension_of_url", "A url's extension (FN21).", text.url_extension, [
    ("https://h.ua/a/{}.PNG?x=1.gif", ".PNG"), ("https://h.ua/a/b", ".jpg"), ("https://h.ua/a.b/c", ".jpg"), ("/x/{}.webp#y", ".webp"),
])
golden("shortened_text", "Texts over 48 characters end in three dots (FN22).", text.shortened, [
    ("x" * 48, "x" * 48), ("x" * 49, "x" * 45 + "..."), ("", ""), (None, None), ("{}", "{}"),
])
golden("apostrophe_spellings", "A name with each apostrophe, the given one first (FN23).", lambda s: F.concat_ws("/", text.apostrophe_variants(s)), [
    ("п'ять {}", "п'ять {}/п`ять {}/п’ять {}/пʼять {}"), ("{}", "{}"), ("об’єкт", "об’єкт/об'єкт/об`єкт/обʼєкт"),
])
golden("preferred_label", "The first label that isn't empty (PJ4).", lambda s: text.preferred(s, F.lit("en")), [("{}", "{}"), ("", "en"), (None, "en")])
golden("three_descriptions", "Three positional descriptions or an error flag (PJ2).", lambda s: parts(*(text.three_parts(F.split(s, "/"))[k] for k in ("general", "obverse", "reverse", "wrong_count"))), [
    ("{}/ b /c", "{}|b|c|false"), ("a//c", "a|-|c|false"), ("a/b", "-|-|-|true"), ("a/b/c/d", "-|-|-|true"),
])

# ---- values -------------------------------------------------------------------------------------------

golden("day_in_text", "A day anywhere in a text (FN17).", values.date_in_text, [
    ("від 2024-02-03, {}", "2024-02-03"), ("{} 03.04.2024", "2024-04-03"), ("2024-13-01 03.04.2024", None), ("{}", None), (None, None),
])
golden("some_of_many", "The first items and how many more (AG10, SO2).", lambda s: report.first_some(F.split(s, ","), 2), [
    ("a,b", "a, b"), ("a,b,c", "a, b (+1)"), ("a,b,c,d,e", "a, b (+3)"), ("{}", "{}"),
])
golden("select_options", "Distinct option values, bytes kept, placeholders dropped (SC2).", lambda s: F.concat_ws("/", markup.options_of(s)), [
    ('<select><option value="">все</option><option value="{} ">a</option><option selected value="b">b</option><option value="b">c</option></select>', "{} /b"), ("<p>{}</p>", ""), ('<option value=" ">', ""),
])
golden("page_title", "A page's title (PJ11).", markup.title_of, [("<TITLE a='1'>{}</title>", "{}"), ("<title></title>", None), ("<p>{}</p>", None)])


# ---- values spelt from columns ---------------------------------------------------------------------------


def spelt(name: str, does: str, table: str, key: str, given: Callable[[], Column], function: Callable[[Column], Column], sql: str) -> None:
    """Register a query that reads a function's input, as `given` spells it, from columns of a whole table; sql is the result, by its own rule, from the same columns."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return read(spark, sf_dir, table).select(key, shown(function(given())).alias("result"))

    query.__doc__ = does
    query.__name__ = name
    registered(name, f"SELECT {key}, {sql} AS result FROM {table}")(query)


def told(*pieces: Column | str) -> Column:
    return F.concat(*(F.lit(p) if isinstance(p, str) else p.cast("string") for p in pieces))



spelt("title_slug", "A slug of brand, name and size (FN8).", "part", "p_partkey", lambda: told(F.col("p_brand"), " — ", F.col("p_name"), " №", F.col("p_size"), "ﬁ!"), text.slug, "replace(lower(p_brand), '#', '-') || '-' || replace(p_name, ' ', '-') || '-o' || p_size || 'fi'")
spelt("paired_name_list", "A name's words and the type, by position (FN16).", "part", "p_partkey", lambda: F.replace("p_name", F.lit(" "), F.lit(", ")), lambda s: F.to_json(text.paired_names(s, F.col("p_type"))), """'[{"uk":"' || split_part(p_name, ' ', 1) || '","en":"' || p_type || '"},{"uk":"' || split_part(p_name, ' ', 2) || '"}]'""")
spelt("id_spellings", "prefix:88, prefix_88 and 88 (PJ17, SO1).", "part", "p_partkey", lambda: told("nb:", F.col("p_partkey")), lambda s: parts(text.id_as_path(s), text.id_number(s), text.id_number(text.id_as_path(s))), "'nb_' || p_partkey || '|' || p_partkey || '|' || p_partkey")
spelt("all_digits", "All digits as one number (FN11).", "part", "p_partkey", lambda: told(F.col("p_brand"), " x ", F.col("p_size"), " 0"), values.digits, "CAST(CAST(replace(p_brand, 'Brand#', '') || p_size || '0' AS BIGINT) AS VARCHAR)")
spelt("first_float", "The first number of a text (FN12).", "part", "p_partkey", lambda: told("вага ", F.replace(F.col("p_retailprice").cast("decimal(12,2)").cast("string"), F.lit("."), F.lit(",")), F.when(F.col("p_size") == 50, ".1").otherwise(""), " г ", F.col("p_size")), lambda s: F.round(values.leading_float(s) * 100).cast("long"), "CASE WHEN p_size < 50 THEN CAST(CAST(round(p_retailprice * 100) AS BIGINT) AS VARCHAR) END")
spelt("face_and_unit", "Face value and unit, cut at the first white space (FN13).", "part", "p_partkey", lambda: told(F.when(F.col("p_size") < 10, "~").otherwise(""), F.col("p_size"), F.when(F.col("p_size") > 25, "").otherwise("\u00a0"), F.col("p_name")), lambda s: parts(values.face_value(s)["value"], values.face_value(s)["unit"]), "p_size || '.0|' || CASE WHEN p_size > 25 THEN split_part(p_name, ' ', 2) ELSE p_name END")
spelt("dotted_day", "d.m.yyyy with nothing around it (FN14).", "orders", "o_orderkey", lambda: F.when(F.col("o_orderstatus") == "O", F.date_format(F.col("o_orderdate"), "dd.MM.yyyy")).otherwise(told(F.date_format(F.col("o_orderdate"), "d.M.yyyy"), F.when(F.col("o_orderstatus") == "P", " ").otherwise(""))), values.dotted_date, "CASE WHEN o_orderstatus <> 'P' THEN strftime(o_orderdate, '%Y-%m-%d') END")
spelt("announced_and_actual", "Announced and actual mintage (FN15).", "part", "p_partkey", lambda: told("до ", F.col("p_size"), " 000", F.when(F.col("p_size") > 40, "").otherwise(told("/", F.col("p_partkey")))), lambda s: parts(values.mintage(s)["announced"], values.mintage(s)["actual"]), "p_size * 1000 || '|' || CASE WHEN p_size > 40 THEN '-' ELSE CAST(p_partkey AS VARCHAR) END")
spelt("typed_point_price", "The price of a JSON point: a number, a quoted number with a comma, no boolean, none (FN18).", "events", "event_id", lambda: told('{"price": ', F.when(F.col("event_type") == "error", "true").when(F.col("event_type") == "click", told('" 1 ', F.lpad(F.replace(F.col("value").cast("decimal(12,2)").cast("string"), F.lit("."), F.lit(",")), 6, "0"), '"')).otherwise(F.col("value").cast("decimal(12,2)").cast("string")), F.when(F.col("event_type") == "signup", "").otherwise("}")), lambda s: values.point_price(F.try_parse_json(s)).cast("decimal(12,2)"), "CASE WHEN event_type = 'click' THEN CAST(CAST(round(value + 1000, 2) AS DECIMAL(12,2)) AS VARCHAR) WHEN event_type IN ('view', 'purchase') THEN CAST(CAST(round(value, 2) AS DECIMAL(12,2)) AS VARCHAR) END")
spelt("price_guard", "Prices that fit (FL4).", "orders", "o_orderkey", lambda: (F.col("o_totalprice").cast("decimal(14,2)") - 100000) * 5000000, values.price_fits, "CAST(CAST(round(o_totalprice, 2) AS DECIMAL(14,2)) > 100000 AND CAST(round(o_totalprice, 2) AS DECIMAL(14,2)) < 300000 AS VARCHAR)")
spelt("year_of_path", "The year of a landed file (SC3).", "orders", "o_orderkey", lambda: told("/raw/", F.year(F.col("o_orderdate")), F.when(F.col("o_orderstatus") == "P", ".txt").otherwise(".html")), landing.year_of, "CASE WHEN o_orderstatus <> 'P' THEN CAST(year(o_orderdate) AS VARCHAR) END")
spelt("run_day_of_path", "The run's day of a landing folder (SC4).", "orders", "o_orderkey", lambda: told("/daily/", F.when(F.col("o_orderstatus") == "P", "day=").otherwise("run_date="), F.date_format(F.col("o_orderdate"), "yyyy-MM-dd"), "/x.html"), landing.run_day_of, "CASE WHEN o_orderstatus <> 'P' THEN strftime(o_orderdate, '%Y-%m-%d') END")
spelt("stated_date", "A text's date, ISO or day first with points, hyphens or slashes; digits beside it spoil it (FN17).", "orders", "o_orderkey", lambda: told("на ", F.date_format(F.col("o_orderdate"), "yyyy"), " ", F.when(F.col("o_orderstatus") == "F", F.date_format(F.col("o_orderdate"), "yyyy-MM-dd")).when(F.col("o_orderstatus") == "O", F.date_format(F.col("o_orderdate"), "dd/MM/yyyy")).otherwise(told("1", F.date_format(F.col("o_orderdate"), "dd-MM-yyyy"))), "."), values.date_in_text, "CASE WHEN o_orderstatus <> 'P' THEN strftime(o_orderdate, '%Y-%m-%d') END")
def entry_errors_of_part(s: Column) -> Column:
    """A part as a dictionary entry, whose size decides what it lacks."""
    size = F.col("p_size")
    membership = F.when(size % 10 == 0, F.struct(F.when(size % 3 == 0, F.col("p_name")).alias("title_prefix"), F.when(size == 50, F.array("p_brand")).alias("card_ids")))
    errors = validate.dictionary_errors(s, F.when(size > 40, None).otherwise(size > 20), F.when(size == 7, "").otherwise(F.col("p_name")), membership)
    return F.array_join(errors, ",")


spelt("entry_rules", "All that is wrong with a dictionary entry, in order (FL6).", "part", "p_partkey", lambda: F.when(F.col("p_size") == 13, "").otherwise(F.col("p_brand")), entry_errors_of_part, "concat_ws(',', CASE WHEN p_size BETWEEN 21 AND 40 AND p_size % 10 = 0 THEN 'official with membership' END, CASE WHEN p_size <= 20 AND p_size % 10 <> 0 THEN 'curated without membership' END, CASE WHEN p_size IN (10, 20) THEN 'membership without prefix or ids' END, CASE WHEN p_size > 40 THEN 'neither official nor curated' END, CASE WHEN p_size = 7 THEN 'no name' END, CASE WHEN p_size = 13 THEN 'no slug' END)")
WIDTH_SQL = "p_size * 25"
spelt("tiers_of_size", "Output sizes, more than 3 % apart (WN7).", "part", "p_partkey", lambda: F.col("p_size") * 25, lambda s: F.concat_ws(",", pick.tiers(s).cast("array<string>")), f"concat_ws(',', least(300, {WIDTH_SQL}), CASE WHEN least(600, {WIDTH_SQL}) * 100 > least(300, {WIDTH_SQL}) * 103 THEN least(600, {WIDTH_SQL}) END, CASE WHEN {WIDTH_SQL} > 618 THEN least(1200, {WIDTH_SQL}) END)")


# ---- vocabularies ---------------------------------------------------------------------------------------


@registered(
    "coded_materials",
    """SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN 'gold' WHEN 1 THEN 'silver' WHEN 2 THEN 'zinc_alloy' END AS material, p_partkey % 5 = 3 AS material_unknown FROM part""",
)
def coded_materials(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes of labels, and labels that the vocabulary lacks (FL7)."""
    label = chosen(["Золото", " срiбло ", "Сплав на основі цинку", "{}", ""])
    return vocabulary.coded(read(spark, sf_dir, "part").select("p_partkey", label.alias("raw")), "raw", "material", "material").select("p_partkey", "material", "material_unknown")
