"""Catalogue cards: from raw cards of two languages to one nested card, and from there to the columns that a load writes.

A column that a card says nothing about is absent, which isn't null: `present` lists the columns that are to be written,
as diff_rows() takes them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlark.functions import text, values
from ledgerlark.functions.vocabulary import coded
from ledgerlark.operators.numbering import dealt, written
from ledgerlark.sources import markup

# Labels of a raw card, by field and language.
LABELS = {
    "nominal": ("Номінал", "Denomination"),
    "circulation_date": ("Дата введення в обіг", "Date of issue"),
    "material": ("Матеріал", "Material"),
    "mintage": ("Тираж", "Mintage"),
    "weight": ("Маса", "Weight"),
    "fine_weight": ("Вага у чистоті", "Fine weight"),
    "diameter": ("Діаметр", "Diameter"),
    "quality": ("Якість", "Quality"),
    "edge": ("Гурт", "Edge"),
    "designers": ("Художник", "Designer"),
    "sculptors": ("Скульптор", "Sculptor"),
}
# Materials that count as precious.
PRECIOUS = ("gold", "silver", "bimetallic_precious")
CODED = (("material", "material"), ("quality", "quality"), ("edge", "edge"), ("unit", "unit"))


def mark(field: str) -> Column:
    """A field's value in the first language, else in the second (PJ4)."""
    first, second = LABELS[field]
    return text.preferred(F.col("uk_marks")[first], F.col("en_marks")[second])


def repaired(title: str) -> Column:
    """A title's parts after its look-alikes are repaired, which is done once for all uses of the result."""
    return text.let(text.fix_homoglyphs(F.col(title)), text.normalize_title)


def absolute(url: Column, base: str) -> Column:
    """A page's address resolved against its site (PJ1): full ones stay, `//host` takes the scheme, `/path` the host, others the base's folder; empty is the base."""
    scheme, host = base.split("://", 1)[0], "/".join(base.split("/", 3)[:3])
    folder = base.rsplit("/", 1)[0] if base.count("/") > 2 else host
    return (
        F.when(url.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), url)
        .when(url.startswith("//"), F.concat(F.lit(scheme + ":"), url))
        .when(url.startswith("/"), F.concat(F.lit(host), url))
        .when(url == "", F.lit(base))
        .otherwise(F.concat(F.lit(folder + "/"), url))
    )


def raw_pairs(pages: DataFrame, base: str) -> tuple[DataFrame, DataFrame]:
    """(raw, warnings): landed result pages of two languages as raw cards, one a card id, as canonical() takes them (PJ1, PJ2, PJ3, JN1, AG15).

    pages: locale (uk or en), page (its number), html. Of a card that a language lists twice the last one counts. A card of the second
    language alone is left out with a warning, one of the first alone is kept; a block without an id is left out with a warning that has its
    title. Descriptions' look-alikes are repaired, addresses are absolute.
    """
    keyed = pages.select(F.struct("locale", "page").alias("key"), "html")
    found = written(markup.extracted(keyed, "key", "html", markup.cards, markup.CARD_SCHEMA), "cards")
    named = found.filter("card_id is not null").select(F.col("key.locale").alias("locale"), "card_id", F.struct(F.col("key.page").alias("page"), "row_pos").alias("at"), F.struct("title", "marks", "descriptions", "images", "big_images").alias("card"))
    last = named.groupBy("locale", "card_id").agg(F.max_by("card", "at").alias("card"))
    uk, en = (last.filter(F.col("locale") == x).select("card_id", F.col("card").alias(x)) for x in ("uk", "en"))
    both = uk.join(en, "card_id", "full")

    def texts(side: str) -> Column:
        return F.transform(F.col(f"{side}.descriptions"), text.fix_homoglyphs)

    def urls(field: str) -> Column:
        return F.transform(F.col(f"uk.{field}"), lambda u: absolute(u, base))

    raw = both.filter("uk is not null").select(
        "card_id",
        *(F.col(f"{x}.title").alias(f"{x}_title") for x in ("uk", "en")),
        *(F.col(f"{x}.marks").alias(f"{x}_marks") for x in ("uk", "en")),
        *(texts(x).alias(f"{x}_texts") for x in ("uk", "en")),
        urls("images").alias("images"),
        urls("big_images").alias("big_images"),
    )
    alone = both.filter("uk is null").select("card_id", F.lit("second language alone").alias("warning"), F.col("en.title").alias("title"))
    nameless = found.filter("card_id is null").select("card_id", F.lit("no id").alias("warning"), "title")
    return raw, alone.unionByName(nameless)


def canonical(raw: DataFrame, prefix: str) -> DataFrame:
    """One nested card for each raw pair (PJ5), and `unknown`: fields whose label the vocabularies lack, which reject the card.

    raw: card_id, uk_title, en_title (null without that language), uk_marks, en_marks (maps), uk_texts, en_texts (three
    descriptions), images and big_images (obverse, reverse).
    """
    flat = dealt(raw).withColumns({"__face": values.face_value(mark("nominal")), "__day": values.dotted_date(mark("circulation_date")), "__material": mark("material"), "__quality": mark("quality"), "__edge": mark("edge")})
    flat = flat.withColumns({"__unit": F.col("__face.unit"), "__uk": repaired("uk_title"), "__en": repaired("en_title")})
    for field, vocabulary in CODED:
        flat = coded(flat, f"__{field}", vocabulary, field)
    uk, en, face, day = (F.col(c) for c in ("__uk", "__en", "__face", "__day"))
    said = {c: text.three_parts(F.col(f"{c}_texts")) for c in ("uk", "en")}

    def people(field: str) -> Column:
        return text.paired_names(F.col("uk_marks")[LABELS[field][0]], F.col("en_marks")[LABELS[field][1]])

    pictures = {"obverse_url": F.get("images", F.lit(0)), "reverse_url": F.get("images", F.lit(1)), "obverse_big_url": F.get("big_images", F.lit(0)), "reverse_big_url": F.get("big_images", F.lit(1))}
    wrong = [F.when(F.col(f"{f}_unknown"), F.lit(f)) for f, _ in CODED] + [F.when(said["uk"]["wrong_count"], F.lit("descriptions"))]
    return flat.select(
        F.concat(F.lit(prefix + ":"), F.col("card_id")).alias("source_id"),
        F.struct(uk["title"].alias("uk"), en["title"].alias("en")).alias("titles"),
        F.struct(F.col("uk_title").alias("uk"), F.col("en_title").alias("en")).alias("title_raw"),
        uk["suffix"].alias("metal_suffix"),
        F.struct(face["value"].alias("value"), F.col("unit")).alias("denomination"),
        day.alias("circulation_date"),
        F.year(day).alias("year"),
        "material",
        F.col("__material").alias("material_raw"),
        values.mintage(mark("mintage")).alias("mintage"),
        values.leading_float(mark("weight")).alias("weight_grams"),
        values.leading_float(mark("fine_weight")).alias("fine_weight_grams"),
        values.leading_float(mark("diameter")).alias("diameter_mm"),
        "quality",
        F.col("__quality").alias("quality_raw"),
        "edge",
        F.col("__edge").alias("edge_raw"),
        F.struct(*(F.struct(*(said[c][k].alias(k) for k in ("general", "obverse", "reverse"))).alias(c) for c in ("uk", "en"))).alias("description"),
        F.struct(people("designers").alias("designers"), people("sculptors").alias("sculptors")).alias("artists"),
        F.struct(*(c.alias(n) for n, c in pictures.items())).alias("images"),
        F.filter(F.array(*wrong), lambda x: x.isNotNull()).alias("unknown"),
    )


def presence(columns: dict[str, Column], always: tuple[str, ...]) -> list[Column]:
    """The columns under their names, and `present`: those that are written always or have a value."""
    given = [F.lit(n) if n in always else F.when(c.isNotNull(), F.lit(n)) for n, c in columns.items()]
    return [*(c.alias(n) for n, c in columns.items()), F.filter(F.array(*given), lambda x: x.isNotNull()).alias("present")]


def item_values(cards: DataFrame, series: str, denomination: str) -> tuple[DataFrame, DataFrame]:
    """(rows, rejected) of canonical cards as catalogue columns (PJ13); a card without a title or a year is rejected with its reason.

    The fine weight stands in for a missing weight; a mintage of 0 is a number; without artists the column is absent. A card's own
    title_en_source holds, where there is that column; else an English title counts as official.
    """
    material, artists = F.col("material"), F.col("artists")
    said_source = F.coalesce("title_en_source", F.lit("official")) if "title_en_source" in cards.columns else F.lit("official")
    columns = {
        "item_type": F.lit("coin"),
        "series_id": F.col(series),
        "title_original": F.col("titles.uk"),
        "original_lang": F.lit("uk"),
        "issue_year": F.col("year"),
        "material": material,
        "metal_kind": F.when(material.isNull(), "unknown").when(material.isin(*PRECIOUS), "precious").otherwise("base"),
        "edge": F.col("edge"),
        "quality": F.col("quality"),
        "source_key": F.col("source_id"),
        "denomination_id": F.col(denomination),
        "title_uk": F.col("titles.uk"),
        "title_uk_source": F.lit("official"),
        "title_en": F.nullif(F.col("titles.en"), F.lit("")),
        "title_en_source": F.when(F.nullif(F.col("titles.en"), F.lit("")).isNotNull(), said_source),
        "issue_date": F.col("circulation_date"),
        "mintage_announced": F.col("mintage.announced"),
        "mintage_actual": F.col("mintage.actual"),
        "weight_grams": F.coalesce("weight_grams", "fine_weight_grams").cast("decimal(10,3)"),
        "diameter_mm": F.col("diameter_mm").cast("decimal(10,3)"),
        "descriptions": F.col("description"),
        "artists": F.when((F.size("artists.designers") > 0) | (F.size("artists.sculptors") > 0), artists),
    }
    always = ("item_type", "series_id", "title_original", "original_lang", "issue_year", "material", "metal_kind", "edge", "quality", "source_key", "title_uk", "title_uk_source")
    reason = F.when(F.coalesce("titles.uk", F.lit("")) == "", "no title").when(F.col("year").isNull(), "no year")
    told = cards.withColumn("__reason", reason)
    return told.filter("__reason is null").select(*presence(columns, always)), told.filter("__reason is not null").select("source_id", F.col("__reason").alias("reason"))


def series_values(entries: DataFrame, has_official: bool = True) -> DataFrame:
    """Dictionary entries as series columns (PJ14). entries: slug, uk, en, is_official, first_year, last_year; nulls are absent columns."""
    source = F.when(F.coalesce("is_official", F.lit(True)), "official").otherwise("manual")
    uk, en = text.trim(F.coalesce("uk", F.lit(""))), text.trim(F.col("en"))
    columns = {"name_original": uk, "name_uk": uk, "name_uk_source": source, "original_lang": F.lit("uk"), "name_en": en, "name_en_source": F.when(en.isNotNull(), source), "start_year": F.col("first_year"), "end_year": F.col("last_year")}
    if has_official:
        columns["is_official"] = F.coalesce("is_official", F.lit(True))
    return entries.select("slug", *presence(columns, ("name_original", "name_uk", "name_uk_source", "original_lang", "is_official")))


def media_rows(photos: DataFrame, files: DataFrame, card: str) -> tuple[DataFrame, DataFrame]:
    """(media, notes): one row for each card and role with its files by size (PJ15), and what is lacking.

    photos: card, role, sizes (array of struct(size, file)) of the winner. files: file, bytes, sha256, width, height of what is
    there. A role none of whose files is there has no row, but a note.
    """
    wanted = photos.select(card, "role", F.explode("sizes").alias("s")).select(card, "role", "s.size", "s.file")
    told = wanted.join(files.withColumnRenamed("file", "__f"), F.col("file") == F.col("__f"), "left")
    there = F.col("__f").isNotNull()
    grouped = told.groupBy(card, "role").agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.when(there, F.struct(F.col("size").cast("string").alias("key"), F.col("file").alias("value")))))).alias("keys"),
        F.sum(F.when(there, F.col("bytes"))).alias("total_bytes"),
        F.max(F.when(there, F.struct("size", "width", "height", "sha256"))).alias("largest"),
        F.array_sort(F.collect_list(F.when(~there, F.col("file")))).alias("lost"),
    )
    media = grouped.filter("largest is not null").select(card, "role", "keys", "total_bytes", F.col("largest.width").alias("width"), F.col("largest.height").alias("height"), F.col("largest.sha256").alias("sha256"))
    notes = grouped.filter("size(lost) > 0").select(card, "role", F.when(F.col("largest").isNull(), "no file").otherwise("files missing").alias("note"), "lost")
    return media, notes


def snapshot_rows(quotes: DataFrame, item: str, price: str, day: str, url: str, source: str, currency: str) -> DataFrame:
    """Quotes or history points as typed snapshot rows (PJ16, SK1): the one projection that the nightly run and the history load share.

    Prices are narrowed to cents only if they fit; the time is the day's midnight; the page's address is kept in the payload.
    """
    return quotes.filter(values.price_fits(F.col(price).cast("decimal(38,6)"))).select(
        F.col(item).alias("item_id"),
        F.lit(source).alias("source"),
        F.lit(None).cast("string").alias("grade"),
        F.col(price).cast("decimal(14,2)").alias("price"),
        F.lit(currency).alias("currency"),
        values.midnight(F.col(day)).alias("observed_at"),
        F.col(url).alias("source_url"),
        F.to_json(F.struct(F.date_format(day, "yyyy-MM-dd").alias("date"), F.col(price).cast("decimal(14,2)").cast("string").alias("price"))).alias("raw"),
    )
